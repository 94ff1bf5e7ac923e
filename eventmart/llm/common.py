"""Shared plumbing: table reads, stored intermediate tables and a bounded stream of Arrow pieces."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass holds at once; a longer document is handled alone.
PIECE_BYTES = 1 << 20
#: Bytes that Spark puts in one Arrow batch for a Python worker, so that long texts do not meet there in thousands.
BATCH_BYTES = 4 << 20

#: A-Z and their lower-case forms: the only letters that the contracts fold.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts over which the rows of one group are dealt.
GROUP_PARTS = 256

_own_folders: dict[str, str] = {}
#: Tables that each application stored and has not discarded.
_paths: dict[str, list[str]] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, for the memory of both sides of every Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local session without one gets its own, the same until it ends."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
    return _own_folders[context.applicationId]


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df written once to the shared folder and read back: later stages survive a lost executor
    without repeating the work, and the lineage ends here. `discard` deletes it when nothing reads it any more."""
    bounded_batches(df.sparkSession)
    path = f"{scratch_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _paths.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def stored_paths(spark: SparkSession) -> list[str]:
    """Paths of the tables that this application stored and has not discarded, oldest first."""
    return list(_paths.get(spark.sparkContext.applicationId, []))


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Deletes stored tables (or their paths) that no later step reads; one that is gone already does no harm."""
    files, known = spark._jvm.org.apache.hadoop.fs, _paths.get(spark.sparkContext.applicationId, [])
    for path in (t if isinstance(t, str) else t.stored_path for t in tables):
        place = files.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in known:
            known.remove(path)


def with_totals(rows: DataFrame, by: list[str], place: list[str], totals: dict[str, tuple[Column, Callable]], where: str = "true") -> DataFrame:
    """rows with totals of their groups (equal `by`, no nulls), of groups that `where` holds for.

    The rows of a group are dealt over GROUP_PARTS by a hash of the columns `place`, totalled by part, and met by the
    totals of their group in each part: a group of a third of all rows goes through many tasks. totals: name ->
    (total of a part, function that makes the group's total of those). rows: stored, so that `place` stays the same.
    """
    dealt = rows.withColumn("group_part", F.pmod(F.xxhash64(*place), F.lit(GROUP_PARTS)))
    parts = dealt.groupBy(*by, "group_part").agg(*[total.alias(name) for name, (total, _) in totals.items()])
    group = Window.partitionBy(*by)
    whole = parts.select(*by, "group_part", *[combine(name).over(group).alias(name) for name, (_, combine) in totals.items()])
    return dealt.join(whole.filter(where), [*by, "group_part"]).drop("group_part")


def lowered(text):
    """Text with A-Z folded and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` text bytes (always one row at least), nulls as ''."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        if batch.column(at).null_count:
            batch = batch.set_column(at, column, batch.column(at).fill_null(""))
        ends = offsets_of(batch.column(at))
        begin = 0
        while begin < batch.num_rows:
            stop = max(begin + 1, int(ends.searchsorted(ends[begin] + limit, "right")) - 1)
            yield batch.slice(begin, stop - begin)
            begin = stop
    hand_back()


def hand_back() -> None:
    """Returns freed memory to the system at the end of a task: Spark keeps its Python workers for later ones."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def offsets_of(column: pa.Array):
    """Byte offsets of a string column, from 0."""
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return raw - raw[0]


def bytes_of(column: pa.Array):
    """The UTF-8 bytes of a string column without nulls, as uint8, and the offsets of its rows."""
    import numpy as np

    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or raw[0] == raw[-1]:
        return np.zeros(0, np.uint8), raw - raw[0]
    return np.frombuffer(column.buffers()[2], np.uint8)[raw[0] : raw[-1]], raw - raw[0]
