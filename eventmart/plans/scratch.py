"""Tables that a query or job keeps only while it runs."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

from eventmart.session import FREED, settings

#: Tables that each application stored and has not deleted.
_kept: dict[str, list[str]] = {}
_own_folders: dict[str, str] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder of spark.checkpoint.dir, deleted by `clear`. A local session without that folder gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folders.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="spark-")
        _own_folders[spark.sparkContext.applicationId] = folder
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    kept = _kept.setdefault(spark.sparkContext.applicationId, [])
    if not kept:
        atexit.register(_at_end, spark, kept)
    kept.append(path)
    return path


def materialized(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df written once as Parquet to the shared folder (to a place of `new_path`, if one is given) and read back.

    What is read several times is so computed once, survives lost executors, and plans of later steps begin here.
    """
    path = path or new_path(df.sparkSession, name)
    with settings(df.sparkSession, FREED):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes what stands at places of `new_path`, or in them, that no later step reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> int:
    """Deletes the tables that this application stored here, when nothing that was made of them is still to be read; their
    number. What is left when the application ends is deleted then."""
    kept = _kept.get(spark.sparkContext.applicationId, [])
    n = len(kept)
    while kept:
        discard(spark, kept.pop())
    return n


def _at_end(spark: SparkSession, kept: list[str]) -> None:
    with suppress(Exception):  # the session may be gone already
        if kept and spark.sparkContext._jsc is not None:
            clear(spark)
