"""Removal of repeated 200-byte strings by content-chosen anchors, hashed and grouped.

No suffix is sorted and no common prefix is carried: an external induced sort does not fit the disk that the job is
given (README). Instead each 200-byte string is assigned the one place (anchor) that its content selects, the smallest
hash of the `gram` bytes at any of its positions. A row for each anchor carries the hash of its gram, its reach (the
strings assigned to it) and the name (hash) of the text in that reach, and Spark groups the rows. Where a name
occurs twice all strings of its reach repeat, and nothing inside them is compared again. Only where one gram
stands in different surroundings are the strings around it named and counted themselves, first in blocks of eight and
then one by one. No text is held beside another one, and a shard may be of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bytes_of, discard, pieces, read_table, stored
from eventmart.llm.words import mixed, powers, prefix_hash, span_hash

#: Bytes of a repeated string, and of the gram that selects its anchor.
LENGTH, GRAM = 200, 64
#: Keys of rows that may be broadcast (16 bytes each).
BROADCAST_ROWS = 500_000
#: Slices whose strings one pass holds.
SLICES = 2_000
#: Bytes of a document that one pass holds; longer ones are cut into overlapping parts.
PART = 1 << 19

_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Anchors:
    """Anchors of one piece of text (several documents, as bytes and offsets).

    at: place of each anchor; first, last: its reach, the starts of the strings assigned to it; row: its
    document; gram, name: hashes of its gram and of the text in its reach.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
        self.prefix = h = prefix_hash(data)
        self.length = length
        n = len(data)
        starts = np.arange(max(0, n - length + 1))
        grams = mixed((h[gram:] - h[: n - gram + 1]) * powers(_BACK, n + 1)[: n - gram + 1]) if n >= gram else np.zeros(0, np.uint64)
        best = window_minimum(grams, length - gram + 1)[: len(starts)]
        valid = np.ones(len(starts), bool)
        for cut in offsets[1:-1]:  # strings that span two documents
            valid[max(0, cut - length + 1) : cut] = False
        starts = starts[valid]
        chosen = best[valid]
        new = np.ones(len(starts), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
        self.first = starts[new]
        self.last = starts[np.flatnonzero(np.append(new[1:], True))] if len(starts) else starts
        self.at = chosen[new]
        self.row = np.searchsorted(offsets, self.first, "right") - 1
        self.gram = grams[self.at]
        self.name = span_hash(h, self.first, self.last + length)

    def strings(self, first: np.ndarray) -> np.ndarray:
        """Hashes of the strings that begin there."""
        return span_hash(self.prefix, first, first + self.length)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every `width` neighbours, the leftmost of equal ones (by the upper 40 bits)."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << 24) - 1)
    size = -(-n // width) * width
    keyed = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    keyed[:n] = (values & ~mask) | np.arange(n, dtype=np.uint64)
    blocks = keyed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & mask).astype(np.int64)


def parts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Batches with their bytes, offsets and the place where the bytes begin in a document that is cut."""
    for batch in pieces(batches, limit=PART):
        data, offsets = bytes_of(batch.column("text"))
        if len(data) <= 2 * PART:
            yield batch, data, offsets, 0
        else:
            for begin in range(0, len(data) - length + 1, PART):
                cut = data[begin : begin + PART + length - 1]
                yield batch, cut, np.array([0, len(cut)]), begin


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One tuple for each anchor, stored once: id, its row (key, digest), gram and name, its place and its reach [first, last]."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, begin in parts(batches, length):
            a = Anchors(data, offsets, length, gram)
            row = pa.array(a.row)
            name = mixed(a.name + (a.at - a.first).astype(np.uint64) * _BACK)  # equal names: equal text, anchored at one place
            first = (a.first - offsets[a.row] + begin).astype(np.int64)
            columns = [batch.column("key").take(row), batch.column("digest").take(row), *(pa.array(c) for c in (a.gram.view(np.int64), name.view(np.int64), first + a.at - a.first, first, first + a.last - a.first))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "digest", "gram", "name", "at", "first", "last"])

    rows = docs.mapInArrow(scan, f"key {docs.schema['key'].dataType.simpleString()}, digest long, gram long, name long, at long, first long, last long")
    return stored(rows.select(F.monotonically_increasing_id().alias("id"), "*"), "anchors", compression="zstd")


def surroundings(anchors: DataFrame) -> DataFrame:
    """Each (gram, name) that matters: n places, one of them (id), and whether its strings must be induced."""
    names = anchors.groupBy("gram", "name").agg(F.count("*").alias("n"), F.min("id").alias("one"))
    grams = names.groupBy("gram").agg(F.count("*").alias("names"), F.min("n").alias("fewest"))
    both = names.join(grams, "gram").withColumn("induce", F.expr("names > 1 AND fewest = 1"))
    return both.filter("n > 1 OR induce").select("gram", "name", "n", "one", "induce")


def same_row(a: DataFrame, b: DataFrame):
    """Joins rows by key (null equals null) and digest of the whole text."""
    return a["key"].eqNullSafe(b["key"]) & (a["digest"] == b["digest"])


def rows_of(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs whose (key, digest) is wanted, and the others. Up to BROADCAST_ROWS keys are broadcast, more are shuffled."""
    keys = wanted.select("key", "digest").distinct()
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return docs.join(keys, same_row(docs, keys), "left_semi"), docs.join(keys, same_row(docs, keys), "left_anti")


def induced_slices(docs: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The text in the reach of each chosen anchor: id, gram, key, digest, first, last, single and slice. Stored once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = bytes_of(batch.column("text"))
            raw = memoryview(data.tobytes())
            lists = batch.column("reach")
            n = lists.value_lengths().to_numpy()
            base, row, flat = np.repeat(offsets[:-1], n), pa.array(np.repeat(np.arange(batch.num_rows), n)), lists.flatten()
            first, last = base + flat.field("first").to_numpy(), base + flat.field("last").to_numpy()
            slices = [bytes(raw[a : b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            own = [flat.field(c) for c in ("id", "gram", "at", "first", "single")]
            yield pa.RecordBatch.from_arrays([*own, batch.column("key").take(row), batch.column("digest").take(row), pa.array(slices, pa.binary())], ["id", "gram", "at", "first", "single", "key", "digest", "slice"])

    lists = chosen.groupBy("key", "digest").agg(F.collect_list(F.struct("id", "gram", "at", "first", "last", "single")).alias("reach"))
    some = rows_of(docs, lists)[0]
    rows = some.join(lists, same_row(some, lists)).select(some["key"], some["digest"], "text", "reach")
    kind = docs.schema["key"].dataType.simpleString()
    return stored(rows.mapInArrow(cut, f"id long, gram long, at long, first long, single boolean, key {kind}, digest long, slice binary"), "slices", compression="zstd")


def induced(slices: DataFrame, length: int, block: int, only: bool = False) -> DataFrame:
    """The strings of each slice in blocks of equal distance to the anchor: slice (its id), gram, name, first, last, single.

    gram: hash of the anchor's gram and of the text that all strings of a full block share, so that no string of a block
    occurs under another gram; name: hash of the block's whole text. only: the slices have the starts [a, b] to induce.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICES) for b in batches for i in range(0, b.num_rows, SLICES)):
            data, offsets = bytes_of(batch.column("slice"))
            h = prefix_hash(data)
            first, at = batch.column("first").to_numpy(), batch.column("at").to_numpy()
            a = batch.column("a").to_numpy() if only else first
            b = batch.column("b").to_numpy() if only else first + np.diff(offsets) - length
            low, high = (at - b) // block, (at - a) // block  # blocks by distance to the anchor
            n = high - low + 1
            of = np.repeat(np.arange(len(n)), n)
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + low[of]
            begin, end = np.maximum(a[of], at[of] - k * block - block + 1), np.minimum(b[of], at[of] - k * block)
            move = (offsets[:-1] - first)[of]
            core = span_hash(h, at[of] - k * block + move, at[of] - k * block - block + 1 + length + move)
            gram = mixed(core + batch.column("gram").to_numpy().view(np.uint64)[of] * _BACK + k.astype(np.uint64))
            name = mixed(span_hash(h, begin + move, end + length + move) + (at[of] - end).astype(np.uint64) * _BACK)
            row = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(row), pa.array(gram.view(np.int64)), pa.array(name.view(np.int64)), pa.array(begin), pa.array(end), batch.column("single").take(row)],
                ["slice", "gram", "name", "first", "last", "single"],
            )

    return slices.mapInArrow(split, "slice long, gram long, name long, first long, last long, single boolean")


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = 8) -> tuple[DataFrame, list[DataFrame]]:
    """Stretches [first, last] of starts of strings that also start elsewhere: key, digest, first, last; and the stored
    tables that they are read from. Tables that only lead to these are deleted on the way."""
    spark = docs.sparkSession
    anchors = anchor_table(docs, length, gram)
    found = stored(anchors.join(surroundings(anchors), ["gram", "name"]), "found", compression="zstd")
    discard(spark, anchors)
    spans = found.filter("n > 1").select("key", "digest", "first", "last")
    slices = induced_slices(docs, found.filter("induce AND (n = 1 OR id = one)").withColumn("single", F.col("n") == 1), length)
    blocks = stored(induced(slices, length, block).select(F.monotonically_increasing_id().alias("id"), "*"), "blocks", compression="zstd")
    met = stored(blocks.join(surroundings(blocks), ["gram", "name"]), "found-blocks", compression="zstd")
    discard(spark, blocks)
    some = met.filter("induce AND (n = 1 OR id = one)").select(F.col("slice").alias("id"), F.col("first").alias("a"), F.col("last").alias("b"))
    strings = stored(induced(slices.join(some, "id"), length, 1, only=True), "strings", compression="zstd")
    twice = strings.groupBy("gram", "name").count().filter("count > 1")
    inner = met.filter("n > 1 AND single").select("slice", "first", "last").union(strings.filter("single").join(twice, ["gram", "name"]).select("slice", "first", "last"))
    return spans.union(inner.join(slices.select("id", "key", "digest"), inner["slice"] == slices["id"]).select("key", "digest", "first", "last")), [found, slices, met, strings]


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per row of docs: key, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes.

    Every byte covered by a string of `length` bytes that also starts anywhere else is removed, in all of its
    places; texts shorter than that stay. Null text counts as empty. A row that repeats another one repeats
    all of its strings. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))
    starts, read = repeated_starts(rows, length, gram)
    # rows that repeat a text have its stretches once
    spans = stored(starts.distinct().groupBy("key", "digest").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans", compression="zstd")
    discard(docs.sparkSession, *read)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            lists = batch.column("spans")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            firsts, lasts = lists.flatten().field("first").to_numpy(), lists.flatten().field("last").to_numpy()
            for i, text in enumerate(batch.column("text")):
                data = text.as_buffer().to_pybytes()
                order = np.argsort(firsts[ends[i] : ends[i + 1]], kind="stable")
                first, stop = firsts[ends[i] : ends[i + 1]][order], np.maximum.accumulate(lasts[ends[i] : ends[i + 1]][order] + length)
                new = np.append(True, first[1:] > stop[:-1])
                begin, end = first[new].tolist(), stop[np.append(new[1:], True)].tolist()
                kept = b"".join(data[a:b] for a, b in zip([0, *end], [*begin, len(data)], strict=True))
                out.append((len(data), len(data) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns[: 5 if with_text else 4]], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_text else 5])

    some, rest = rows_of(rows, spans)
    kind = docs.schema[key].dataType.simpleString()
    changed = some.join(spans, same_row(some, spans)).select(some["key"], "text", "spans").mapInArrow(remove, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
    zero = F.lit(0).cast("long")
    same = rest.select("key", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), *[F.col("text").cast("binary").alias("kept")] * with_text)
    return changed.union(same).withColumnRenamed("key", key)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents"))
