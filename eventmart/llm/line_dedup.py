"""Removal of repeated runs of lines by winnowing.

Of every window of `run` lines the smallest hash of neighbouring lines (the rightmost of equal ones) is selected as a
fingerprint, with its place. Equal runs select equal fingerprints at the same place within them, so a run that occurs
twice has a fingerprint with two places; places of other fingerprints are dropped without comparing anything else.
Around the places that are left, the match is extended both ways, line by line up to the length of a run, and what
agrees with an earlier place (by 128 bits of its lines) is deleted; the first in document order stays. Longer matches
are chains of such runs, so all of their lines go.

Passages (op7_passage_dedup) are stretches of any number of lines, one included, with at least LEAST_WORDS
words. Their windows are the shortest such stretches from each line and up to each line: equal passages are
made of equal windows, and these cover all their lines, so matches reach as far to both sides as the lines agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bytes_of, pieces, read_table, stored, with_totals
from eventmart.llm.words import SPACED, Sequences, mixed, string_hash

#: Lines of a repeated run, and of a hashed gram within it.
RUN, GRAM = 3, 2
#: Words (between white space) of a repeated passage.
LEAST_WORDS = 50


def line_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row_id, key and lines of each row, stored once."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    return stored(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).alias("key"), lines.alias("lines")), "lines", compression="zstd")


def line_hashes(lines: DataFrame, run: int = RUN) -> DataFrame:
    """row_id, key, and two independent hashes (h, g) of every line, 128 bits together, of rows that have a run at all. Stored once."""
    hashes = [F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.xxhash64(F.lit(7), x)).alias("g")]
    return stored(lines.filter(F.size("lines") >= run).select("row_id", "key", *hashes), "line-hashes", compression="zstd")


def fingerprints(hashed: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """Window minima: fingerprint and place of the smallest hash of `gram` neighbours in each window of `run` lines."""
    grams = F.transform(F.sequence(F.lit(0), F.size("h") - gram), lambda i: F.struct(F.xxhash64(F.slice("h", i + 1, gram)).alias("hash"), (-i).alias("back")))
    minima = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("h") - run), lambda i: F.array_min(F.slice("grams", i + 1, run - gram + 1))))
    return hashed.select("row_id", "h", grams.alias("grams")).select("row_id", F.explode(minima).alias("f")).select("row_id", F.col("f.hash").alias("fingerprint"), (-F.col("f.back")).alias("place"))


def extended(hashed: DataFrame, places: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """The matches around each place extended both ways: every run of lines that holds it, as row_id, key, first, last, run_a and run_b (its 128 bits)."""
    reach = lambda p: F.sequence(F.greatest(F.lit(0), p - (run - gram)), F.least(p, F.size("h") - run))
    firsts = F.array_distinct(F.flatten(F.transform("places", reach)))
    rows = hashed.join(places.groupBy("row_id").agg(F.collect_list("place").alias("places")), "row_id").select("row_id", "key", "h", "g", F.explode(firsts).alias("first"))
    return rows.select("row_id", "key", "first", (F.col("first") + run - 1).alias("last"), *[F.xxhash64(F.slice(c, F.col("first") + 1, run)).alias(name) for c, name in (("h", "run_a"), ("g", "run_b"))])


def shared_places(places: DataFrame) -> DataFrame:
    """Places (row_id, fingerprint, place, and more columns) whose fingerprint has another place too."""
    twice = places.select("fingerprint", "row_id", "place").distinct().groupBy("fingerprint").count().filter("count > 1").select("fingerprint")
    return places.join(twice, "fingerprint", "left_semi")


def later_runs(runs: DataFrame) -> DataFrame:
    """row_id, first and last line of the runs that occurred before. runs: stored, each place once."""
    totals = {"one": (F.min(F.struct("key", "row_id", "first")), F.min), "n": (F.count("*"), F.sum)}
    later = with_totals(runs, ["run_a", "run_b"], ["row_id", "first"], totals, "n > 1").filter((F.col("row_id") != F.col("one.row_id")) | (F.col("first") != F.col("one.first")))
    return later.select("row_id", "first", "last")


def repeated_lines(lines: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """row_id and sorted line numbers (gone) of the lines of later runs."""
    hashed = line_hashes(lines, run)
    places = shared_places(stored(fingerprints(hashed, run, gram), "fingerprints", compression="zstd"))
    later = later_runs(stored(extended(hashed, places, run, gram), "runs", compression="zstd"))
    return later.select("row_id", F.explode(F.sequence("first", "last")).alias("line")).groupBy("row_id").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def without_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """One row per row of docs: key, n_lines, n_removed, n_runs (stretches of removed lines), kept_text.

    Lines end at line feeds; null text counts as empty, one empty line. A run of lines is deleted where it
    occurred before: in a smaller key (null first), in an earlier row of the same key, or further up in the
    same text. Texts of fewer lines than a run stay. An empty table gives an empty result; other columns
    are not read.
    """
    lines = line_table(docs, key, text)
    both = lines.join(repeated_lines(lines, run), "row_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    begins = F.filter("gone", lambda x, i: (i == 0) | (F.get("gone", i - 1) != x - 1))
    ends = F.filter("gone", lambda x, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) != x + 1))
    cut = both.withColumns({"begins": begins, "ends": ends})
    start = lambda k: F.when(k == 0, 0).otherwise(F.get("ends", k - 1) + 1)
    stop = lambda k: F.coalesce(F.get("begins", k), F.size("lines"))
    between = F.flatten(F.transform(F.sequence(F.lit(0), F.size("begins")), lambda k: F.slice("lines", start(k) + 1, stop(k) - start(k))))
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(between)
    return cut.select(F.col("key").alias(key), F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"), F.size("begins").cast("long").alias("n_runs"), F.array_join(kept, "\n").alias("kept_text"))


class Lines:
    """The lines of a column without nulls. starts, ends: bytes of each line; rows: first line of each row (one more
    than rows); before, after: words of the column before and up to the end of each line; a, b: two independent hashes of each."""

    def __init__(self, column: pa.Array):
        data, offsets = bytes_of(column)
        breaks = np.flatnonzero(data == 10)
        self.rows = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
        self.starts, self.ends = np.zeros(self.rows[-1], np.int64), np.zeros(self.rows[-1], np.int64)
        head, tail = np.zeros(self.rows[-1], bool), np.zeros(self.rows[-1], bool)
        head[self.rows[:-1]] = tail[self.rows[1:] - 1] = True
        self.starts[head], self.starts[~head] = offsets[:-1], breaks + 1
        self.ends[tail], self.ends[~tail] = offsets[1:], breaks
        spaced = SPACED[data]
        inner = np.zeros(len(data) + 1, bool)
        inner[1:] = spaced
        inner[offsets] = False
        words = np.concatenate([[0], np.cumsum(spaced & ~inner[:-1])])
        self.before, self.after = words[self.starts], words[self.ends]
        self.a, self.b = (string_hash(data, self.starts, self.ends, seed) for seed in (1, 2))

    @property
    def row(self) -> np.ndarray:
        """The row of each line."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def windows(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last line of the shortest stretches of at least `least` words from each line and up to each line."""
        line, row = np.arange(len(self.starts)), self.row
        stop = np.searchsorted(self.after, self.before + least)
        begin = np.searchsorted(self.before, self.after - least, "right") - 1
        on, up = stop < self.rows[1:][row], begin >= self.rows[:-1][row]
        first, last = np.concatenate([line[on], begin[up]]), np.concatenate([stop[on], line[up]])
        order = np.lexsort((last, first))
        first, last = first[order], last[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
        return first[new], last[new]

    def fingerprints(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest hash of a pair of neighbours in each window (the rightmost of equal ones) and its line; of one line, its own."""
        value, place = mixed(~self.a[first]), first.copy()
        pair = mixed(mixed(self.a[:-1]) + self.a[1:])
        order = np.lexsort((-np.arange(len(pair)), pair))
        least = np.zeros(len(pair), np.int64)
        least[order] = np.arange(len(pair))
        size, span = last - first, 1
        while (size >= span).any():  # least[i] is the rank of the smallest of pairs i to i + span - 1
            now = np.flatnonzero((size >= span) & (size < 2 * span))
            place[now] = order[np.minimum(least[first[now]], least[last[now] - span])]
            value[now] = pair[place[now]]
            least[: len(least) - span] = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        return value, place


def winnowed_passages(texts: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The windows of `least` words of each row (row_id, key, text): row_id, key, first and last line, run_a and run_b (two independent hashes of its lines), fingerprint and place."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = Lines(batch.column("text"))
            first, last = x.windows(least)
            row = x.row[first]
            value, place = x.fingerprints(first, last)
            columns = [Sequences(h, seed).hash(first, last + 1).view(np.int64) for seed, h in ((1, x.a), (2, x.b))] + [value.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(pa.array(row)), batch.column("key").take(pa.array(row)), *(pa.array((c - x.rows[row]).astype(np.int32)) for c in (first, last)), *map(pa.array, columns), pa.array((place - x.rows[row]).astype(np.int32))],
                ["row_id", "key", "first", "last", "run_a", "run_b", "fingerprint", "place"],
            )

    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(scan, f"row_id long, key {kind}, first int, last int, run_a long, run_b long, fingerprint long, place int")


def without_repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """One row per row of docs: key, n_lines, n_removed, n_runs (stretches of removed lines), kept_text.

    Any stretch of whole lines with at least `least` words is deleted where it occurred before; order, nulls and
    empty tables as in without_repeated_runs.
    """
    texts = stored(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).alias("key"), F.col(text).alias("text")), "texts", compression="zstd")
    windows = stored(winnowed_passages(texts, least), "passages", compression="zstd")
    later = later_runs(stored(shared_places(windows), "met", compression="zstd"))
    gone = later.groupBy("row_id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for whole, firsts, lasts in zip(*(batch.column(c).to_pylist() for c in ("text", "firsts", "lasts")), strict=True):
                if firsts is None:
                    out.append((whole.count("\n") + 1, 0, 0, whole))
                    continue
                lines = whole.split("\n")
                step = np.zeros(len(lines) + 1, np.int64)
                np.add.at(step, firsts, 1)
                np.add.at(step, np.array(lasts) + 1, -1)
                on = np.cumsum(step)[:-1] > 0
                out.append((len(lines), int(on.sum()), int(on[0]) + int((on[1:] & ~on[:-1]).sum()), "\n".join(x for x, o in zip(lines, on.tolist(), strict=True) if not o)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["key", "n_lines", "n_removed", "n_runs", "kept_text"])

    kind = docs.schema[key].dataType.simpleString()
    both = texts.join(gone, "row_id", "left").select("key", "text", "firsts", "lasts")
    return both.mapInArrow(cut, f"key {kind}, n_lines long, n_removed long, n_runs long, kept_text string").withColumnRenamed("key", key)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_runs(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_passages(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
t AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d),
g AS (SELECT doc_id, pos, row(line, lead(line) OVER w, lead(line, 2) OVER w) AS run, lead(pos, 2) OVER w AS last FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k FROM g WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM r WHERE k > 1),
m AS (SELECT t.doc_id, t.pos, t.line, gone.pos IS NOT NULL AS out FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.pos = t.pos),
e AS (SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM m)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed, count(*) FILTER (WHERE begins) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT out), '')) AS kept_sha256
FROM e GROUP BY doc_id
"""
