"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for each document, the positions of the words that can take part in a match: words of
the test vocabulary in runs of them at least as long as the shortest test window. Its inverted form, rows
of (term, document, position), is joined with the rarest terms of each test window; the lists of the two
rarest terms, moved by their offsets, must meet on one diagonal (position minus offset) before the words
of that diagonal are compared. The vocabulary reaches the scan as a bit set of fixed size, so the test set
may be of any size, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import pieces, read_table, stored
from eventmart.llm.words import Words

#: Words of a window; a shorter item is one window.
WINDOW = 13
#: Words that one pass compares.
COMPARED = 1 << 20
#: Bits of the vocabulary sets that are sent to the scan.
VOCABULARY_BITS = 20


def item_table(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """item_row, item, words, cells (hash cells of the words) and m (words of a window); items without words are left out."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            bounds = pa.array(w.rows.astype(np.int32))
            words = pa.ListArray.from_arrays(bounds, pa.array(w.strings(np.arange(len(w))), pa.string()))
            cells = pa.ListArray.from_arrays(bounds, pa.array((w.hash >> np.uint64(64 - VOCABULARY_BITS)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("item"), words, cells], ["item", "words", "cells"])

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(split, "item string, words array<string>, cells array<int>")
    return stored(rows.filter(F.size("words") > 0).select(F.monotonically_increasing_id().alias("item_row"), "item", "words", "cells", F.least(F.size("words"), F.lit(window)).alias("m")), "items")


def build_index(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, min_run: int | None = None) -> DataFrame:
    """Per row of docs: row_id, key, n_words, pos and terms of its indexed words, stored once.

    min_run: shortest run of test words that is indexed, by default the shortest window (13 for words of
    long items alone); 1 indexes every test word, as proximity search needs.
    """
    bits = {}
    short = F.col("m") < window
    # at most 2 ** VOCABULARY_BITS rows of each kind
    for kind, rows in (("long", items.filter(~short)), ("short", items.filter(short))):
        bits[kind] = np.zeros(1 << VOCABULARY_BITS, bool)
        bits[kind][[r[0] for r in rows.select(F.explode("cells")).distinct().collect()]] = True
    shortest = items.filter(short).agg(F.min("m")).first()[0] or window
    least = {"long": min_run or window, "short": min_run or shortest}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            cell = w.hash >> np.uint64(64 - VOCABULARY_BITS)
            use = np.zeros(len(w), bool)
            for kind in bits:
                use |= long_runs(bits[kind][cell], w.rows, least[kind])
            at = np.flatnonzero(use)
            bounds = pa.array(np.searchsorted(at, w.rows).astype(np.int32))
            pos = pa.array((at - w.rows[:-1][w.row[at]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(w.rows)), pa.ListArray.from_arrays(bounds, pos), pa.ListArray.from_arrays(bounds, pa.array(w.strings(at), pa.string()))],
                ["key", "n_words", "pos", "terms"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(scan, f"key {kind}, n_words long, pos array<int>, terms array<string>")
    return stored(rows.select(F.monotonically_increasing_id().alias("row_id"), "*"), "postings")


def long_runs(on: np.ndarray, rows: np.ndarray, least: int) -> np.ndarray:
    """Where `on` holds for at least `least` neighbours in one row."""
    edge = np.zeros(len(on) + 1, bool)
    edge[rows] = True
    first = on.copy()
    first[1:] &= ~on[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    last = on.copy()
    last[:-1] &= ~on[1:] | edge[1:-1]
    ends = np.flatnonzero(last) + 1
    keep = ends - starts >= least
    step = np.zeros(len(on) + 1, np.int32)
    step[starts[keep]] += 1
    step[ends[keep]] -= 1
    return np.cumsum(step)[:-1] > 0


def postings(index: DataFrame) -> DataFrame:
    """The inverted form: term, row_id, pos."""
    return index.select("row_id", F.explode(F.arrays_zip("terms", "pos")).alias("p")).select("p.terms", "row_id", "p.pos").withColumnRenamed("terms", "term")


def rarest_terms(index: DataFrame, items: DataFrame) -> DataFrame:
    """Per window of each item: item_row, first word of the window, and its two rarest terms with offsets.

    Windows with a term that occurs nowhere are left out; `second` is null for windows of one word. Windows slide
    over the rows of an item, so that an item of any length costs what its words cost.
    """
    counts = postings(index).groupBy("term").count()
    terms = items.select("item_row", "m", F.size("words").alias("n_words"), F.posexplode("words").alias("off", "term")).join(counts, "term", "left")
    term = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "off", "term")
    longest = items.agg(F.max("m")).first()[0] or 1
    ahead = Window.partitionBy("item_row").orderBy("off").rowsBetween(0, longest - 1)  # a window that is shorter is its whole item
    ranked = terms.select("item_row", "m", "n_words", F.col("off").alias("first"), F.array_sort(F.collect_list(term).over(ahead)).alias("r")).filter(F.col("first") + F.col("m") <= F.col("n_words"))
    return ranked.filter(F.col("r")[0]["n"] > 0).select("item_row", "first", F.col("r")[0].alias("rarest"), F.get("r", F.lit(1)).alias("second"))


def term_hits(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Postings of the chosen terms: row_id, item_row, off and diag (position minus offset)."""
    chosen = windows.select("item_row", F.explode(F.array("rarest", "second")).alias("t")).filter("t IS NOT NULL").select("item_row", "t.off", "t.term").distinct()
    return postings(index).join(chosen, "term").select("row_id", "item_row", "off", (F.col("pos") - F.col("off")).alias("diag"))


def phrase_matches(index: DataFrame, items: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Exact occurrences of windows: row_id, item, and maximal stretches [first, stop) of words that they cover on one diagonal."""
    windows = stored(rarest_terms(index, items), "windows") if windows is None else windows
    hits = stored(term_hits(index, windows), "hits", compression="zstd")
    needed = windows.select("item_row", F.col("rarest.off").alias("off"), F.col("second.off").alias("other")).distinct()
    met = hits.join(needed, ["item_row", "off"]).select("row_id", "item_row", "diag", F.coalesce("other", "off").alias("off"))
    candidates = met.join(hits, ["row_id", "item_row", "diag", "off"], "left_semi").select("row_id", "item_row", "diag").distinct()
    # a document's terms go on once for each item that it may hold, however many diagonals they meet on
    grouped = candidates.groupBy("row_id", "item_row").agg(F.array_sort(F.collect_list("diag")).alias("diags"))
    near = grouped.join(index.select("row_id", "pos", "terms"), "row_id").join(items.select("item_row", "item", "words", "m"), "item_row").select("row_id", "item", "m", "diags", "words", "pos", "terms")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                m, diags, pos = batch.column("m")[k].as_py(), _values(batch, "diags", k).to_numpy(), _values(batch, "pos", k).to_numpy()
                words = _values(batch, "words", k)
                known = pc.unique(words)
                wanted, terms = (pc.index_in(x, known).fill_null(-1).to_numpy() for x in (words, _values(batch, "terms", k)))
                found = []
                step = max(1, COMPARED // len(wanted))
                for i in range(0, len(diags), step):
                    found.append(runs_on(diags[i : i + step], pos, terms, wanted, m))
                first, size = (np.concatenate(x) for x in zip(*found, strict=True))
                if len(first):
                    of = pa.array(np.full(len(first), k))
                    yield pa.RecordBatch.from_arrays([batch.column("row_id").take(of), batch.column("item").take(of), pa.array(first.astype(np.int32)), pa.array((first + size).astype(np.int32))], ["row_id", "item", "first", "stop"])

    return near.mapInArrow(compare, "row_id long, item string, first int, stop int")


def _values(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def runs_on(diags: np.ndarray, pos: np.ndarray, terms: np.ndarray, wanted: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the runs of at least m equal words at neighbouring positions, on each diagonal. pos: sorted
    positions of the document's terms; terms, wanted: numbers of its words and of the item's."""
    low, high = np.searchsorted(pos, diags), np.searchsorted(pos, diags + len(wanted))
    n = high - low
    row = np.repeat(np.arange(len(diags)), n)
    at = np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)
    same = terms[at] == wanted[pos[at] - diags[row]]
    at, row = pos[at[same]].astype(np.int64), row[same]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    return at[first[size >= m]], size[size >= m]


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 5, least: float = 1.0) -> DataFrame:
    """Near occurrences: row_id, key, item and the window's first word, where of a window's words at least the share
    `least` stand within `slop` words of their places beside its rarest term. The index needs min_run=1."""
    windows = stored(rarest_terms(index, items), "windows")
    words = items.select("item_row", "m", F.posexplode("words").alias("off", "term"))
    anchor = windows.select("item_row", F.col("rarest.off").alias("off"), F.col("rarest.term").alias("term")).distinct()
    places = postings(index).join(anchor, "term").select("row_id", "item_row", "off", F.col("pos").alias("at"))
    beside = windows.select("item_row", "first", F.col("rarest.off").alias("anchor")).join(words, "item_row").filter((F.col("off") >= F.col("first")) & (F.col("off") < F.col("first") + F.col("m")))
    wanted = beside.select("item_row", "first", "m", F.col("anchor").alias("off"), F.col("off").alias("word"), "term")
    # positions are dealt to cells of the tolerance, so that each word looks at the few near its place
    cell = 2 * slop + 1
    near = places.join(wanted, ["item_row", "off"]).withColumn("due", F.col("at") + F.col("word") - F.col("off")).withColumn("cell", F.explode(F.array(F.expr(f"(due - {slop}) div {cell}"), F.expr(f"(due + {slop}) div {cell}"))))
    found = near.join(postings(index).withColumn("cell", F.expr(f"pos div {cell}")), ["row_id", "term", "cell"]).filter(F.abs(F.col("pos") - F.col("due")) <= slop)
    hit = found.groupBy("row_id", "item_row", "first", "m", "at").agg(F.countDistinct("word").alias("n")).filter(F.col("n") >= F.ceil(F.lit(least) * F.col("m")))
    return hit.select("row_id", "item_row", "first").distinct().join(index.select("row_id", "key"), "row_id").join(items.select("item_row", "item"), "item_row").select("row_id", "key", "item", "first")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """One row per row of docs: key, n_words, n_hit, n_items, items_sha256, contaminated, and with slop also n_near.

    n_near: items of which all words of a window stand within `slop` words of their places (proximity matches).

    Null text has no words, and a text without words is clean; null item ids count as one item ''. Repeated
    rows are judged one by one. An empty table of either kind gives clean rows or no rows. Other columns
    are not read.
    """
    items = item_table(benchmark, item_key, item_text, window)
    index = build_index(docs, items, key, text, window, None if slop is None else 1)
    found = phrase_matches(index, items)
    ordered = Window.partitionBy("row_id").orderBy("first", "stop")
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest("first", F.coalesce(F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    hits = found.select("row_id", "first", "stop").distinct().withColumn("new", new).groupBy("row_id").agg(F.sum("new").alias("n_hit"))
    named = found.select("row_id", F.coalesce("item", F.lit("")).alias("item")).distinct().groupBy("row_id").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    per_row = hits.join(named, "row_id")
    out = index.select("row_id", "key", "n_words").join(per_row, "row_id", "left")
    if slop is not None:
        near = proximity_matches(index, items, slop).select("row_id", F.coalesce("item", F.lit("")).alias("item")).distinct().groupBy("row_id").agg(F.count("*").alias("n_near"))
        out = out.join(near, "row_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        *[F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")] * (slop is not None),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 13) AS m, unnest(list_transform(range(len(w) - least(len(w), 13) + 1), lambda i: list_slice(w, i + 1, i + least(len(w), 13)))) AS g FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, unnest(range(len(w) - m + 1)) AS p, w FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT DISTINCT doc_id, p, dw.m, item_id FROM dw JOIN win ON win.m = dw.m AND win.g = list_slice(w, p + 1, p + dw.m)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
