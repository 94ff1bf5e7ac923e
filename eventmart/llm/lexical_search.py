"""Ranked lexical search over an inverted index in segments, by term-at-a-time and document-at-a-time scoring combined.

A segment is the inverted form of some megabytes of documents: distinct terms, and for each the list of its documents, in
order, with the term's occurrences. Segments are built where the documents are read and stored once; no text is
shuffled. Queries come in blocks of bounded size, whose terms and weights go to every segment:

1. Term at a time, the short lists of a query are added up to accumulators. Together they count as one more list,
   whose largest sum bounds what it can add to a document.
2. Document at a time, that list and the long ones are walked together. The score that the tenth best document has so
   far splits them: lists whose bounds together stay below it cannot bring in a document, they are only looked up for
   documents of the others, and only while a document can still reach that score. The score carries over from one
   segment of a task to the next.

Each task sends its best documents of each query, and Spark ranks those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import bounded_batches, discard, hand_back, pieces, read_table, stored
from eventmart.llm.words import Words

#: Documents that are returned for a query.
BEST = 10
#: Bytes of text of a segment, and terms of the queries that are answered in one pass over the index.
SEGMENT_BYTES, BLOCK_TERMS = 8 << 20, 200_000
#: Options of the segments' files: a row group for each segment. Else a writer holds the first hundred rows before it looks at their size, and
#: a reader takes all segments of a row group at once.
SEGMENT_FILES = {"compression": "zstd", "parquet.block.row.count.limit": "1"}
#: Lists count as short, from the shortest on, while they together have at most 1 / SHORT of a segment's documents.
SHORT = 4
#: Documents that one step of the walk looks at.
STEP = 4096
#: Groups of tasks' results that are ranked before all are.
PARTS = 64

# Of the score.
UNIT, FLAT, SLOPE, DAMP, SCALE = 1_000, 10, 90, 8, 1_000_000_000


def weight(n: int, df: int) -> int:
    """Of a term that df of n documents hold."""
    return math.floor(UNIT * math.log((2 * n + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents of n terms each."""
    if len(n) and SLOPE * int(n.max()) * documents >= 1 << 63:
        return np.array([FLAT + SLOPE * int(v) * documents // terms for v in n], np.int64)
    return FLAT + SLOPE * n * documents // max(1, terms)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The segments, stored: keys and n (terms) of their documents, sorted hashes of their terms, and lists, where those
    of term k are docs and tfs from bounds[k] to bounds[k + 1]. Documents without terms are in none."""
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size = rows = 0
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            n = np.diff(w.rows)
            some = np.flatnonzero(n)
            if len(some):
                hash, row, tf = counted(w.hash, np.repeat(np.arange(len(some)), n[some]))
                held.append((batch.column("key").take(pa.array(some)), n[some], hash, row + rows, tf))
                rows, size = rows + len(some), size + len(w.data)
            if size >= SEGMENT_BYTES:
                yield segment(held)
                held, size, rows = [], 0, 0
        if held:
            yield segment(held)
        del held
        hand_back()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"documents long, terms long, keys array<{kind}>, n array<int>, hashes array<long>, bounds array<int>, docs array<int>, tfs array<int>"
    return stored(rows.mapInArrow(scan, schema), "segments", **SEGMENT_FILES)


def counted(hash: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, row), in that order, and how often each occurs."""
    order = np.lexsort((row, hash))
    hash, row = hash[order], row[order]
    new = np.append(True, (hash[1:] != hash[:-1]) | (row[1:] != row[:-1]))[: len(hash)]
    at = np.flatnonzero(new)
    return hash[at], row[at].astype(np.int32), np.diff(np.append(at, len(hash))).astype(np.int32)


def segment(held: list) -> pa.RecordBatch:
    keys = pa.concat_arrays([h[0] for h in held])
    n, hash, row, tf = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4))
    order = np.argsort(hash, kind="stable")  # pieces follow each other, so rows stay in order
    hash = hash[order]
    first = np.flatnonzero(np.append(True, hash[1:] != hash[:-1]))
    lists = [keys, pa.array(n.astype(np.int32)), pa.array(hash[first].view(np.int64)), pa.array(np.append(first, len(hash)).astype(np.int32)), pa.array(row[order]), pa.array(tf[order])]
    one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
    return pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64()), pa.array([int(n.sum())], pa.int64()), *one], ["documents", "terms", "keys", "n", "hashes", "bounds", "docs", "tfs"])


def query_table(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item_row, item and the hashes of its distinct terms, stored; items without terms are left out."""
    kind = items.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            hash, row, _ = counted(w.hash, w.row)
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hash[order].view(np.int64)))], ["item", "terms"])

    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text")).mapInArrow(split, f"item {kind}, terms array<long>")
    return stored(rows.filter(F.size("terms") > 0).select(F.monotonically_increasing_id().alias("item_row"), "item", "terms"), "queries")


@dataclass
class Block:
    """Queries that are answered together: their rows, sorted distinct terms, and the numbers of each one's terms."""

    rows: list[int]
    terms: np.ndarray
    of: list[np.ndarray]
    weights: np.ndarray | None = None


def blocks_of(queries: DataFrame) -> Iterator[Block]:
    """The queries in blocks of about BLOCK_TERMS terms, gathered one after the other."""
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = -(-total // BLOCK_TERMS)
    for k in range(count):
        some = queries.filter(F.pmod(F.xxhash64("item_row"), F.lit(count)) == k).select("item_row", "terms").toArrow()  # about BLOCK_TERMS terms
        lists = some.column("terms").combine_chunks()
        terms, number = np.unique(lists.flatten().to_numpy().view(np.uint64), return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if len(lists) else [0]
        yield Block(some.column("item_row").to_pylist(), terms, [number[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the wanted values that are known, and their places among those (sorted)."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    on = np.flatnonzero(known[at] == wanted)
    return on, at[on]


def _list(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy()


def document_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each term."""
    sent = index.sparkSession.sparkContext.broadcast(terms)  # of one block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                on, at = _places(_list(batch, "hashes", i).view(np.uint64), sent.value)
                total[on] += np.diff(_list(batch, "bounds", i))[at]
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(total[on])], ["term", "df"])

    out = np.zeros(len(terms), np.int64)
    found = index.select("hashes", "bounds").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # the terms of a block
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


class Segment:
    """One segment under the terms of a block: for each of them that occurs its documents, what it adds to each, and the most that it adds."""

    def __init__(self, batch: pa.RecordBatch, row: int, block: Block, documents: int, terms: int):
        n = _list(batch, "n", row).astype(np.int64)
        self.size, self.keys = len(n), batch.column("keys")[row].values
        order = np.array(self.keys.to_pandas().sort_values(na_position="first", kind="stable").index)
        self.rank = np.empty(self.size, np.int64)  # place by key, null first
        self.rank[order] = np.arange(self.size)
        m = DAMP * lengths(n, documents, terms)
        bounds, docs, tfs = _list(batch, "bounds", row), _list(batch, "docs", row), _list(batch, "tfs", row)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        on, at = _places(_list(batch, "hashes", row).view(np.uint64), block.terms)
        for k, a, b in zip(on.tolist(), bounds[at].tolist(), bounds[at + 1].tolist(), strict=True):
            where, tf = docs[a:b], tfs[a:b].astype(np.int64)
            adds = int(block.weights[k]) * (SCALE * tf // (UNIT * tf + m[where]))
            self.lists[k] = (where, adds, int(adds.max()))

    def best(self, terms: np.ndarray, least: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the `best` documents that score at least `least`, which is above 0 (fewer, if there are fewer)."""
        lists = sorted((self.lists[k] for k in terms.tolist() if k in self.lists), key=lambda x: len(x[0]))
        sums, used = np.zeros(self.size, np.int64), 0
        while lists and (used := used + len(lists[0][0])) * SHORT <= self.size:
            where, adds, _ = lists.pop(0)
            sums[where] += adds
        lists.sort(key=lambda x: -x[2])
        # rest[j] is the most that the long lists from j on add
        rest = np.append(np.cumsum([x[2] for x in lists][::-1])[::-1], 0).astype(np.int64)
        found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = np.argsort(-sums, kind="stable")[: 4 * best]
        begin = begin[sums[begin] > 0]
        if len(begin) >= best:  # the fullest accumulators show what has to be reached
            least = max(least, int(np.sort(self.scored(begin, sums[begin], lists, rest, 0, least)[1])[::-1][best - 1 : best].max(initial=0)))
        for low in range(0, self.size, STEP):
            high = min(low + STEP, self.size)
            # lists that can bring in a document: the accumulators, and long ones while those after them reach `least`
            essential = int(np.searchsorted(-rest, -least, "right"))  # rest[essential] is below least
            near = sums[low:high].copy()
            seen = near > 0
            if not seen.any() and not essential:
                continue
            for where, adds, _ in lists[:essential]:
                a, b = np.searchsorted(where, (low, high))
                near[where[a:b] - low] += adds[a:b]
                seen[where[a:b] - low] = True
            docs = np.flatnonzero(seen)
            docs, scores = self.scored(docs + low, near[docs], lists, rest, essential, least)
            docs, scores = np.append(found[0], docs), np.append(found[1], scores)
            order = np.lexsort((self.rank[docs], -scores))[:best]
            found = docs[order], scores[order]
            if len(order) == best:
                least = max(least, int(found[1][-1]))
        return found

    def scored(self, docs: np.ndarray, scores: np.ndarray, lists: list, rest: np.ndarray, done: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents in order, and whole scores of those that reach `least`, from scores over all but the lists from `done` on."""
        if done == 0 and len(docs):
            order = np.argsort(docs)
            docs, scores = docs[order], scores[order]
        for j in range(done, len(lists)):
            on = scores + rest[j] >= least
            docs, scores = docs[on], scores[on]
            if not len(docs):
                break
            where, adds, _ = lists[j]
            at = np.minimum(np.searchsorted(where, docs), len(where) - 1)
            scores = scores + np.where(where[at] == docs, adds[at], 0)
        on = scores >= least
        return docs[on], scores[on]


def search_block(index: DataFrame, block: Block, documents: int, terms: int, best: int) -> DataFrame:
    """item_row, key and score of the best documents of each task for each query of the block."""
    sent = index.sparkSession.sparkContext.broadcast(block)
    kind = index.schema["keys"].dataType.elementType

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Block = sent.value
        top: list[list[tuple]] = [[] for _ in queries.rows]
        keys_type = None
        for batch in batches:
            for i in range(batch.num_rows):
                part = Segment(batch, i, queries, documents, terms)
                keys_type = part.keys.type
                for q, of in enumerate(queries.of):
                    least = max(1, top[q][-1][0]) if len(top[q]) == best else 1
                    docs, scores = part.best(of, least, best)
                    if len(docs):
                        some = [*top[q], *zip(scores.tolist(), part.keys.take(pa.array(docs)).to_pylist(), strict=True)]
                        top[q] = sorted(some, key=lambda x: (-x[0], x[1] is not None, x[1] if x[1] is not None else 0))[:best]
        rows = [(r, key, score) for r, found in zip(queries.rows, top, strict=True) for score, key in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], keys_type), pa.array([r[2] for r in rows], pa.int64())], ["item_row", "key", "score"])
        hand_back()

    return index.select("n", "keys", "hashes", "bounds", "docs", "tfs").mapInArrow(walk, f"item_row long, key {kind.simpleString()}, score long")


def ranked(found: DataFrame, best: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_first("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(index: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text", key: str = "doc_id", best: int = BEST) -> DataFrame:
    """item_key, rank (from 1), key and score of the `best` documents of each row of items.

    Documents score above 0; equal scores go by ascending key, null first. Null or empty items have no terms and no
    rows; repeated rows of items, and repeated documents, are ranked each by itself. Without documents the
    result is empty; other columns are not read. A term is known by a 64-bit hash of its bytes.
    """
    bounded_batches(index.sparkSession)
    queries = query_table(items, item_key, item_text)
    documents, terms = (v or 0 for v in index.agg(F.sum("documents"), F.sum("terms")).first())
    kind = index.schema["keys"].dataType.elementType.simpleString()
    found = index.sparkSession.createDataFrame([], f"item_row long, key {kind}, score long")
    for block in blocks_of(queries) if documents else ():
        block.weights = np.array([weight(documents, int(n)) for n in document_counts(index, block.terms)], np.int64)
        found = found.union(search_block(index, block, documents, terms, best))
    found = stored(found, "found", compression="zstd")
    near = ranked(found.withColumn("part", F.pmod(F.xxhash64("key", "score"), F.lit(PARTS))), best, "item_row", "part").drop("rank")
    # the queries may be many; Spark broadcasts them only while they are small
    return ranked(near, best, "item_row").join(queries.select("item_row", "item"), "item_row").select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(read_table(spark, sf_dir, "documents"))
    out = stored(search(index, read_table(spark, sf_dir, "benchmark")), "ranked")
    discard(spark, index)
    return out


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
n AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
w AS (SELECT item_id, term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM q JOIN df USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM w JOIN tf USING (term) JOIN n USING (doc_id), s GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
