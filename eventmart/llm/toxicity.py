"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, of toxic and of ordinary texts, are compared by their length-normalised
log-likelihoods. Each backs off from word pairs to words and from words to counts shared by both classes,
gathered from every document, so that a rare expression gets the same mass from either. Pairs are counted in
documents (a document is one context), which keeps a text that repeats itself from counting twice; the lower
orders count continuations, the different words that a word follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import discard, pieces, read_table, stored
from eventmart.llm.words import Words, grams

#: Labelled rows that fit the two models and their calibration, the first in the order of a hash of their key.
MAX_LABELLED = 20_000
#: Words and word pairs that the models keep, those of most documents; the whole mass of the others is backed off.
MAX_WORDS, MAX_PAIRS = 1 << 18, 1 << 17
#: Cells of the shared counts, and the least discount.
SHARED_BITS, LEAST_DISCOUNT = 18, 2.0
#: Bits of a pair (its cell and 32 bits of the word before) and the odd factor that spreads them, with its inverse.
PAIR_BITS = SHARED_BITS + 32
SPREAD, UNSPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)))
#: Pairs that a task gathers before it sends them, and pairs of a bucket on average, at most.
HELD_PAIRS, BUCKET_PAIRS = 1 << 20, 1 << 20
#: Words of the stretches whose mean ratio is compared besides that of the whole text.
STRETCHES = (1, 4, 24)


def held_out(key: str, folds: int, remainder: int):
    """Rows that are never learned from: crc32 of the key as text, modulo folds; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == remainder


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, keep, key: str, text: str, limit: int) -> DataFrame:
    """text and y of at most `limit` labelled rows with keep, stored; the label rows are few enough to broadcast by that limit.

    Of rows that repeat a labelled key one is taken, by its text's hash; they are reduced before they are shuffled.
    """
    rows = labels.filter(F.col(label).isNotNull() & keep).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    sample = stored(rows.orderBy(F.xxhash64(key), key).limit(limit), "labels")
    met = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key)
    one = met.groupBy(key).agg(F.min("y").alias("y"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return stored(one.select("text", "y"), "labelled")


@dataclass
class KneserNey:
    """Log-ratio tables. words, pairs: sorted hashes; counts in documents by class (0 ordinary, 1 toxic)."""

    discount: float  # documents taken off each count; what is taken off goes to the shared counts
    shared: np.ndarray  # probability of each cell
    words: np.ndarray
    word_counts: np.ndarray  # 2 x words: different words that the word follows
    word_total: np.ndarray  # by class
    word_freed: np.ndarray  # of word_total, what the kept words do not have after the discount
    followed: np.ndarray  # 2 x words: documents with a pair that starts with the word, by pair
    freed: np.ndarray  # 2 x words: of `followed`, what the kept pairs do not have after the discount
    pairs: np.ndarray
    pair_counts: np.ndarray  # 2 x pairs

    def ratios(self, w: Words, y: np.ndarray | None = None) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word; y: classes of the rows, whose own
        document is taken off their class's counts."""
        own = np.zeros((2, len(w)))
        if y is not None:
            own[y[w.row], np.arange(len(w))] = 1
        at, known = find(self.words, w.hash)
        shared = self.shared[w.hash >> np.uint64(64 - SHARED_BITS)]
        pair = np.zeros(len(w), np.uint64)
        pair[1:] = grams(w.hash, 2)
        inner = np.ones(len(w), bool)
        inner[w.rows[:-1][np.diff(w.rows) > 0]] = False
        pat, pknown = find(self.pairs, pair)
        pknown &= inner
        before = np.concatenate([[0], at[:-1]])[: len(w)]
        history = inner & np.concatenate([[False], known[:-1]])[: len(w)]
        logs = []
        for c in (0, 1):
            n = np.where(known, self.word_counts[c][at], 0) - own[c]
            p = np.maximum(n - self.discount, 0) / self.word_total[c] + self.word_freed[c] / self.word_total[c] * shared
            total = np.where(history, self.followed[c][before], 0)
            n = np.where(pknown, self.pair_counts[c][pat], 0) - own[c]
            kept = np.maximum(n - self.discount, 0) / np.maximum(total, 1)
            left = np.where(total > 0, self.freed[c][before] / np.maximum(total, 1), 1.0)
            logs.append(np.log(kept + left * p))
        return logs[1] - logs[0]

    def features(self, w: Words, y: np.ndarray | None = None) -> np.ndarray:
        """Per row: mean ratio of the whole text, best means of the stretches, and the log of its words."""
        n = np.diff(w.rows)
        total = np.concatenate([[0.0], np.cumsum(np.clip(self.ratios(w, y), -12, 12))])
        out = [(total[w.rows[1:]] - total[w.rows[:-1]]) / np.maximum(n, 1)]
        for size in STRETCHES:
            stop = np.minimum(np.arange(len(w)) + size, w.rows[1:][w.row])
            begin = np.maximum(stop - size, w.rows[:-1][w.row])
            mean = (total[stop] - total[begin]) / np.maximum(stop - begin, 1)
            best = np.zeros(len(n))
            if len(w):
                best[n > 0] = np.maximum.reduceat(mean, w.rows[:-1][n > 0])
            out.append(best)
        return np.column_stack([*out, np.log1p(n)])


def find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in sorted keys, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


def shared_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Share of each hash cell in the continuations of words over all documents: the different pairs of a word
    before (32 bits of its hash) and a word of the cell, and one more for each cell.

    Pairs are spread over PAIR_BITS bits by an odd factor, which loses none, dealt to buckets by their highest bits
    and sent sorted, as differences; a bucket counts each pair once. The number of buckets follows the text.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    bits = max(6, int(size // (8 * BUCKET_PAIRS)).bit_length())
    low, mask = np.uint64(PAIR_BITS - bits), np.uint64((1 << PAIR_BITS) - 1)

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pair = np.unique(np.concatenate(held))
        bucket = (pair >> low).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        step = np.diff(pair & (np.uint64(1) << low) - np.uint64(1), prepend=np.uint64(0))
        step[cuts] = pair[cuts] & (np.uint64(1) << low) - np.uint64(1)
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(pair)], strict=True):
            halves = (step[i:j].astype(np.uint32).tobytes(), (step[i:j] >> np.uint64(32)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[i])], pa.int32()), *(pa.array([x], pa.binary()) for x in halves)], ["bucket", "low", "high"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            inner = np.flatnonzero(w.row[1:] == w.row[:-1]) if len(w) else np.zeros(0, np.int64)
            pair = w.hash[inner + 1] >> np.uint64(64 - SHARED_BITS) << np.uint64(32) | w.hash[inner] >> np.uint64(32)
            held.append(np.unique(pair * SPREAD & mask))
            n += len(held[-1])
            if n > HELD_PAIRS:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)

    def count(table: pa.Table) -> pa.Table:
        held = []
        for first, second in zip(table["low"].to_pylist(), table["high"].to_pylist(), strict=True):
            held.append(np.cumsum(np.frombuffer(first, np.uint32) + (np.frombuffer(second, np.uint16).astype(np.uint64) << np.uint64(32)), dtype=np.uint64))
        pair = np.unique(np.concatenate(held)) | np.uint64(table["bucket"][0].as_py()) << low
        n = np.bincount((pair * UNSPREAD & mask) >> np.uint64(32), minlength=1 << SHARED_BITS)
        used = np.flatnonzero(n)
        return pa.table({"cell": pa.array(used.astype(np.int32)), "n": pa.array(n[used])})

    sent = docs.select(F.col(text).alias("text")).mapInArrow(pairs, "bucket int, low binary, high binary")
    counted = sent.groupBy("bucket").applyInArrow(count, "cell int, n long")
    # at most 2 ** SHARED_BITS rows
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    n = np.ones(1 << SHARED_BITS)
    n[rows["cell"].to_numpy()] += rows["n"].to_numpy()
    return n / n.sum()


def pair_table(texts: DataFrame) -> DataFrame:
    """first, word and documents of each class (n0, n1) of every pair of neighbours; first is 0 for a word alone. Stored once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            y = batch.column("y").to_numpy()
            inner = np.flatnonzero(w.row[1:] == w.row[:-1]) if len(w) else np.zeros(0, np.int64)
            first = np.concatenate([np.zeros(len(w), np.uint64), w.hash[inner]])
            word = np.concatenate([w.hash, w.hash[inner + 1]])
            row = np.concatenate([w.row, w.row[inner]])
            order = np.lexsort((row, word, first))
            first, word, row = first[order], word[order], row[order]
            new_pair = np.ones(len(first), bool)
            new_pair[1:] = (first[1:] != first[:-1]) | (word[1:] != word[:-1])
            new_row = new_pair.copy()
            new_row[1:] |= row[1:] != row[:-1]
            group = np.cumsum(new_pair) - 1
            n = [np.bincount(group[new_row & (y[row] == c)], minlength=group[-1] + 1 if len(group) else 0) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(first[new_pair].view(np.int64)), pa.array(word[new_pair].view(np.int64)), pa.array(n[0].astype(np.int32)), pa.array(n[1].astype(np.int32))], ["first", "word", "n0", "n1"])

    rows = texts.mapInArrow(count, "first long, word long, n0 int, n1 int")
    return stored(rows.groupBy("first", "word").agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")), "pairs")


def fit_models(docs: DataFrame, texts: DataFrame, text: str = "text") -> KneserNey:
    """Both models: class counts from the labelled texts, shared counts from all documents.

    The discount grows with the root of the toxic texts, as the chance counts of harmless words do;
    expressions of fewer documents tell the classes apart no more and are left to the shared counts. A pair
    that exceeds it in either class is kept for both; each class's mass of all other pairs backs off.
    """
    discount = max(LEAST_DISCOUNT, float(np.sqrt(texts.filter("y = 1").count())) / 3)
    table = pair_table(texts)
    pairs = table.filter("first <> 0")
    words = stored(pairs.groupBy("word").agg(*(F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"c{c}") for c in (0, 1))), "continuations")
    sums = words.agg(F.sum("c0"), F.sum("c1")).first()
    history = pairs.groupBy("first").agg(F.sum("n0").alias("f0"), F.sum("n1").alias("f1"))
    common = table.filter("first = 0 AND n0 + n1 >= 2").orderBy(F.desc(F.expr("n0 + n1")), "word").limit(MAX_WORDS)
    kept = common.select("word").join(words, "word", "left").join(history.withColumnRenamed("first", "word"), "word", "left").fillna(0).toPandas()
    top = pairs.filter(F.greatest("n0", "n1") > discount).orderBy(F.desc(F.expr("n0 + n1")), "first", "word").limit(MAX_PAIRS).toPandas()
    key = kept["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)
    key = key[order] if len(key) else np.zeros(1, np.uint64)
    column = lambda *names: np.stack([kept[c].to_numpy(np.float64)[order] if len(kept) else np.zeros(1) for c in names])
    pair = top[["first", "word"]].to_numpy(np.int64).view(np.uint64)
    pair_key = np.array(grams(pair.reshape(-1), 2)[::2]) if len(pair) else np.zeros(1, np.uint64)
    pair_order = np.argsort(pair_key)
    pair_counts = np.stack([top[c].to_numpy(np.float64)[pair_order] if len(top) else np.zeros(1) for c in ("n0", "n1")])
    counts, followed = column("c0", "c1"), column("f0", "f1")
    freed = followed.copy()
    at, known = find(key, pair[pair_order, 0] if len(pair) else np.zeros(1, np.uint64))
    for c in (0, 1):
        np.subtract.at(freed[c], at[known], np.maximum(pair_counts[c][known] - discount, 0))
    total = np.array([sums[0] or 0, sums[1] or 0], np.float64)
    word_freed = total - np.maximum(counts - discount, 0).sum(axis=1)
    discard(docs.sparkSession, table, words)
    return KneserNey(discount, shared_counts(docs, text), key, counts, np.maximum(total, 1.0), np.maximum(word_freed, 1.0), followed, freed, pair_key[pair_order], pair_counts)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last column of x is 1."""
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights)), x.T @ (y - p) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fitted(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, keep):
    """A function from an Arrow column of texts (without nulls) to scores, learned from the label rows with keep."""
    texts = labelled_texts(docs, labels, label, keep, key, text, MAX_LABELLED)
    share = texts.agg(F.avg("y"), F.count("*")).first()
    prior = float(share[0] or 0)
    if not 0 < prior < 1:
        return lambda column: np.full(len(column), prior)
    model = docs.sparkSession.sparkContext.broadcast(fit_models(docs, texts, text))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            y = batch.column("y").to_numpy()
            x = model.value.features(Words(batch.column("text")), y)
            yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    # at most MAX_LABELLED rows of a few numbers
    rows = texts.mapInArrow(measure, "y int, x array<double>").toPandas()
    x = np.stack(rows["x"].to_numpy())
    weights = logistic(np.column_stack([x, np.ones(len(x))]), rows["y"].to_numpy())
    return lambda column: 1 / (1 + np.exp(-np.clip(model.value.features(Words(column)) @ weights[:-1] + weights[-1], -30, 30)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 4, remainder: int = 2, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: key, held_out, score, predicted.

    Null and empty texts have no words and get the score of a text without evidence. Only label rows whose
    key is not held out are learned from, at most MAX_LABELLED; without any of both classes every score is
    the share of toxic ones (0 without labels). Repeated rows are scored alike, an empty table gives an
    empty result, and no column but the text bears on a score.
    """
    out = held_out(key, folds, remainder)
    score = fitted(docs, labels, key, text, label, ~out)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            p = score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["key", "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), out.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(judge, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 4, remainder: int = 2, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold. Cases as in toxicity_scores."""
    score = fitted(docs, labels, key, text, label, ~held_out(key, folds, remainder))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for part in pieces([batch], text):
                clean = pa.array(score(part.column(text)) < threshold)
                yield batch.slice(begin, part.num_rows).filter(clean)
                begin += part.num_rows

    return docs.mapInArrow(keep, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
