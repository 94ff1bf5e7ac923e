"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), with the pairwise term computed in linear
time as half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). Feature extraction and scoring run on the
executors over whole texts; the machine itself is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bytes_of, pieces, read_table, stored
from eventmart.llm.toxicity import held_out
from eventmart.llm.words import Words

#: Labelled rows that fit the machine, the first in the order of a hash of their key.
MAX_LABELLED = 6_000
#: Cells of hashed words, and dimensions of the interactions.
WORD_BITS, FACTORS = 14, 8

_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_MARKS = [np.array([chr(b) in s for b in range(256)]) for s in ("!?", "|", "#$%&*", ".,;:", "\n")]


def _of_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over each row."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(column: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row bounds, feature numbers and values of each text: hashed words (of unit length together), then statistics.

    n_chars: the metadata column, 0 where it is null.
    """
    raw, offsets = bytes_of(column)
    w = Words(column)
    rows, row = len(column), w.row
    n, size = np.maximum(np.diff(w.rows), 1), np.maximum(np.diff(offsets), 1)
    cell = (w.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    pair, count = np.unique(row << WORD_BITS | cell, return_counts=True)
    value = np.log1p(count)
    of = pair >> WORD_BITS
    norm = np.sqrt(np.bincount(of, value**2, rows))
    repeated = np.zeros(len(w))
    repeated[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    distinct = np.bincount(of, minlength=rows)
    stats = [
        _of_rows(_SYMBOL[raw], offsets) / size, _of_rows(_UPPER[raw], offsets) / size, _of_rows(_DIGIT[raw], offsets) / size,
        *(np.minimum(_of_rows(m[raw], offsets) / n, 2) for m in _MARKS),
        _of_rows(repeated, w.rows) / n, distinct / n, _of_rows(w.ends - w.starts, w.rows) / n / 10, np.log1p(n) / 10, np.log1p(n_chars) / 10,
    ]
    stats = np.column_stack(stats)
    k = stats.shape[1]
    bounds = np.concatenate([[0], np.cumsum(distinct + k)])
    number, values = np.zeros(bounds[-1], np.int32), np.zeros(bounds[-1], np.float32)
    at = np.arange(len(pair)) + of * k
    number[at], values[at] = pair & (1 << WORD_BITS) - 1, value / norm[of]
    at = (bounds[1:] - k)[:, None] + np.arange(k)
    number[at], values[at] = (1 << WORD_BITS) + np.arange(k), stats
    return bounds, number, values


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # features x FACTORS

    def terms(self, bounds: np.ndarray, number: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and the sums over each row's features that the interactions need."""
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        logit = self.bias + np.bincount(row, self.linear[number] * values, len(bounds) - 1)
        sums = np.zeros((len(bounds) - 1, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            vx = self.factors[number, f] * values
            sums[:, f] = np.bincount(row, vx, len(sums))
            logit += 0.5 * (sums[:, f] ** 2 - np.bincount(row, vx * vx, len(sums)))
        return logit, sums

    def probability(self, *x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.terms(*x)[0], -30, 30)))


def fit(bounds: np.ndarray, number: np.ndarray, values: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.05, ridge: float = 1e-4) -> FactorisationMachine:
    """Mini-batch Adagrad on the logistic loss; the same rows in the same order give the same machine."""
    rng = np.random.default_rng(0)
    size = (1 << WORD_BITS) + int(max(0, number.max() + 1 - (1 << WORD_BITS)))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    m = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)))
    seen = [1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)]
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            n = np.diff(bounds)[rows]
            cuts = np.concatenate([[0], np.cumsum(n)])
            at = np.arange(cuts[-1]) + np.repeat(bounds[rows] - cuts[:-1], n)
            i, x, row = number[at], values[at], np.repeat(np.arange(len(rows)), n)
            logit, sums = m.terms(cuts, i, x)
            wrong = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            used, place = np.unique(i, return_inverse=True)
            step = wrong[row] * x
            g = np.bincount(place, step) + ridge * m.linear[used]
            seen[1][used] += g * g
            m.linear[used] -= rate * g / np.sqrt(seen[1][used])
            for f in range(FACTORS):
                v = m.factors[i, f]
                g = np.bincount(place, step * (sums[row, f] - v * x)) + ridge * m.factors[used, f]
                seen[2][used, f] += g * g
                m.factors[used, f] -= rate * g / np.sqrt(seen[2][used, f])
            g = wrong.sum()
            seen[0] += g * g
            m.bias -= rate * g / np.sqrt(seen[0])
    return m


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", metadata: str = "n_chars", label: str = "quality", folds: int = 5, remainder: int = 0, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: key, held_out, score, predicted.

    Null and empty texts are scored by their statistics alone; null metadata, or none, counts as 0. Only label rows
    whose key is not held out are learned from, at most MAX_LABELLED; without any of both classes every
    score is the share of good ones (0 without labels). Repeated rows are scored alike, an empty table gives
    an empty result, and only the text and the metadata column bear on a score.
    """
    spark = docs.sparkSession
    out = held_out(key, folds, remainder)
    known = labels.filter(F.col(label).isNotNull() & ~out).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    sample = stored(known.orderBy(F.xxhash64(key), key).limit(MAX_LABELLED), "labels")
    rows = docs.select(F.col(key).alias("key"), out.alias("held_out"), F.col(text).alias("text"), (F.coalesce(F.col(metadata).cast("long"), F.lit(0)) if metadata in docs.columns else F.lit(0).cast("long")).alias("n_chars"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bounds, number, values = features(batch.column("text"), batch.column("n_chars").to_numpy())
            cut = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.ListArray.from_arrays(cut, pa.array(number)), pa.ListArray.from_arrays(cut, pa.array(values))], ["y", "number", "x"])

    # the sample has MAX_LABELLED rows at most, so it can be broadcast and its features gathered; of rows that repeat a
    # labelled key one is taken, by its hash, before anything is shuffled
    met = rows.join(F.broadcast(sample.withColumnRenamed(key, "key")), "key")
    one = met.groupBy("key").agg(F.min("y").alias("y"), F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text", "n_chars"), "text", "n_chars")).alias("d")).select("key", "y", "d.*")
    got = one.orderBy("key").select("text", "n_chars", "y").mapInArrow(extract, "y int, number array<int>, x array<float>").toArrow().combine_chunks()
    y = got.column("y").to_numpy().astype(np.float64)
    prior = float(y.mean()) if len(y) else 0.0
    model = None
    if 0 < prior < 1:
        number, x = got.column("number").combine_chunks(), got.column("x").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(number.value_lengths().to_numpy())])
        model = spark.sparkContext.broadcast(fit(bounds, number.flatten().to_numpy(), x.flatten().to_numpy().astype(np.float64), y))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            p = np.full(batch.num_rows, prior) if model is None else model.value.probability(*features(batch.column("text"), batch.column("n_chars").to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["key", "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
