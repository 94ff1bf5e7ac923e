"""Whitening of embeddings: components by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries are fixed-point integers, so sums over the corpus are exact whatever the order and number of partitions. Spark
sums the vectors and then the scatter of the vectors less the whole part of their mean; what is left of the mean is taken
off exactly. Only numbers by the square of the dimension reach the driver. There the scatter C is factored with
diagonal pivoting, C[p, p] = L L', and pairs of columns of the triangular factor L itself are rotated until all are
orthogonal: L J = U S. The squared norms of the rotated columns are the eigenvalues of C, the normalised columns its
eigenvectors; C is never squared or rotated, so small eigenvalues keep their relative precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bounded_batches, hand_back, read_table

#: Fixed point of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components that are returned.
COMPONENTS = 8
#: Cosine of two columns under which they count as orthogonal, and passes over all pairs at most (about eight are needed).
ORTHOGONAL, PASSES = 1e-15, 60
#: Vectors that one numpy pass multiplies.
ROWS = 4096
_LONG, DIGIT = 1 << 63, 36


@dataclass
class Whitening:
    """The fit over n vectors: exact sums by dimension, eigenvalues (falling), components as columns, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        """Centred vectors times this are whitened."""
        return self.components / np.sqrt(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: the whole part of the mean is taken off exactly, then the rest."""
        whole = [s // self.n for s in self.sums]
        if any(not -_LONG // 2 <= m < _LONG // 2 for m in whole):
            x = x.astype(object)
        whole = np.array(whole, x.dtype)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return (x - whole).astype(np.float64) - rest


def usable(vector: str) -> Column:
    """Whether a vector has entries, and none of them is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def fixed(column: pa.Array, dimension: int) -> np.ndarray:
    """The integers of each vector; of entries too large for 64 bits as Python numbers."""
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    x = np.floor(flat * SCALE)
    if x.size and np.abs(x).max() >= 1 << 62:
        return np.array([[int(v) + SHIFT for v in row] for row in x.tolist()], object).reshape(x.shape)
    return x.astype(np.int64) + SHIFT


def products(y: np.ndarray) -> list[list[int]]:
    """The exact y' y of integers."""
    most = int(np.abs(y).max()) if y.size else 0
    if y.dtype != object and most * most * len(y) < 1 << 53:
        z = y.astype(np.float64)  # every partial sum is a whole number that a double holds
        return (z.T @ z).astype(np.int64).tolist()
    y = y.astype(object) if most * most * max(1, len(y)) >= _LONG else y
    return (y.T @ y).tolist()


def _sum_by_place(rows: DataFrame, dimension: int, task, width: int) -> np.ndarray:
    """Exact sums, over all vectors, of the `width` numbers that `task` makes of a matrix of integers. A task sends them once."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                total += np.array(task(fixed(batch.column("v").slice(i, ROWS), dimension)), object).reshape(-1)
        digits = [(place, k, d) for place, v in enumerate(total.tolist()) for k, d in enumerate(_digits(v))]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in digits], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64()))], ["place", "digit", "s"])
        hand_back()

    summed = rows.mapInArrow(add, "place int, digit int, s long").groupBy("place", "digit").agg(F.sum("s").alias("s"))
    out = np.zeros(width, object)
    for place, digit, s in summed.collect():  # a few rows for each pair of dimensions
        out[place] += s << (DIGIT * digit)
    return out


def _digits(v: int) -> list[int]:
    """v in digits of DIGIT bits, the last one with its sign; whole numbers of any size are so summed as longs."""
    out = []
    while not -(1 << DIGIT) < v < 1 << DIGIT:
        out.append(v & ((1 << DIGIT) - 1))
        v >>= DIGIT
    return [*out, v] if v or out else []


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, p) with c[p][:, p] = L L' for a symmetric matrix without negative eigenvalues; as many columns as its rank."""
    d = len(c)
    a, p, factor = np.array(c, np.float64), np.arange(d), np.zeros((d, d))
    scale = np.diag(a).copy()
    for k in range(d):
        left = np.diag(a)[k:]
        if not (left > 8 * d * np.finfo(float).eps * scale[p[k:]]).any():
            return factor[:, :k], p
        m = k + int(np.argmax(left))
        for x in (a, factor):
            x[[k, m]] = x[[m, k]]
        a[:, [k, m]] = a[:, [m, k]]
        p[[k, m]] = p[[m, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, p


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint ones."""
    m = n + n % 2
    ring, out = list(range(m)), []
    for _ in range(m - 1):
        pairs = [(a, b) for a, b in zip(ring[: m // 2], ring[: m // 2 - 1 : -1], strict=True) if max(a, b) < n]
        out.append((np.array([min(x) for x in pairs], int), np.array([max(x) for x in pairs], int)))
        ring[1:] = [ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of factor rotated in pairs until all are orthogonal."""
    u = factor.copy()
    order = rounds(u.shape[1])
    for _ in range(PASSES):
        worst = 0.0
        for i, j in order:
            a, b = u[:, i], u[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            on = np.abs(ab) > ORTHOGONAL * np.sqrt(aa * bb)
            if not on.any():
                continue
            worst = max(worst, float((np.abs(ab[on]) / np.sqrt(aa[on] * bb[on])).max()))
            i, j, a, b = i[on], j[on], a[:, on], b[:, on]
            zeta = (bb[on] - aa[on]) / (2 * ab[on])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = 1 / np.hypot(1, t)
            sin = cos * t
            u[:, i], u[:, j] = cos * a - sin * b, sin * a + cos * b
        if worst <= 4 * ORTHOGONAL:
            break
    return u


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a scatter matrix, falling, and unit eigenvectors as columns."""
    factor, p = pivoted_cholesky(scatter)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated * rotated).sum(0))
    order = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(rotated)
    vectors[p] = rotated / norms  # rows back in their places
    return norms[order] ** 2, vectors[:, order]


def dimension_of(rows: DataFrame) -> int:
    """The number of entries that most vectors have (of equal counts the larger); 0 for no vectors."""
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return most["d"] if most else 0


def fit(vectors: DataFrame, vector: str = "embedding") -> Whitening | None:
    """The whitening of all usable vectors of the usual dimension; None where there are none."""
    bounded_batches(vectors.sparkSession)
    rows = vectors.filter(usable(vector)).select(F.col(vector).alias("v"))
    d = dimension_of(rows)
    if not d:
        return None
    rows = rows.filter(F.size("v") == d)
    first = _sum_by_place(rows, d, lambda x: [*x.sum(0, dtype=x.dtype).tolist(), len(x)], d + 1)
    n, sums = int(first[-1]), [int(s) for s in first[:-1]]
    whole = [s // n for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, whole, strict=True)], object)
    small = all(-_LONG // 2 <= m < _LONG // 2 for m in whole)

    def scatter(x: np.ndarray) -> list[list[int]]:
        x = x if small else x.astype(object)
        return products(x - np.array(whole, x.dtype))

    about = _sum_by_place(rows, d, scatter, d * d).reshape(d, d)
    exact = n * about - np.outer(rest, rest)  # n * n * covariance, in whole numbers
    values, components = eigen(np.array([[float(Fraction(int(v), n * n)) for v in row] for row in exact]))
    return Whitening(n, sums, values, components, float(Fraction(int(sum(exact.diagonal())), n * n)))


def whitened(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, deviation and the array `whitened` of the first components, a row for each usable vector of the model's dimension.

    deviation is the exact sum over dimensions of (n * x - sum) squared; null where it does not fit in 64 bits.
    """
    d, n, matrix = len(model.sums), model.n, model.matrix[:, :components]
    width = matrix.shape[1]

    def deviations(x: np.ndarray) -> list[int | None]:
        far = max((abs(n * int(v) - s) for m, s in zip((x.min(0), x.max(0)), (model.sums, model.sums), strict=True) for v, s in zip(m, s, strict=True)), default=0)
        if d * far * far < _LONG and x.dtype != object:
            y = n * x - np.array(model.sums, np.int64)
            return (y * y).sum(1).tolist()
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x]
        return [v if v < _LONG else None for v in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                x = fixed(batch.column("v"), d)
                w = model.centred(x) @ matrix
                cut = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(cut, pa.array(w.reshape(-1)))], ["key", "deviation", "whitened"])
        hand_back()

    rows = vectors.filter(usable(vector) & (F.size(vector) == d)).select(F.col(key).alias("key"), F.col(vector).alias("v"))
    kind = vectors.schema[key].dataType.simpleString()
    return rows.mapInArrow(project, f"key {kind}, deviation long, whitened array<double>").withColumnRenamed("key", key)


def identity_error(rows: DataFrame, width: int) -> float:
    """Largest absolute entry of the covariance of the arrays `whitened` minus the identity, in one pass over them."""
    if not width:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            w = pc.list_flatten(batch.column("whitened")).to_numpy().reshape(-1, width)
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], ["place", "s"])

    total = np.zeros((width + 1) ** 2)
    for place, s in rows.select("whitened").mapInArrow(add, "place int, s double").groupBy("place").agg(F.sum("s")).collect():  # (width + 1) ** 2 rows
        total[place] = s
    total = total.reshape(width + 1, width + 1) / total[-1]
    mean = total[-1, :-1]  # of centred vectors: rounding alone
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(width)).max())


def whitening(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, or hold a null or an entry that is not finite are left out, and so are those that have
    another number of entries than most. Components without variance are left out: equal vectors have none, and where
    fewer than `components` have any, so many rows of each vector are returned. Repeated rows and rows without a key
    count each by themselves; an empty table gives an empty result, and other columns are not read.
    """
    bounded_batches(vectors.sparkSession)
    model = fit(vectors, vector)
    kind = vectors.schema[key].dataType.simpleString()
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = whitened(vectors, model, key, vector, components)
    error = identity_error(rows, min(components, len(model.values)))
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values[:components]])
    return rows.select(key, F.posexplode("whitened").alias("at", "whitened"), "deviation").select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(read_table(spark, sf_dir, "embeddings"))
