"""Whitening against numpy's decompositions and plain integers."""

from __future__ import annotations

import numpy as np

from eventmart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int"


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (2, 2), (7, 7), (16, 5), (33, 33)):
        a = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 3, rank)
        c = a @ a.T
        factor, p = whitening.pivoted_cholesky(c)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, c[p][:, p], rtol=1e-9, atol=1e-12 * np.trace(c))
        values, vectors = whitening.eigen(c)
        assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][:rank], rtol=1e-9, atol=1e-13 * np.trace(c)) and np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert whitening.eigen(np.zeros((3, 3)))[0].size == 0
    for n in (2, 5, 8):
        assert sorted((int(a), int(b)) for i, j in whitening.rounds(n) for a, b in zip(i, j, strict=True)) == [(a, b) for a in range(n) for b in range(a + 1, n)]


def expected(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    v = (x - s / n).T @ (x - s / n) / n
    values, components = np.linalg.eigh(v)
    order = np.argsort(-values)
    return x, n, s, values[order], components[:, order], np.trace(v)


def test_rows_of_any_kind(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(300, 11)) * np.linspace(1, 3, 11)
    good[100:150] = good[99]  # a vector that a sixth of the rows have
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(good)]
    odd = [None, [], [1.0] * 10 + [None], [float("nan")] + [1.0] * 10, [float("-inf")] + [1.0] * 10, [1.0] * 4]
    df = spark.createDataFrame([*rows, (7, rows[7][1], 1), (None, rows[8][1], 1), *[(900 + i, v, 2) for i, v in enumerate(odd)]], SCHEMA).repartition(5)
    out = whitening.whitening(df).toPandas()
    x, n, s, values, components, trace = expected([r[1] for r in rows] + [rows[7][1], rows[8][1]])
    assert len(out) == 302 * 8 and set(out["n"]) == {302} and out["vec_id"].isna().sum() == 8 and (out["vec_id"] == 7).sum() == 16
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-10
    first = out[out["vec_id"].isin(range(20)) & (out["vec_id"] != 7)]
    deviation = ((n * x - s) ** 2).sum(1)
    for k in range(8):
        some = first[first["component"] == k + 1].set_index("vec_id").sort_index()
        ids = some.index.astype(int)
        want = (x - s / n) @ components[:, k] / np.sqrt(values[k])
        sign = np.sign(want[ids] @ some["whitened"].to_numpy())
        assert np.allclose(some["whitened"], sign * want[ids], atol=1e-9) and np.allclose(some["explained"], values[k] / trace, rtol=1e-9)
        assert some["deviation"].tolist() == deviation[ids].tolist()


def test_few_and_large(spark):
    assert whitening.whitening(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitening(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)).count() == 0  # no variance
    line = spark.createDataFrame([(i, [float(i), float(2 * i), 5.0], 0) for i in range(6)], SCHEMA)
    out = whitening.whitening(line).collect()
    assert len(out) == 6 and {r.component for r in out} == {1} and abs(sum(r.whitened**2 for r in out) / 6 - 1) < 1e-12
    huge = spark.createDataFrame([(i, [float(i) * 2.0**60, 1.0], 0) for i in range(4)], SCHEMA)
    out = whitening.whitening(huge).collect()
    assert len(out) == 4 and {r.deviation for r in out} == {None} and out[0].identity_error < 1e-12


def test_sums_are_exact():
    y = np.array([[1 << 40, 3], [-(1 << 40), 5]], np.int64)
    assert whitening.products(y) == [[1 << 81, -(2 << 40)], [-(2 << 40), 34]]
