import math
from fractions import Fraction

import numpy as np
import pytest

from ticklake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, x string"


def brute(rows, wanted=4):
    """{(vec_id, place): x} of the rows that remain, and the dense eigenpairs of the distinct ones."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 2.0 ** 55 for c in v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    x = [(i, [math.floor(256 * c) for c in v]) for i, v in good if len(v) == d]
    u = sorted({tuple(v) for _, v in x})
    n, sums = len(u), [sum(c) for c in zip(*u)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in u])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1][:wanted], vectors[:, ::-1][:, :wanted], values.sum()


def check(got, rows):
    x, n, sums, values, vectors, trace = brute(rows)
    values = values[values > 1e-12 * values[0]]
    k = len(values)
    assert len(got) == k * len(x)
    want = sorted(((i is None, i or 0, j + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums)),
                    abs(sum(float(Fraction(n * a - s, n)) * e for a, s, e in zip(v, sums, vectors[:, j]))) / math.sqrt(values[j]),
                    values[j] / trace) for i, v in x for j in range(k)), key=lambda r: r[:5] + (round(r[5], 6),))
    have = sorted(((r.vec_id is None, r.vec_id or 0, r.component, r.n, r.deviation, abs(r.whitened), r.explained)
                   for r in got), key=lambda r: r[:5] + (round(r[5], 6),))
    for a, b in zip(want, have):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-8) and a[6] == pytest.approx(b[6], rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    for j in range(1, k + 1):   # one sign for all rows
        signs = {np.sign(r.whitened) * np.sign(sum(float(a * n - s) * e for a, s, e in zip(v, sums, vectors[:, j - 1])))
                 for r in got if r.component == j and abs(r.whitened) > 1e-6
                 for i, v in x if i == r.vec_id and sum(w == i for w, _ in x) == 1}
        assert len(signs) <= 1


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.2, 12)
    rows = [(i, [float(c) for c in rng.standard_normal(12) * scale + 5]) for i in range(150)]
    rows += [rows[0], (None, rows[1][1]), (200, rows[2][1]), (201, None), (202, []), (203, [None] * 12), (204, [1.0] * 11),
             (205, [float("nan")] + [0.0] * 11), (206, [float("inf")] * 12), (207, [3e38] * 12), (208, [-0.0] * 12), (209, [0.0] * 12)]
    df = spark.createDataFrame([(i, v, 1, "y") for i, v in rows], SCHEMA).repartition(3)
    check(W.whiten(df).collect(), df.rdd.map(lambda r: (r.vec_id, r.embedding)).collect())


def test_query_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(W.op12_embedding_whitening(spark, "/root/testdata/sf0.001").collect(), rows)


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0]), (3, [7.0, 2.0, 3.0])],         # one component
    [(1, [0.5]), (2, [0.75]), (3, [0.5])],                                       # one dimension
    [(1, [1e6, 1.0]), (2, [1e6 + 1, 2.0]), (3, [1e6 + 2, 1.0]), (4, [1e6, 4.0])],  # a mean far from zero
])
def test_few_components(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)
    check(W.whiten(df).collect(), df.rdd.map(lambda r: (r.vec_id, r.embedding)).collect())


def test_no_variance_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], SCHEMA)
    assert W.whiten(df).collect() == [] and W.whiten(df.limit(0)).collect() == []
    assert W.whiten(df.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long_is_null():
    x = np.array([[2 ** 40, 1], [1, 1]])
    assert W._deviations(x, 3, [0, 0]) == [None, 18]


def test_jacobi_davidson_locks_double_precision():
    rng = np.random.default_rng(5)
    for c in (np.diag(1 + np.arange(64) * 1e-3), np.diag(np.exp(-np.arange(90) / 6)), np.eye(9), np.diag([5.0, 5, 5, 1, 0, 0]),
              (lambda a: a @ a.T)(rng.standard_normal((150, 80)))):
        values, vectors, residuals = W.jacobi_davidson(lambda v: c @ v, len(c), 4)
        assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][:4], rtol=1e-12)
        assert np.abs(c @ vectors - vectors * values).max() < W.ROUNDING * len(c) * values[0]
        assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-13
        assert max(residuals) <= W.ROUNDING * len(c) * values[0]


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    m = rng.standard_normal((30, 30))
    m, b = m + m.T, rng.standard_normal((30, 3))
    b[:, 1] = 0
    x = W.minres(lambda z: m @ z, b, 200, 1e-12)
    assert np.abs(m @ x - b).max() < 1e-8
