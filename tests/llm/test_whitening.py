"""Whitening against numpy's full eigenproblem, exact deviations against Python's numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(d)]
    x = np.array(distinct, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, row in kept:
        centred = np.array(row) - np.array(sums) / n
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        for k in range(min(4, d)):
            out.append((i, k + 1, n, deviation, centred @ vectors[:, k] / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def close(got, wanted, tolerance=1e-8):
    """Equal rows in any order; a component may have the other sign throughout."""
    def table(rows):
        return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3], r[1], abs(r[4])))

    got, wanted = table([tuple(r)[:6] for r in got]), table(wanted)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    for c in range(1, 5):
        one = np.array([g[4] for g in got if g[1] == c])
        two = np.array([w[4] for w in wanted if w[1] == c])
        assert min(np.abs(one - two).max(initial=0), np.abs(one + two).max(initial=0)) < tolerance
    assert all(abs(g[5] / w[5] - 1) < 1e-9 for g, w in zip(got, wanted, strict=True))


@pytest.mark.parametrize("n, d", [(400, 40), (60, 20), (300, 3), (30, 64)])
def test_against_numpy(spark, n, d):
    rng = np.random.default_rng(n)
    vectors = (rng.standard_normal((n, d)) * rng.uniform(0.1, 0.5, d)).tolist()
    rows = list(enumerate(vectors)) + [(900 + k, v) for k, v in enumerate(vectors[:9])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) * min(4, d)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    close(got, plain(rows))


def test_nulls_and_odd_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(k, v) for k, v in enumerate(rng.standard_normal((30, 5)).tolist())]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [math.nan] * 5), (53, [0.0, math.inf, 0.0, 0.0, 0.0])]
    table = (spark.createDataFrame(rows + bad, SCHEMA).withColumn("x", F.lit("x")).withColumn("n", F.lit(1))
             .withColumn("a.b", F.lit(2)))
    out = whitening.whiten(table)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    close(out.collect(), plain(rows))


def test_empty_equal_and_thin_tables(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    same = run([(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert len(same) == 4
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}
    line = run([(k, [k / 8, k / 4, 0.0]) for k in range(5)])
    assert [r.whitened is None for r in sorted(line, key=lambda r: r.component)] == [False] * 5 + [True] * 10
    with pytest.raises(ValueError, match="lengths"):
        run([(1, [1.0]), (2, [1.0, 2.0])])


def test_large_entries_stay_exact(spark):
    rows = [(k, [1e14 * (k + 1), 3e9 * k * k, float(k % 3)]) for k in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(table).where("component = 1").collect()}
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for k, row in enumerate(x):
        exact = sum((40 * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        assert int(got[k].deviation_digits) == exact and got[k].deviation is None and exact >= 1 << 63


def test_filter_damps_the_unwanted_spectrum():
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.uniform(1, 2, 60), [2.6, 2.5, 2.4, 2.3]])
    basis, _ = np.linalg.qr(rng.standard_normal((64, 64)))
    matrix = basis @ np.diag(values) @ basis.T
    low = whitening.lower_bound(lambda q: matrix @ q, 64, rng)
    assert 0 <= low <= values.min()
    out = basis.T @ whitening.chebyshev(lambda q: matrix @ q, basis, 20, low, 2.05, 2.6)
    gains = np.abs(np.diag(out))
    assert gains[:60].max() * 500 < gains[60:].min()


@pytest.mark.parametrize("values", [np.linspace(1, 1.2, 80), np.ones(80), np.r_[np.zeros(77), 1, 2, 3],
                                    np.r_[np.geomspace(1e-6, 1, 70), 5, 5, 5, 5, 5, 4, 4, 4, 4, 4]])
def test_close_equal_and_missing_eigenvalues(values):
    rng = np.random.default_rng(5)
    basis, _ = np.linalg.qr(rng.standard_normal((80, 80)))
    matrix = basis @ np.diag(values) @ basis.T
    got, vectors, residuals = whitening.leading(lambda q: matrix @ q, 80, 4)
    assert np.allclose(got, np.sort(values)[::-1][:4], atol=1e-12) and residuals.max() < 1e-9
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)
