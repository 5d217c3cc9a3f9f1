"""Whitening against a plain eigendecomposition, and its defined cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import op13_whitening

SF = "/root/testdata/sf0.001"
SHAPE = "vec_id long, embedding array<float>, component int, x int, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, 8, "n") for i, v in rows], SHAPE)


def brute(rows, count):
    """(vec_id, component) -> (n, deviation, |whitened|, explained) in whole numbers and numpy's eigh."""
    good = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array(fit) - np.array([s / n for s in sums])
    v = y.T @ y / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    out = []
    for i, x in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        z = (np.array(x) - np.array([s / n for s in sums])) @ axes
        out += [(i, k + 1, n, deviation, abs(z[k]) / math.sqrt(e[k]), e[k] / np.trace(v)) for k in range(count)]
    return out


def test_whitening_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows += [(rows[0][0], rows[0][1]), (None, rows[3][1]), (9001, None), (9002, [None] * 64), (9003, [float("nan")] + [0.0] * 63), (9004, [float("-inf")] + [0.0] * 63), (9005, []), (9006, [0.5] * 3)]
    got = op13_whitening.whiten(vectors(spark, rows), 4).collect()
    expected = brute([r for r in rows if not r[1] or len(r[1]) == 64], 4)
    key = lambda r: (repr(r[0]), r[1], r[3])
    got_rows = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got], key=key)
    assert [r[:4] for r in got_rows] == [r[:4] for r in sorted(expected, key=key)]
    assert np.allclose([r[4:] for r in got_rows], [r[4:] for r in sorted(expected, key=key)], rtol=1e-9, atol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_query_whitens_all_rows(spark):
    out = op13_whitening.op13_whitening(spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 4 * spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_defined_cases(spark):
    assert op13_whitening.whiten(vectors(spark, [(1, [1.0])]).filter("false"), 4).collect() == []
    assert op13_whitening.whiten(vectors(spark, [(1, None), (2, [])]), 4).collect() == []
    same = op13_whitening.whiten(vectors(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])]), 4).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 4
    assert {r.vec_id for r in op13_whitening.whiten(vectors(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0]), (3, [1.0])])).collect()} == {3}
    line = op13_whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert {r.whitened is None for r in line if r.component == 1} == {False} and {r.whitened for r in line if r.component > 1} == {None}
    assert line[0].explained == pytest.approx(1) and line[0].identity_error < 1e-9
    huge = op13_whitening.whiten(vectors(spark, [(1, [1e12]), (2, [-1e12]), (3, [0.0])]), 1).orderBy("vec_id").collect()
    assert [r.deviation for r in huge] == [None, None, 0] and abs(huge[0].whitened) == pytest.approx(math.sqrt(1.5), rel=1e-6)


def test_rounding_goes_down(spark):
    out = spark.createDataFrame([([-0.001, 0.001, -0.0, -1.0],)], "v array<float>").select(op13_whitening.whole_numbers(F.col("v")).alias("x")).first()
    assert out.x == [-1, 0, 0, -256]


@pytest.mark.parametrize("matrix", [
    np.diag([1.0, 1, 2, 2, 2]), np.eye(4), np.zeros((3, 3)), np.diag([3.0, 2, 1, 0, 0]), np.outer(np.arange(5.0), np.arange(5.0)), np.diag([1e12, 1, 1e-3]), np.array([[7.0]]),
    np.cov(np.random.default_rng(5).standard_normal((64, 200))),
])
def test_divide_and_conquer(matrix):
    e, axes = op13_whitening.components(matrix)
    size = max(1.0, np.linalg.norm(matrix))
    assert np.allclose(e, np.linalg.eigvalsh(matrix)[::-1], atol=1e-13 * size)
    assert np.allclose(axes.T @ axes, np.eye(len(matrix)), atol=1e-12) and np.allclose(matrix @ axes, axes * e, atol=1e-13 * size)


def test_polar_factor():
    a = np.random.default_rng(2).standard_normal((20, 20))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.allclose(op13_whitening.polar(a), v @ np.diag(np.sign(e)) @ v.T, atol=1e-10)
    with pytest.raises(np.linalg.LinAlgError):
        op13_whitening.polar(np.diag([1.0, 0.0]))
