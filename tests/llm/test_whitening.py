import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import whitening


def brute(vectors):
    """Fit list, eigenvalues and vectors of its covariance by a plain eigendecomposition."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    a = (fit * n - sums) / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    return x, n, sums, values[::-1], axes[:, ::-1]


def against(rows, vectors, ids):
    x, n, sums, values, axes = brute(vectors)
    k = len({r.component for r in rows})
    at = {(r.vec_id, r.component): r for r in rows}
    got = np.array([[at[i, c].whitened for c in range(1, k + 1)] for i in ids])
    want = ((x * n - sums) / n) @ (axes[:, :k] / np.sqrt(values[:k]))
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-8
    for i, row in zip(ids, x, strict=True):
        assert at[i, 1].deviation == int(((row * n - sums) ** 2).sum()) and at[i, 1].n == n
    assert all(abs(at[ids[0], c].explained / (values[c - 1] / values.sum()) - 1) < 1e-8 for c in range(1, k + 1))
    assert max(r.identity_error for r in rows) < 1e-8
    return k


def test_odd_rows_copies_and_clashing_names(spark):
    draw = np.random.default_rng(2)
    vectors = (draw.standard_normal((300, 20)) * draw.uniform(0.1, 6, 20)).astype(np.float32).astype(float)
    vectors[100:200] = vectors[0]  # copies count once
    rows = [(i, v.tolist(), 1, "x", i) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan] * 20, [inf] + [0.0] * 19, [None] + [0.0] * 19, [1.0, 2.0]]
    rows += [(1000 + i, v, None, "x", i) for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string, component int").repartition(5)
    got = whitening.components(table).collect()
    assert {r.vec_id for r in got} == set(range(300)) and len(got) == 300 * 16
    assert against(got, vectors, list(range(300))) == 16


def test_dependent_dimensions_have_no_component(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(-500, 500, (80, 3)) / 64
    vectors = np.column_stack([base, base[:, 0] + base[:, 1], np.full(80, 7.0), base[:, 2] * 1000])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert against(whitening.components(table).collect(), vectors, list(range(80))) == 3


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_varies(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.components(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_null_and_repeated_ids_stay(spark):
    rows = [(None, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [3.0, 2.5]), (None, [0.0, 1.0])]
    got = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(str(r.vec_id) for r in got.filter("component = 1").collect()) == ["1", "1", "None", "None"]


def test_ill_conditioned_passes(spark):
    draw = np.random.default_rng(5)
    wide = draw.integers(-(2 ** 30), 2 ** 30, (200, 1)) / 64
    vectors = np.column_stack([wide, wide + draw.integers(-64, 64, (200, 1)) / 64, draw.integers(-3, 3, (200, 2)) / 64])
    x, n, sums, values, _ = brute(vectors)
    fit = whitening.fit_list(spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>"))
    model = whitening.fit(fit)
    assert values[0] / values[-1] > 1e13 and model.n == n and (model.sums == sums).all()
    exact = np.linalg.svd((np.unique(x, axis=0) * n - sums) / n, compute_uv=False) ** 2 / n
    assert np.abs(model.eigenvalues / exact - 1).max() < 1e-4 and model.identity_error < 1e-4


def test_too_large_deviation_is_an_error(spark):
    rows = [(i, [float(i) * 1e7]) for i in range(40)]
    with pytest.raises(Exception, match="64 bits"):
        whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).agg(F.max("deviation")).collect()
