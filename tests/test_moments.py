"""Correlations from co-moments and densities from grid sums, against numpy."""

import math

import numpy as np
import pytest

from riskframe.operators.profile import corr_matrix, kde_curve


def test_corr_matrix_with_nulls_and_constants(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)) + np.array([1e6, 0, 5, -3, 0])
    x[:, 1] += 0.5 * x[:, 0] - 5e5
    x[:, 4] = 0.1
    hide = rng.random((400, 5)) < 0.15
    rows = [tuple(None if h else float(v) for v, h in zip(r, m, strict=True)) + (None if i % 7 else float("nan"),)
            for i, (r, m) in enumerate(zip(x, hide, strict=True))]
    names = ["a", "b", "c.d", "e", "flat", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(3)
    got = {(r.col_i, r.col_j): r.r for r in corr_matrix(df, names).collect()}
    assert len(got) == 30
    for i, a in enumerate(names[:4]):
        for j, b in enumerate(names[:4]):
            if i != j:
                both = ~hide[:, i] & ~hide[:, j]
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
        assert got[a, "flat"] is None and got["none", a] is None


def test_corr_matrix_of_many_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 200))
    names = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names)).repartition(2)
    got = {(r.col_i, r.col_j): r.r for r in corr_matrix(df, names).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 200 * 199
    assert max(abs(got[f"c{i}", f"c{j}"] - want[i, j]) for i in range(200) for j in range(200) if i != j) < 1e-9


def test_kde_curve(spark):
    rng = np.random.default_rng(2)
    values = [*rng.normal(size=500).tolist(), *[0.25] * 300]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(4)
    got = kde_curve(df, "x", gridsize=50).orderBy("idx").collect()
    v, n = np.array(values), len(values)
    h = v.std(ddof=1) * n ** -0.2
    grid = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 50)
    want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(1) / (n * h * math.sqrt(2 * math.pi))
    assert [r.grid for r in got] == pytest.approx(grid.tolist()) and [r.density for r in got] == pytest.approx(want.tolist())
    assert kde_curve(df.where("x = 0.25"), "x").count() == 0
