"""Bounded exact quantile selection equals Spark's exact ``percentile``."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators.profile import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


def _ref(df, cols):
    r = df.agg(*[F.percentile(F.col(c).cast("double"), PROBS).alias(c) for c in cols]).first()
    return {c: r[c] for c in cols}


@pytest.mark.parametrize("max_interior,accuracy", [(10_000, 10_000), (20, 50), (3, 20)])
def test_bounded_equals_exact(spark, max_interior, accuracy):
    rows = [(i, float((i * 7919) % 1013) / 7.0 if i % 13 else None, 5.0 if i % 3 == 0 else float(i % 97), i % 2)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, x double, hot double, b int").repartition(4)
    cols = ["x", "hot", "b"]
    got = exact_quantiles(df, cols, PROBS, accuracy=accuracy, max_interior=max_interior)
    ref = _ref(df, cols)
    for c in cols:
        assert got[c] == pytest.approx(ref[c], rel=1e-12, abs=1e-12), c


def test_bounded_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (2.5,)], "x double")
    assert exact_quantiles(df, ["x"], PROBS, max_interior=1) == {"x": [2.5] * len(PROBS)}
    assert exact_quantiles(df.filter("x > 10"), ["x"], PROBS) == {"x": None}


def test_process_data_bounded_equals_exact(spark):
    from conftest import SF_SMALL

    from riskframe.config import PATIENT_ROLES
    from riskframe.functions.exprs import round_all
    from riskframe.operators.features import feature_transform
    from riskframe.plans.prepare import process_data
    from riskframe.sources.fixtures import KEY, patients_dirty
    f = feature_transform(patients_dirty(spark, SF_SMALL))
    a = round_all(process_data(f, PATIENT_ROLES, KEY).data, 9)
    b = round_all(process_data(f, PATIENT_ROLES, KEY, quantile_method="bounded").data, 9)
    cols = sorted(a.columns)
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_heavy_ends_do_not_make_the_collect_grow(spark, monkeypatch):
    df = spark.range(40_040).select(F.when(F.col("id") < 20_000, 0.0).when(F.col("id") >= 20_040, 1.0).otherwise(
        (F.col("id") - 19_999) / 100.0).alias("x")).repartition(4)
    want, sizes, collect = df.agg(F.percentile("x", 0.5)).first()[0], [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (rows := collect(self), sizes.append(len(rows)))[0])
    got = exact_quantiles(df, ["x"], [0.5], accuracy=1000, max_interior=10)
    assert got == {"x": [pytest.approx(want, rel=1e-12)]} and max(sizes, default=0) <= 20


def test_three_scans_and_nan(spark, monkeypatch):
    df = spark.range(200_000).select(F.when(F.col("id") % 5 == 0, float("nan")).otherwise((F.col("id") * 7919 % 200_003) / 3.0).alias("x"),
                                     (F.col("id") % 1000 / 8).alias("y")).repartition(3)
    calls, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: (calls.append(1), agg(self, *a))[1])
    got = exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.9], accuracy=4096, max_interior=5000)
    assert len(calls) == 3  # rows, sketches, counts; then one grouped collection
    want = df.agg(*[F.percentile(c, [0.25, 0.5, 0.9]).alias(c) for c in ("x", "y")]).first()
    assert got["y"] == pytest.approx(want["y"]) and got["x"][:2] == pytest.approx(want["x"][:2])
    assert got["x"][2] != got["x"][2] and want["x"][2] != want["x"][2]
