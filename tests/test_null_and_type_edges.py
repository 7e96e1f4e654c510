"""Typed validation, NaN, empty bins and columns, curves down to the last score."""

import pytest

from riskframe.operators import clean, metrics as M, profile as P, validate as V
from riskframe.operators.knn import knn


def test_zero_as_double_is_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.5, 1.0), (float("nan"), 0.0)], "b double, t double")
    assert {(r["value"], r["n_bad"]) for r in V.binary_domain(df, ["b"]).collect()} == {
        ("0.5", 1), (V.NULL_TEXT, 1)}
    assert V.target_classes(df, "t", [0, 1]).count() == 0
    assert V.target_classes(df.where("t = 1"), "t", [0, 1]).collect()[0]["rule"] == "class_missing"


def test_negative_values_only(spark):
    df = spark.createDataFrame([(1.0, -2.0), (-1.0, 3.0), (None, 4.0)], "a double, b double")
    assert {(r["column_name"], r["n_bad"]) for r in V.non_negative(df, ["a", "b"]).collect()} == {("a", 1), ("b", 1)}


def test_describe_takes_nan_as_missing(spark):
    r = P.describe(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")).first()
    assert (r["count"], r["mean"], r["max"]) == (2, 2.0, 3.0)


def test_histogram_empty_bins_and_schema(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (10.0,)], "x double")
    h = P.histogram(df, ["x"], bins=5)
    assert sorted((r["bin"], r["n"]) for r in h.collect()) == [(0, 3), (1, 0), (2, 0), (3, 0), (4, 1)]
    none = P.histogram(df.where("x > 99"), ["x"])
    assert none.columns == h.columns and none.count() == 0


def test_box_stats_without_values_and_outliers(spark):
    df = spark.createDataFrame([(float(x), None) for x in [1, 2, 3, 4, 100, 100]], "x double, y double")
    rows = {r["column_name"]: r for r in P.box_stats(df, ["x", "y"], whisker=0.5).collect()}
    assert rows["y"]["median"] is None and rows["y"]["n_outliers"] == 0
    low, high = (rows["x"]["q1"] - 0.5 * (rows["x"]["q3"] - rows["x"]["q1"]),
                 rows["x"]["q3"] + 0.5 * (rows["x"]["q3"] - rows["x"]["q1"]))
    want = {(v, n) for v, n in ((1.0, 1), (2.0, 1), (3.0, 1), (4.0, 1), (100.0, 2)) if not low <= v <= high}
    assert {(r["value"], r["n"]) for r in P.box_outliers(df, ["x", "y"], whisker=0.5).collect()} == want
    assert P.box_outliers(df, ["y"]).count() == 0


def test_modes_by_grouped_counts(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", None), ("a", 0), (None, 0)], "c string, n int")
    assert clean.fit_impute(df, [], ["c"], ["n"]).params["fills"] == {"c": "a", "n": 0}


def test_pr_curve_has_every_score(spark):
    df = spark.createDataFrame([(1, .9), (0, .8), (0, .7), (0, .2)], "label int, p1 double")
    pts = sorted((r["threshold"] is None, r["threshold"] or 0, r["precision"], r["recall"]) for r in M.pr_curve(df).collect())
    assert pts == [(False, .2, .25, 1.0), (False, .7, 1 / 3, 1.0), (False, .8, .5, 1.0), (False, .9, 1.0, 1.0),
                   (True, 0, 1.0, 0.0)]
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    M.roc_auc(df).collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_both_areas_from_one_curve(spark):
    df = spark.createDataFrame([("m", 1, .9), ("m", 0, .8), ("m", 1, .7)], "model string, label int, p1 double")
    both = M.curve_areas(df, ["model"]).first()
    assert both["roc_auc"] == M.roc_auc(df, ["model"]).first()["roc_auc"]
    assert both["average_precision"] == M.average_precision(df, ["model"]).first()["average_precision"]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_knn_rejects_missing_features(spark, bad):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", bad, 1.0)], "k string, x double, y double")
    with pytest.raises(ValueError, match="without nulls"):
        knn(df, ["x", "y"], "k", 1)


def test_knn_with_sparse_leaves(spark):
    from riskframe.operators.knn import knn_bruteforce
    rows = [(str(i), float(i % 7) * 10, float(i * i % 13), i % 9 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, x double, y double, q boolean")
    got = sorted((r["q_key"], r["rank"], r["n_key"]) for r in knn(df, ["x", "y"], "k", 5, "q", slab_rows=3).collect())
    want = knn_bruteforce(df, ["x", "y"], "k", 5, "q")
    assert got == sorted(zip(want["q_key"], want["rank"].astype(int), want["n_key"]))


def test_missing_manifest_is_empty_but_errors_are_raised(spark, tmp_path):
    from riskframe.sources import snapshots
    assert snapshots.list_versions(spark, str(tmp_path / "none")).count() == 0
    broken = tmp_path / "bad" / "manifest"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        snapshots.list_versions(spark, str(tmp_path / "bad")).count()
