"""Hand-made edge rows (FIXTURES.md §4)."""

import math

from pyspark.sql import functions as F

from riskframe.functions.features import age_risk, bmi_category, feature_columns
from riskframe.operators import clean
from riskframe.operators import metrics as M
from riskframe.operators.profile import factorize


def test_bmi_category_bounds(spark):
    df = spark.createDataFrame([(18.5,), (18.6,), (24.9,), (25.0,), (29.9,), (31.0,), (None,)], "bmi double")
    got = [r[0] for r in df.select(bmi_category(F.col("bmi"))).collect()]
    assert got == [0, 1, 1, 2, 2, 3, -1]


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(40.0, 140.0, 5.7), (40.1, 140.1, 5.8)], "age double, g double, a double")
    f = feature_columns(glucose="g", hba1c="a")
    rows = df.withColumn("hypertension", F.lit(0)).withColumn("heart_disease", F.lit(0)) \
        .withColumn("bmi", F.lit(20.0)).withColumn("smoking_history", F.lit("never")) \
        .select(age_risk(F.col("age")).alias("r"), f["metabolic_score"].alias("m")).collect()
    assert [r["r"] for r in rows] == [0, 1]
    assert rows[0]["m"] == 0.0 and abs(rows[1]["m"] - 0.8) < 1e-12


def test_medical_risk_extremes(spark):
    df = spark.createDataFrame([(1, 1, 50.0, 35.0), (0, 0, 30.0, 20.0)],
                               "hypertension int, heart_disease int, age double, bmi double")
    f = feature_columns()
    got = [r[0] for r in df.select(f["medical_risk_score"]).collect()]
    assert abs(got[0] - 1.0) < 1e-12 and got[1] == 0.0


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    imp = clean.fit_impute(df, categorical=["c"])
    assert imp.params["fills"] == {"c": "a"}
    assert [r[0] for r in imp.transform(df).collect()][-1] == "a"


def test_zscore_constant_column(spark):
    df = spark.createDataFrame([(5.0,)] * 10, "x double")
    r = clean.zscore_outliers(df, ["x"]).first()
    assert r["n_outliers"] == 0
    assert clean.fit_winsorize(df, ["x"]).params["bounds"] == {}


def test_average_precision_and_auc(spark):
    rows = [(1, .9), (0, .8), (1, .7), (0, .7), (1, .2), (0, .1)]
    df = spark.createDataFrame(rows, "label int, p1 double")
    ap = M.average_precision(df).first()[0]
    auc = M.roc_auc(df).first()[0]
    assert abs(ap - 0.7) < 1e-12
    assert abs(auc - 0.611111111) < 1e-6
    # the bucketed (at-scale) path gives the same numbers
    assert abs(M.average_precision(df, rows_per_bucket=2).first()[0] - ap) < 1e-12
    assert abs(M.roc_auc(df, rows_per_bucket=2).first()[0] - auc) < 1e-12


def test_factorize_sorted_null_minus_one(spark):
    df = spark.createDataFrame([("O",), ("U",), ("N",), (None,)], "c string")
    got = sorted((r["c"] for r in factorize(df, "c").collect()))
    assert got == [-1, 0, 1, 2]


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = M.basic_metrics(df).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0 and r["accuracy"] == 1.0


def test_validate_empty_and_missing(spark):
    from riskframe.config import PATIENT_ROLES
    from riskframe.operators.validate import validate, validation_summary
    empty = spark.createDataFrame([], "gender string, age double")
    rep = validate(empty, PATIENT_ROLES).collect()
    assert [(r["rule"], r["severity"]) for r in rep] == [("not_empty", "error")]
    # missing columns stop the column rules; the target rule still runs
    df = spark.createDataFrame([(1, 7)], "diabetes int, extra int")
    rules = {(r["rule"], r["column_name"]) for r in validate(df, PATIENT_ROLES).collect()}
    assert ("missing_column", "age") in rules
    assert ("unexpected_class", "diabetes") not in rules
    assert ("class_missing", "diabetes") in rules
    assert validation_summary(validate(df, PATIENT_ROLES)).first()["is_valid"] is False


def test_dedup_hot_group(spark):
    # a third of the rows identical: collapses map-side, result exact
    rows = [(1, "a")] * 300 + [(i, "b") for i in range(600)]
    df = spark.createDataFrame(rows, "x int, y string").repartition(8)
    assert clean.dedup(df).count() == 601
