"""Single validation rules, imputation fits and the distributed factorize path."""

from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.operators import validate as V
from riskframe.operators.profile import factorize


def _rows(df):
    return sorted(tuple(r) for r in df.select("rule", "column_name", "severity", "value", "n_bad").collect())


def test_allowed_values_counts_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), ("z",), (None,)], "c string")
    assert _rows(V.allowed_values(df, {"c": ["a", "b"]})) == [
        ("allowed_values", "c", "warning", "<null>", 1), ("allowed_values", "c", "warning", "z", 2)]


def test_binary_domain_and_negative(spark):
    df = spark.createDataFrame([(0, 1.0), (1, -2.0), (2, -1.0), (None, 3.0)], "b int, x double")
    assert _rows(V.binary_domain(df, ["b"])) == [
        ("binary_domain", "b", "error", "2", 1), ("binary_domain", "b", "error", "<null>", 1)]
    assert _rows(V.non_negative(df, ["x"])) == [("non_negative", "x", "warning", "negative", 2)]
    assert V.non_negative(df.filter("x > 0"), ["x"]).count() == 0


def test_target_classes(spark):
    df = spark.createDataFrame([("F",), ("P",), ("F",)], "t string")
    assert _rows(V.target_classes(df, "t", ["F", "O"])) == [
        ("class_missing", "t", "warning", "O", 0), ("unexpected_class", "t", "error", "P", 1)]
    assert _rows(V.target_classes(df, "nope", [0, 1])) == [("target_missing", "nope", "error", None, None)]


def test_not_empty(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert V.not_empty(df).first()["passed"] is True
    assert V.not_empty(df.filter("a > 1")).first()["passed"] is False


def test_impute_stats_and_types(spark):
    df = spark.createDataFrame([(1.0, 1, "x"), (3.0, 1, None), (None, 0, "y"), (2.0, None, "y")],
                               "c double, b int, s string")
    st = {r["column_name"]: r for r in clean.impute_stats(df, ["c"], ["s"], ["b"]).collect()}
    assert st["c"]["median"] == 2.0 and st["c"]["n_missing"] == 1
    assert st["s"]["mode"] == "y" and st["b"]["mode"] == "1"
    fills = clean.fit_impute(df, ["c"], ["s"], ["b"]).params["fills"]
    assert fills == {"c": 2.0, "s": "y", "b": 1}


def test_factorize_distributed_equals_single_task(spark):
    vals = [(i, f"v{(i * 7919) % 503:04d}" if i % 11 else None) for i in range(3000)]
    vals += [(3000 + i, "v0001") for i in range(1500)]  # one value held by a third of the rows
    df = spark.createDataFrame(vals, "id int, s string").repartition(5)
    a = factorize(df, "s", "a")
    b = factorize(df, "s", "b", broadcast_max_rows=10, values_per_task=37)
    j = a.join(b.select("id", "b"), "id")
    assert j.count() == 4500
    assert j.filter(F.col("a") != F.col("b")).count() == 0
    assert j.agg(F.min("a"), F.max("a")).first() == (-1, 502)


def test_factorize_columns_equals_one_by_one(spark):
    from riskframe.operators.profile import factorize_columns
    rows = [(i, f"a{i % 7}" if i % 5 else None, f"b{(i * 3) % 11}", i % 4) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, s string, t string, n int")
    one = factorize(factorize(factorize(df, "s"), "t"), "n")
    many = factorize_columns(df, ["s", "t", "n"])
    many_spread = factorize_columns(df, ["s", "t"], broadcast_max_rows=3, values_per_task=4)
    a = sorted(map(tuple, one.select("id", "s", "t", "n").collect()))
    assert a == sorted(map(tuple, many.select("id", "s", "t", "n").collect()))
    b = sorted(map(tuple, one.select("id", "s", "t").collect()))
    assert b == sorted(map(tuple, many_spread.select("id", "s", "t").collect()))
