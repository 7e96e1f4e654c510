"""Work of one task must not follow the input: leaf search, sides, files."""

import glob
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskframe.operators.knn import _block_fn
from riskframe.session import checkpoint_dir
from riskframe.sources import files

from conftest import SF_SMALL

AXES = ["a", "b", "c", "d"]


def _group(n, seed=3):
    rng = np.random.default_rng(seed)
    x = {c: rng.integers(0, 90, n).astype(float) for c in AXES}
    return pd.DataFrame({**x, "vid": np.arange(n), "m": rng.integers(1, 3, n),
                         "need": rng.integers(1, 6, n), "r2": np.nan})


def test_leaf_search_is_exact():
    for n in (1, 3, 70, 3000):
        g = _group(n)
        out = _block_fn(AXES, 5, False)(g, g)
        bounds = out[out["summary"]].set_index("qvid")["r2"]
        found = out[~out["summary"]].groupby("qvid")
        x = g[AXES].to_numpy()
        for i in range(0, n, max(1, n // 60)):
            d = ((x[i] - x) ** 2).sum(axis=1)
            d[i] = np.inf
            order = [j for j in np.argsort(d, kind="stable") if np.isfinite(d[j])]
            covers = np.flatnonzero(np.cumsum(g["m"].to_numpy()[order]) >= g["need"][i])
            reach = d[order[covers[0]]] if len(covers) else np.inf
            want = {(j, d[j]) for j in order if d[j] <= reach}
            got = set(zip(*found.get_group(i)[["cvid", "d2"]].to_numpy().T)) if i in found.groups else set()
            assert got == want and bounds[i] == reach


def test_leaf_search_with_a_radius_keeps_what_lies_within():
    g, c = _group(400), _group(900, seed=4)
    g["r2"], c["vid"] = 200.0, c["vid"] + 1000
    out = _block_fn(AXES, 5, True)(g, c)
    assert not out["summary"].any() and (out["d2"] <= 200).all()
    d = ((g[AXES].to_numpy()[:, None] - c[AXES].to_numpy()[None]) ** 2).sum(axis=2)
    nearest = d.min(axis=1)
    got = out.groupby("qvid")["d2"].min()
    assert set(got.index) == set(np.flatnonzero(nearest <= 200).tolist())
    assert (got == nearest[got.index]).all()


def test_leaf_search_does_not_compare_every_pair():
    """Seconds a query over a leaf sixteen times as large (before: ten times as many)."""
    def each(n):
        g = _group(n)
        t0 = time.process_time()
        _block_fn(AXES, 5, False)(g, g)
        return (time.process_time() - t0) / n
    each(500)
    assert each(32_768) < 4 * each(2048)


def test_recombine_counts_sides_without_a_window(spark):
    out = E.queries()["recombine"](spark, SF_SMALL)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert {(r["split"], r["n_side"]) for r in out.select("split", "n_side").distinct().collect()} == set(n.items())


def test_archives_follow_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 100)
    df = spark.range(700).selectExpr("id", "id * 0.5 AS x")
    folder = str(tmp_path / "zip")
    assert len(files.write_zip_csv(df, folder).collect()) == 7
    assert sorted(map(tuple, files.read_zip_csv(spark, folder, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_stream_files_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 1000)
    pattern = f"{checkpoint_dir(spark).replace('file:', '')}/riskframe-io/stream-src-*/part-*"
    before = set(glob.glob(pattern))
    rows = E.queries()["stream_risk_by_bmi"](spark, SF_SMALL).collect()
    n = sum(r["n_patients"] for r in rows)
    assert len(set(glob.glob(pattern)) - before) == -(-n // 1000) > 4


def test_distinct_keys_are_spread_by_rows(spark):
    """A task looks for distinct keys among a bounded number of rows, whatever the split of the file."""
    from riskframe.sources.fixtures import distinct_keys
    keys = spark.range(0, 4000, 1, 1).selectExpr("id % 3000 AS k", "cast(id % 3000 % 7 AS int) AS n")
    spread = distinct_keys(keys, rows_per_task=200)
    assert spread.count() == 3000 and spread.join(keys, ["k", "n"], "left_anti").count() == 0
    rows = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) >= 15 and max(rows) <= 400
    few = distinct_keys(keys, rows_per_task=4000)
    assert few.count() == 3000


def test_preparation_reads_its_rows_once(spark):
    """Every fit of the preparation starts from written rows, not from the source."""
    from riskframe.config import PATIENT_ROLES
    from riskframe.plans.prepare import process_data
    n, seen = 300, spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x
    rows = spark.range(0, n, 1, 2).select(
        "id", F.when(F.col("id") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.udf(look, "double")((F.col("id") % 70).cast("double")).alias("age"),
        (F.col("id") % 3 == 0).cast("int").alias("hypertension"), F.lit(0).alias("heart_disease"),
        F.when(F.col("id") % 5 > 0, "never").alias("smoking_history"),
        F.when(F.col("id") % 7 > 0, 20.0 + F.col("id") % 11).alias("bmi"), (4.0 + F.col("id") % 4).alias("HbA1c_level"),
        (90.0 + F.col("id") % 90).alias("blood_glucose_level"), (F.col("id") % 4 == 0).cast("int").alias("diabetes"))
    # the UDF's rows count its evaluations, one a projection
    out = process_data(rows, PATIENT_ROLES, ["id"]).data
    assert out.count() == n and out.filter("split = 'test'").count() == 60
    assert out.where("bmi is null or smoking_history is null").count() == 0
    assert seen.value <= 2 * n  # nan_to_null may read a value twice


def test_train_rows_are_dealt_evenly(spark):
    """A fit works on all cores, whatever the partitions its rows came in."""
    from riskframe.plans.train import FEWEST_ROWS, spread
    n = 4 * FEWEST_ROWS
    rows = spark.range(0, n, 1, 1).selectExpr("md5(cast(id AS string)) AS rid")
    sizes = [r["count"] for r in spread(rows, "rid", n).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and sum(sizes) == n and max(sizes) < 1.1 * FEWEST_ROWS
    assert spread(rows, "rid", FEWEST_ROWS).rdd.getNumPartitions() == 1
