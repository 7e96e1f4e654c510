"""Training as one operation, folds rebalanced on their own, categorical trees."""
import threading
import time

import pytest
from pyspark.sql import functions as F

from riskframe.operators import balance as B
from riskframe.operators import models as MD
from riskframe.operators import training as TR
from riskframe.operators.split import stratified_folds
from riskframe.sources import snapshots


@pytest.fixture(scope="module")
def rows(spark):
    data = [(str(i), float(i % 23), float(i * 7 % 13), int(i * 7 % 13 > 9)) for i in range(120)]
    return spark.createDataFrame(data, "rid string, x double, y double, diabetes int")


def test_fold_count():
    assert [TR.fold_count(100, n) for n in (-1, 0, 1, 2, 5)] == [5, 5, 5, 2, 5]
    assert TR.fold_count(3, 5) == 2 and TR.fold_count(5, 5) == 5 and TR.fold_count(4, 1) == 2
    for n in (0, 1):
        with pytest.raises(ValueError):
            TR.fold_count(n, 5)


def test_train_model_records_one_run(spark, rows, tmp_path):
    base = str(tmp_path)
    run = TR.train_model(rows, "logistic_regression", ["x", "y"], "diabetes", ["rid"], base, folds=3, maxIter=7)
    record = snapshots.read_runs(spark, base)
    assert len([f for f in (tmp_path / "runs").iterdir() if f.name.endswith(".parquet")]) == 1
    got = {r.key: r.value if r.text is None else r.text for r in record.collect()}
    assert {r.run_id for r in record.collect()} == {run.run_id}
    assert (got["dataset_size"], got["feature_count"], got["cv_folds"], got["param_maxIter"]) == ("120", "2", "3", "7")
    assert got["class_distribution"] == '{"0": 93, "1": 27}'
    ok = run.cv.collect()
    assert len(ok) == 3 and got["n_folds"] == 3
    assert got["cv_mean_recall"] == pytest.approx(sum(r.recall for r in ok) / 3)
    assert got["train_roc_auc"] == pytest.approx(run.metrics["roc_auc"]) and "cv_std_roc_auc" in got
    again = MD.predict(MD.load(got["model_path"]), rows, "diabetes", ["rid"])
    assert again.exceptAll(MD.predict(run.model, rows, "diabetes", ["rid"])).count() == 0


def test_train_model_query_trains_as_one_operation(spark, rows, monkeypatch):
    """The query cross-validates, measures and records, and predicts with the model saved under its record."""
    from riskframe.plans import q_models as Q
    monkeypatch.setattr(Q, "modelling_data", lambda *a, **kw: (rows.where("rid % 4 > 0"), rows.where("rid % 4 = 0"), ["x", "y"]))
    runs, train = [], TR.train_model
    monkeypatch.setattr(Q.TR, "train_model", lambda *a, **kw: runs.append((train(*a, **kw), a)) or runs[-1][0])
    got = Q.q_train_model(spark, "").collect()
    (run, asked), = runs
    assert (asked[1], asked[6]) == ("logistic_regression", 5) and asked[0].count() == 90 and len(got) == 30
    cv = MD.cv_summary(run.cv).first().asDict()
    for r in got:
        assert r.n_folds == 5 and r.cv_mean_f1 == pytest.approx(cv["cv_f1_mean"], abs=1e-6)
        assert r.cv_std_recall == pytest.approx(cv["cv_recall_std"], abs=1e-6)
        assert r.train_roc_auc == pytest.approx(run.metrics["roc_auc"], abs=1e-6)
    want = {r.rid: r.p1 for r in MD.predict(run.model, rows, "diabetes", ["rid"]).collect()}
    assert all(r.p1 == pytest.approx(want[r.rid], abs=1e-6) for r in got)
    record = snapshots.read_runs(spark, asked[5])
    assert {r.run_id for r in record.collect()} == {run.run_id}


def test_failed_model_is_recorded_and_best_named(spark, rows, tmp_path):
    base = str(tmp_path)
    runs, errors = TR.train_models(rows, ["random_forest", "logistic_regression"], ["x", "y"], "diabetes", ["rid"], base,
                                   folds=2, params={"random_forest": {"numTrees": -1}})
    assert list(runs) == ["logistic_regression"] and list(errors) == ["random_forest"]
    failed = snapshots.read_runs(spark, base).where("run_name = 'random_forest-failed'")
    assert {r.key for r in failed.collect()} == {"model_type", "status", "error"}
    summary = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, test_f1 double")
    run_id = TR.record_summary(spark, base, summary)
    got = {r.key: r for r in snapshots.read_runs(spark, base).where(F.col("run_id") == run_id).collect()}
    assert got["best_model"].text == "a" and got["best_test_f1"].value == 0.5
    assert spark.read.option("header", True).csv(got["summary_path"].text).count() == 3


def test_folds_are_rebalanced_without_the_held_out_one(spark, rows):
    folded = stratified_folds(rows, "diabetes", ["rid"], 3)
    made = B.resample_folds(folded, "smote", ["x", "y"], "diabetes", "rid")
    fold = {r.rid: r.fold for r in folded.collect()}
    got = made.collect()
    for f in range(3):
        part = [r for r in got if r.held_out == f]
        assert all(fold[r.rid.split("#")[0]] != f for r in part)
        assert sum(r.diabetes for r in part) * 2 == len(part)
        alone = B.smote(folded.where(F.col("fold") != f), ["x", "y"], "diabetes", "rid").collect()
        assert sorted((r.rid, r.x, r.y) for r in part) == sorted((r.rid, r.x, r.y) for r in alone)


def test_fold_by_fold_sums_equal_the_whole_and_leave_no_tables(spark, rows):
    """Each fold is summed on its own; its tables are gone before the next fold's are written."""
    import os
    from riskframe import session
    folded = stratified_folds(rows, "diabetes", ["rid"], 3).localCheckpoint()
    left = []

    def summary(made):
        left.append(dict(session._open.paths))
        return made.groupBy("held_out", "diabetes", "synthetic").agg(
            F.count("*").alias("n"), F.count_if(F.col("fold") == F.col("held_out")).alias("own"), F.round(F.sum("x"), 6).alias("x"))
    got = B.resample_folds(folded, "smote", ["x", "y"], "diabetes", "rid", passthrough=("fold",), each=summary)
    made = B.resample_folds(folded, "smote", ["x", "y"], "diabetes", "rid", passthrough=("fold",))
    base = made.withColumn("base", F.substring_index("rid", "#", 1)).drop("fold").join(
        folded.select(F.col("rid").alias("base"), "fold"), "base")
    want = base.groupBy("held_out", "diabetes", "synthetic").agg(
        F.count("*").alias("n"), F.count_if(F.col("fold") == F.col("held_out")).alias("own"), F.round(F.sum("x"), 6).alias("x"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.where("own > 0").count() == 0
    assert len(left) == 3 and all(left) and not any(os.path.exists(p.removeprefix("file:")) for t in left for p in t)


def test_cross_validate_rebalances_only_the_other_folds(spark, rows):
    folded = stratified_folds(rows, "diabetes", ["rid"], 3)
    seen = []

    def keep(df):
        seen.append({r.fold for r in df.select("fold").distinct().collect()})
        return df
    cv = MD.cross_validate(folded, "logistic_regression", ["x", "y"], "diabetes", rebalance=keep)
    assert cv.where("status = 'ok'").count() == 3
    assert seen == [{1, 2}, {0, 2}, {0, 1}]


def test_folds_side_by_side_give_the_same_rows_and_stop_where_rows_are_many(spark, rows, monkeypatch):
    folded = stratified_folds(rows, "diabetes", ["rid"], 3).localCheckpoint()
    fit, now, most, lock = MD.fit, [0], [0], threading.Lock()

    def slow(*a, **kw):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(2)
        try:
            return fit(*a, **kw)
        finally:
            with lock:
                now[0] -= 1
    monkeypatch.setattr(MD, "fit", slow)

    def run(parallelism):
        most[0] = 0
        _, cv, status, _ = MD.train_many(folded, folded, ["logistic_regression"], ["x", "y"], "diabetes",
                                         parallelism=parallelism)
        assert status.first()["status"] == "ok"
        return [tuple(r) for r in cv.orderBy("fold").collect()], most[0]
    alone, n = run(1)
    assert n == 1
    assert run(3) == (alone, 3)
    monkeypatch.setattr(MD, "ROWS_AT_ONCE", folded.count())
    assert run(3) == (alone, 1)


def test_categories_are_sets(spark):
    names = [chr(97 + i % 26) + str(i % 8) for i in range(400)]
    data = [(n, float(i % 5), int(n[0] in "aeiou")) for i, n in enumerate(names)]
    df = spark.createDataFrame(data, "c string, x double, diabetes int")
    m = MD.fit_categorical(df, "catboost", ["x"], ["c"], "diabetes", maxIter=5, maxDepth=2, minInstancesPerNode=1,
                           subsamplingRate=1.0, featureSubsetStrategy="all")
    assert MD.predict(m, df, "diabetes").where("prediction <> label").count() == 0
    odd = spark.createDataFrame([("zz", 1.0), (None, 1.0)], "c string, x double")
    assert len({r.p1 for r in MD.predict(m, odd).collect()}) == 1
    with pytest.raises(ValueError):
        MD.fit_categorical(df, "logistic_regression", ["x"], ["c"], "diabetes")


def test_logistic_fit_reaches_the_optimum(spark):
    """Newton steps end where Spark's solver goes with a tight tolerance; its default stops short of it on such columns."""
    data = [(str(i), float(i % 97), float(i % 97) * (i % 13), float(i * 31 % 89) / 1000, 5.0, i % 4, int(i % 97 + i * 31 % 89 + i % 37 > 110))
            for i in range(3000)]
    df = spark.createDataFrame(data, "rid string, a double, b double, c double, d double, fold int, diabetes int").repartition(3).cache()
    feats = ["a", "b", "c", "d"]
    got = MD.fit(df, "logistic_regression", feats, "diabetes").stages[-1]
    want = MD.fit(df, "logistic_regression", feats, "diabetes", maxIter=5000, tol=1e-14).stages[-1]
    assert list(got.coefficients) == pytest.approx(list(want.coefficients), rel=1e-4, abs=1e-6) and got.coefficients[3] == 0
    assert got.intercept == pytest.approx(want.intercept, rel=1e-4)
    fewer = MD.fit(df, "logistic_regression", feats, "diabetes", C=1e-4).stages[-1]
    tight = MD.fit(df, "logistic_regression", feats, "diabetes", C=1e-4, maxIter=5000, tol=1e-14).stages[-1]
    assert list(fewer.coefficients) == pytest.approx(list(tight.coefficients), rel=1e-4, abs=1e-6)
    with pytest.raises(Exception, match="null"):
        MD.fit(df.withColumn("a", F.when(F.col("a") > 3, F.col("a"))), "logistic_regression", feats, "diabetes")


def test_logistic_folds_share_their_blocks(spark, rows, monkeypatch):
    folded = stratified_folds(rows, "diabetes", ["rid"], 3).localCheckpoint()
    alone = {f: MD.fit(folded.where(F.col("fold") != f), "logistic_regression", ["x", "y"], "diabetes").stages[-1] for f in range(3)}
    written, fits, blocks, fit = [], {}, MD.LG.blocks, MD.fit
    monkeypatch.setattr(MD.LG, "blocks", lambda *a: written.append(a) or blocks(*a))

    def seen(df, *a, **kw):
        m = fit(df, *a, **kw)
        fits[kw["shared"][1]] = m.stages[-1]
        return m
    monkeypatch.setattr(MD, "fit", seen)
    cv = MD.cross_validate(folded, "logistic_regression", ["x", "y"], "diabetes", parallelism=3)
    assert cv.where("status = 'ok'").count() == 3 and len(written) == 1
    for f, m in alone.items():
        assert [*fits[f].coefficients, fits[f].intercept] == pytest.approx([*m.coefficients, m.intercept], rel=1e-6)


def test_scratch_tables_are_dropped(spark, tmp_path):
    import os
    from riskframe.session import saved, scratch_tables
    at = lambda df: df._saved_path.removeprefix("file:")
    before = saved(spark.range(3))
    with scratch_tables() as keep:
        with scratch_tables() as keep_inner:
            a, b = saved(spark.range(4)), keep_inner(saved(spark.range(5)))
        c = saved(b.union(b))
        assert not os.path.exists(at(a)) and b.count() == 5
        keep(c)
    assert not os.path.exists(at(b)) and (before.count(), c.count()) == (3, 10)
