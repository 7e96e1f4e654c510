"""The model queries are registered at the reference's sizes."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators.boosting import BoostedTrees
from riskframe.plans import q_models as Q


def test_forest_importance_at_spark_depth_limit(spark, monkeypatch):
    from conftest import SF_SMALL
    asked = {}
    monkeypatch.setattr(Q.MD, "fit", lambda df, name, feats, label, **kw: asked.update(kw))
    monkeypatch.setattr(Q.MD, "importance_frame", lambda *a, **kw: None)
    Q.q_rf_importance(spark, SF_SMALL)
    assert asked == {"numTrees": 100, "maxDepth": 30}


def test_summary_and_train_many_take_all_models(spark, monkeypatch):
    asked = []

    def stop(train, test, names, feats, label, **kw):
        asked.append((list(names), kw))
        raise KeyboardInterrupt
    monkeypatch.setattr(Q, "modelling_data", lambda *a, **kw: (None, None, []))
    monkeypatch.setattr(Q.MD, "train_many", stop)
    for q in (Q.q_summary, Q.q_train_many):
        with pytest.raises(KeyboardInterrupt):
            q(spark, "")
    assert asked == [(["logistic_regression", "random_forest", "xgboost", "lightgbm", "catboost"], {})] * 2


def test_evaluate_models_isolates_scoring(spark):
    rows = [(float(i), float(i % 7), int(i % 10 > 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, diabetes int, fold int")
    good, odd = (Q.MD.fit(df, "logistic_regression", [c], "diabetes") for c in "xy")
    cv = Q.MD.cross_validate(df, "logistic_regression", ["x"], "diabetes").withColumn("model", F.lit("good"))
    # fails only when rows are scored: a null feature
    test = df.withColumn("y", F.when(F.col("x") != 3, F.col("y")))
    summary, long, best, status = Q.MD.evaluate_models(df, test, {"odd": odd, "good": good}, "diabetes", cv)
    assert {r.model: r.status for r in status.collect()} == {"odd": "failed", "good": "ok"}
    assert [r.model for r in summary.collect()] == ["good"] and best.first()["best_model"] == "good"
    got = {(r.split, r.metric) for r in long.collect()}
    assert {("train", "f1"), ("test", "f1"), ("test", "roc_auc"), ("cv", "cv_f1_mean")} <= got
    with pytest.raises(ValueError):
        Q.MD.evaluate_models(df, df.where("false"), {"good": good}, "diabetes")


def test_tuning_takes_the_whole_space(spark, monkeypatch):
    asked = []

    def stop(train, feats, label, *args, **kw):
        asked.append((args, kw))
        raise KeyboardInterrupt
    monkeypatch.setattr(Q, "modelling_data", lambda *a, **kw: (None, None, []))
    monkeypatch.setattr(Q.T, "tune", stop)
    monkeypatch.setattr(Q.T, "tuning_cv", stop)
    for q in (Q.q_tune, Q.q_final_fit, Q.q_tuning_cv):
        with pytest.raises(KeyboardInterrupt):
            q(spark, "")
    assert asked == [((), {}), ((), {}), ((Q.T.draw(0),), {})] and Q.T.PATIENCE == 50
    assert all(lo <= Q.T.draw(0)[n] <= hi for n, (_, lo, hi) in Q.T.SPACE.items())


@pytest.mark.parametrize("patience", [2, 5])
def test_stopping_waits_for_its_patience(spark, patience):
    rows = [(float(i * 37 % 101), float(i * i % 53), int((i * 37 % 101) * 3 + (i * i % 53) + i % 40 > 190)) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, diabetes int").repartition(1).cache()
    train, held = df.where("x < 60 OR y > 30"), df.where("NOT (x < 60 OR y > 30)").union(df.where("y < 8"))
    kw = {"maxDepth": 2, "stepSize": 0.3}
    whole = Q.T.fit_rounds(train, ["x", "y"], "diabetes", 9, kw["stepSize"], maxDepth=2)
    aucs = []
    for n in range(1, 10):
        cut = BoostedTrees(whole.features, whole.step, whole.trees[:n])
        p = Q.MD.predict(cut, held, "diabetes")
        aucs.append(M.roc_auc(p).first()["roc_auc"])
        if n == 4:  # the first rounds do not depend on how many follow
            short = Q.MD.predict(Q.T.fit_rounds(train, ["x", "y"], "diabetes", n, kw["stepSize"], maxDepth=2), held, "diabetes")
            assert sorted(short.collect()) == sorted(p.collect())
    best = 0
    for n, a in enumerate(aucs):
        if a > aucs[best]:
            best = n
        elif n - best >= patience:
            break
    for block in (2, 10):
        kept = Q.T.fit_rounds(train, ["x", "y"], "diabetes", 9, kw["stepSize"], held=held, patience=patience, block=block, maxDepth=2)
        assert len(kept.trees) == best + 1
