"""Model queries (§2.8-2.9): rows-only checks (model outputs have no SQL twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import round_all
from ..operators import balance as B
from ..operators import models as MD
from ..operators import training as TR
from ..operators import tune as T
from ..operators.profile import factorize_columns
from ..operators.split import stratified_split
from ..session import cut_lineage
from ..sources import snapshots
from ..sources.fixtures import KEY, patients
from .catalog import register
from .train import TARGET, modelling_data


def _model_query(name):
    def q(spark, sf):
        train, test, feats = modelling_data(spark, sf, folds=0, dealt=name != "logistic_regression")
        m = MD.fit(train, name, feats, TARGET)
        return round_all(MD.predict(m, test, TARGET, keep=["rid"]).withColumn("model", F.lit(name)))
    q.__doc__ = f"{name} profile: fit on the SMOTE-balanced train rows, predict the test rows."
    return q


for _n in MD.MODELS:
    register({"xgboost": "gbt_xgb_profile", "lightgbm": "gbt_lgbm_profile", "catboost": "gbt_catboost_profile"}.get(
        _n, _n))(_model_query(_n))


@register("rf_importance_topk")
def q_rf_importance(spark, sf):
    """Random-forest importances (100 trees, balanced weights) on coded columns, top 8;
    depth 30, Spark's limit (the reference sets none)."""
    p = patients(spark, sf).drop("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p = cut_lineage(factorize_columns(p, C.CATEGORICAL))  # the forest reads it several times
    feats = [c for c in C.EXPECTED_COLUMNS if c != TARGET]
    m = MD.fit(p, "random_forest", feats, TARGET, numTrees=100, maxDepth=30)
    return MD.importance_frame(spark, m, feats, top_k=8)


@register("feature_importance")
def q_feature_importance(spark, sf):
    """|coefficient| per feature of the logistic model, descending."""
    train, _, feats = modelling_data(spark, sf, folds=0, dealt=False)
    return round_all(MD.importance_frame(spark, MD.fit(train, "logistic_regression", feats, TARGET), feats))


@register("cross_validate")
def q_cv(spark, sf):
    """Five stratified folds of the logistic model: metrics per fold."""
    train, _, feats = modelling_data(spark, sf, dealt=False)
    return round_all(MD.cross_validate(train, "logistic_regression", feats, TARGET, parallelism=5))


@register("train_test_summary")
def q_summary(spark, sf):
    """Train/test metrics, CV mean ± std and test ROC-AUC of all models at their
    default sizes; ``is_best`` marks the one of highest test F1."""
    train, test, feats = modelling_data(spark, sf)
    _, cv, _, models = MD.train_many(train, test, list(MD.MODELS), feats, TARGET)
    summary, _, best, _ = MD.evaluate_models(train, test, models, TARGET, cv)
    best = best.select(F.col("best_model").alias("model"), F.lit(True).alias("is_best"))
    return round_all(summary.join(best, "model", "left").withColumn("is_best", F.coalesce("is_best", F.lit(False))))


@register("tune")
def q_tune(spark, sf):
    """Seeded search of 20 trials over the whole space of boosted-tree settings, objective .7 recall + .3 accuracy, 3 folds."""
    train, _, feats = modelling_data(spark, sf, folds=3)
    return round_all(T.tune(train, feats, TARGET))


@register("train_model")
def q_train_model(spark, sf):
    """The logistic model trained as one operation (folds, fit on all train rows,
    train metrics, saved model, run record); the model saved under that record is
    loaded and predicts the test rows, which carry the record's CV means and
    deviations and train metrics."""
    from .q_io import scratch
    train, test, feats = modelling_data(spark, sf, folds=0, dealt=False)
    base = scratch(spark, "training")
    run = TR.train_model(train, "logistic_regression", feats, TARGET, ["rid"], base, C.N_FOLDS, C.SEED, parallelism=5)
    record = snapshots.read_runs(spark, base).where(F.col("run_id") == run.run_id)
    record = {(r["kind"], r["key"]): r for r in record.collect()}  # one row a parameter or metric
    measured = {key: F.lit(r["value"]) for (kind, key), r in sorted(record.items()) if kind != "param"}
    model = MD.load(record["param", "model_path"]["text"])
    return round_all(MD.predict(model, test, TARGET, keep=["rid"]).withColumns(measured))


@register("final_fit")
def q_final_fit(spark, sf):
    """Best trial of a seeded search refit on all train rows; test report rows."""
    train, test, feats = modelling_data(spark, sf, folds=3)
    trials = T.tune(train, feats, TARGET)
    _, report, auc, _ = T.final_fit(train, test, feats, TARGET, T.best_params(trials))
    return round_all(report.withColumn("roc_auc", F.lit(auc.first()[0])))  # one number


@register("tuning_cv")
def q_tuning_cv(spark, sf):
    """One trial's fold loop: the held-out fold is the validation set (early stopping);
    rounds kept, accuracy, recall, F1 and ROC-AUC per fold."""
    train, _, feats = modelling_data(spark, sf, folds=3)
    rows = T.tuning_cv(train, feats, TARGET, T.draw(0))
    return round_all(spark.createDataFrame(rows, "fold int, rounds int, accuracy double, recall double, f1 double, "
                                                 "roc_auc double"))


@register("train_many")
def q_train_many(spark, sf):
    """All models at their default sizes: status, CV means and deviations, and
    the counts of train and test predictions; a failing model is recorded."""
    train, test, feats = modelling_data(spark, sf)
    preds, cv, status, _ = MD.train_many(train, test, list(MD.MODELS), feats, TARGET)
    n = preds.groupBy("model").pivot("split", ["train", "test"]).count()
    n = n.withColumnsRenamed({"train": "n_train_predictions", "test": "n_test_predictions"})
    out = status.select("model", "status", "error").join(MD.cv_summary(cv, ["model"]), "model", "left")
    return round_all(out.join(n, "model", "left"))


@register("train_run")
def q_train_run(spark, sf):
    """The logistic model trained as one operation; its record read back:
    dataset facts, parameters, CV means and deviations, train metrics."""
    from .q_io import scratch
    train, _, feats = modelling_data(spark, sf, folds=0, dealt=False)
    base = scratch(spark, "training")
    run = TR.train_model(train, "logistic_regression", feats, TARGET, ["rid"], base, C.N_FOLDS, C.SEED, parallelism=5)
    record = snapshots.read_runs(spark, base).where((F.col("run_id") == run.run_id) & (F.col("key") != "model_path"))
    return round_all(record.select("kind", "key", "value", "text"))


@register("cross_validate_resampled")
def q_cv_resampled(spark, sf):
    """Five folds of the logistic model, SMOTE on each fold's train rows alone:
    metrics per fold on rows that no synthetic row was made from."""
    train, _, feats = modelling_data(spark, sf, balance=None, dealt=False)

    def smote(df):
        return B.resample(df.drop("fold"), "smote", feats, TARGET, "rid", C.KNN_K, C.SEED)
    return round_all(MD.cross_validate(train, "logistic_regression", feats, TARGET, parallelism=C.N_FOLDS, rebalance=smote))


@register("gbt_catboost_categorical")
def q_catboost_categorical(spark, sf):
    """The catboost profile with gender and smoking history as category sets, fitted on the train rows; test predictions."""
    p = patients(spark, sf).withColumn("rid", F.md5(F.concat_ws("|", *KEY)))
    numeric = [c for c in C.EXPECTED_COLUMNS if c not in (TARGET, *C.CATEGORICAL)]
    p = p.select("rid", *[F.col(c).cast("double").alias(c) for c in numeric], *C.CATEGORICAL, TARGET).na.drop(subset=numeric)
    rows = cut_lineage(stratified_split(p, TARGET, ["rid"], C.TEST_SIZE, C.SEED))
    m = MD.fit_categorical(rows.where("split = 'train'"), "catboost", numeric, C.CATEGORICAL, TARGET)
    return round_all(MD.predict(m, rows.where("split = 'test'"), TARGET, keep=["rid"]))
