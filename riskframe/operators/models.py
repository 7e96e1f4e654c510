"""Models (§2.8): pyspark.ml estimators with the reference's profiles, CV, training.

Each ``fit`` is a series of distributed jobs; the driver only holds model
parameters and per-fold metric rows.
"""

from __future__ import annotations

import contextlib
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, saved, scratch_tables
from . import logistic as LG
from . import metrics as M

FEATURES_COL, LABEL_COL, WEIGHT_COL = "features", "label_d", "weight"


def balanced_weights(df: DataFrame, label: str, weight_col: str = WEIGHT_COL, counts: dict | None = None) -> DataFrame:
    """class_weight='balanced': n / (n_classes * n_c), from one grouped count."""
    counts = counts or class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    m = F.create_map(*[x for c, nc in counts.items() for x in (F.lit(c), F.lit(n / (k * nc)))])
    return df.withColumn(weight_col, m[F.col(label)])


def class_counts(df: DataFrame, label: str) -> dict:
    """class -> rows (one grouped count; one row per class reaches the driver)."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_weights(df: DataFrame, label: str, weights: dict, weight_col: str = WEIGHT_COL) -> DataFrame:
    m = F.create_map(*[x for c, w in weights.items() for x in (F.lit(c), F.lit(float(w)))])
    return df.withColumn(weight_col, F.coalesce(m[F.col(label)], F.lit(1.0)))


# name -> (estimator builder, weighting); profiles follow the reference defaults
def _lr(n_weight: float, **kw):
    c = kw.pop("C", 1.0)
    p = dict(maxIter=1000, elasticNetParam=0.0, regParam=1.0 / (c * n_weight), standardization=False)
    p.update(kw)
    return LogisticRegression(weightCol=WEIGHT_COL, **p)


def _rf(_, **kw):
    p = dict(numTrees=200, maxDepth=15, featureSubsetStrategy="sqrt", minInstancesPerNode=1, seed=42,
             maxMemoryInMB=1024)
    p.update(kw)
    return RandomForestClassifier(weightCol=WEIGHT_COL, **p)


def _gbt_xgb(_, **kw):
    p = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
    p.update(kw)
    return GBTClassifier(**p)


def _gbt_lgbm(_, **kw):
    p = dict(maxIter=100, maxDepth=10, stepSize=0.5, minInstancesPerNode=10, subsamplingRate=0.8,
             featureSubsetStrategy="0.8", seed=42)
    p.update(kw)
    return GBTClassifier(weightCol=WEIGHT_COL, **p)


def _gbt_cat(_, **kw):
    p = dict(maxIter=100, maxDepth=6, stepSize=0.1, minInstancesPerNode=10, subsamplingRate=0.8,
             featureSubsetStrategy="0.8", seed=42)
    p.update(kw)
    return GBTClassifier(**p)


MODELS = {
    "logistic_regression": (_lr, "balanced"),
    "random_forest": (_rf, "balanced"),
    "xgboost": (_gbt_xgb, None),
    "lightgbm": (_gbt_lgbm, {0: 1.0, 1: 2.0}),
    "catboost": (_gbt_cat, None),
}


def prepare_xy(df: DataFrame, features, label: str, weighting, counts: dict | None = None) -> DataFrame:
    out = df.withColumn(LABEL_COL, F.col(label).cast("double"))
    if weighting == "balanced":
        out = balanced_weights(out, label, counts=counts)
    elif isinstance(weighting, dict):
        out = class_weights(out, label, weighting)
    else:
        out = out.withColumn(WEIGHT_COL, F.lit(1.0))
    return out


def build(name: str, features, n_weight: float = 1.0, **params) -> Pipeline:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; available: {', '.join(MODELS)}")
    est = MODELS[name][0](n_weight, **params)
    est = est.setFeaturesCol(FEATURES_COL).setLabelCol(LABEL_COL)
    asm = VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="error")
    return Pipeline(stages=[asm, est])


def _newton(name: str, params: dict) -> bool:
    """Settings of Spark's solver (``maxIter``, ``tol`` ...) need that solver."""
    return name == "logistic_regression" and MODELS[name][1] == "balanced" and not set(params) - {"C"}


def fit(df: DataFrame, name: str, features, label: str, shared: tuple | None = None, **params) -> PipelineModel:
    """``shared``: logistic blocks of more rows than ``df`` and the fold that ``df`` leaves out of them."""
    weighting = MODELS[name][1] if name in MODELS else None
    n_w = 1.0
    if name == "logistic_regression":
        # the objective's total weight; balanced weights sum to the row count
        counts = class_counts(df, label)
        if _newton(name, params) and set(counts) == {0, 1}:
            return _fit_binary(df, features, label, counts, shared, **params)
        xy = prepare_xy(df, features, label, weighting, counts)
        n_w = float(sum(counts.values())) if weighting == "balanced" else xy.agg(F.sum(WEIGHT_COL)).first()[0]
    else:
        xy = prepare_xy(df, features, label, weighting)
    return build(name, features, n_w, **params).fit(xy)


def _fit_binary(df: DataFrame, features, label: str, counts: dict, shared: tuple | None, **params) -> PipelineModel:
    """The logistic profile on labels 0 and 1 at its optimum, as the model that
    ``LogisticRegression`` returns (without a training summary)."""
    sc, n = df.sparkSession.sparkContext, sum(counts.values())
    asm, est = build("logistic_regression", features, float(n), **params).getStages()
    weights = {c: n / (2 * counts[c]) for c in (0, 1)}
    # the penalty is a share of the total weight in Spark's objective, which is a mean
    with scratch_tables():
        rows, held_out = shared or (LG.blocks(df, features, label), None)
        coefficients, intercept = LG.fit_logistic(rows, len(features), weights, est.getRegParam() * n, held_out)
    est._transfer_params_to_java()
    fitted = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        est.uid, _py2java(sc, DenseVector(coefficients)), intercept)
    fitted = est._java_obj.copyValues(fitted, sc._jvm.org.apache.spark.ml.param.ParamMap())
    return PipelineModel([asm, est._copyValues(LogisticRegressionModel(fitted))])


def fit_categorical(df: DataFrame, name: str, features, categorical, label: str, **params) -> PipelineModel:
    """A tree profile on numeric ``features`` and ``categorical`` columns, whose
    values are split as sets, not by an order of codes.

    Values are indexed alphabetically; nulls and values that the fit has not
    seen share one category of their own.  The bins follow the largest number
    of categories, so none is merged or dropped (Spark wants more train rows than categories).
    """
    if name == "logistic_regression":
        raise ValueError("categorical columns need a tree profile")
    categorical = list(categorical)
    coded = [f"__index_{c}" for c in categorical]
    index = StringIndexer(inputCols=categorical, outputCols=coded, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    most = max((len(values) + 1 for values in index.labelsArray), default=0)
    pipe = build(name, [*features, *coded], **{"maxBins": max(32, most), **params})
    return Pipeline(stages=[index, *pipe.getStages()]).fit(prepare_xy(df, features, label, MODELS[name][1]))


def predict(model: PipelineModel, df: DataFrame, label: str | None = None, keep=()) -> DataFrame:
    """prediction (0/1, threshold .5) and p1 = P(class 1)."""
    out = model.transform(df)
    cols = list(keep) + ([F.col(label).alias("label")] if label else [])
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array(F.col("probability"))[1].alias("p1"))


def feature_importance(model: PipelineModel, features) -> list:
    """(feature, importance): |coefficient| for linear models, impurity importance for trees."""
    est = model.stages[-1]
    if hasattr(est, "coefficients"):
        vals = [abs(float(x)) for x in est.coefficients.toArray()]
    else:
        vals = [float(x) for x in est.featureImportances.toArray()]
    return sorted(zip(features, vals), key=lambda t: (-t[1], t[0]))


def importance_frame(spark, model: PipelineModel, features, top_k: int | None = None) -> DataFrame:
    rows = feature_importance(model, features)
    df = spark.createDataFrame(rows, "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top_k) if top_k else df


#: Rows that fits side by side may hold in memory together.
ROWS_AT_ONCE = 40_000_000


def fits_at_once(rows: int, most: int) -> int:
    """Fits on ``rows`` rows each that run side by side: up to ``most`` on few
    rows, which a fit alone cannot spread over all cores; on many, whose copies
    would not fit into memory together, one after another."""
    return max(1, min(most, ROWS_AT_ONCE // max(1, rows)))


def cross_validate(df: DataFrame, name: str, features, label: str, fold_col: str = "fold",
                   parallelism: int = 1, rebalance=None, **params) -> DataFrame:
    """Metrics per fold (fit on the other folds); a failing fold is skipped.

    Up to ``parallelism`` folds are fitted side by side, fewer on many rows.
    ``rebalance`` (frame -> frame) is applied to the other folds' rows alone,
    so that no held-out row has a part in a synthetic one; one fold at a time."""
    spark = df.sparkSession
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())
    rebalancing = threading.Lock()
    shared = None

    def run(f):
        try:
            with scratch_tables():  # the fold's rebalanced rows and scores
                others = df.filter(F.col(fold_col) != f)
                if rebalance:
                    with rebalancing, scratch_tables() as keep:
                        others = keep(saved(rebalance(others))) if name == "logistic_regression" else cut_lineage(rebalance(others))
                m = fit(others, name, features, label, **({"shared": (shared, f)} if shared else {}), **params)
                p = predict(m, df.filter(F.col(fold_col) == f), label)
                b = M.basic_metrics(p).first()
                a = M.roc_auc(p).first()
            return (int(f), b["accuracy"], b["precision"], b["recall"], b["f1"], a["roc_auc"], "ok", None)
        except Exception as e:  # noqa: BLE001 - fold isolation as in the reference
            return (int(f), None, None, None, None, None, "failed", str(e)[:500])

    with scratch_tables():
        if _newton(name, params) and not rebalance:
            with contextlib.suppress(Exception):  # then each fold finds out by itself
                shared = LG.blocks(df.filter(F.col(fold_col).isNotNull()), features, label, fold_col)
        if parallelism > 1:
            with ThreadPoolExecutor(fits_at_once(df.count(), parallelism)) as ex:
                rows = list(ex.map(run, folds))
        else:
            rows = [run(f) for f in folds]
    return spark.createDataFrame(rows, "fold int, accuracy double, precision double, recall double, "
                                       "f1 double, roc_auc double, status string, error string")


def cv_summary(cv: DataFrame, group=()) -> DataFrame:
    """mean and population std of each metric over the successful folds (of each ``group``)."""
    ok = cv.filter(F.col("status") == "ok")
    aggs = []
    for m in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        aggs += [F.avg(m).alias(f"cv_{m}_mean"), F.stddev_pop(m).alias(f"cv_{m}_std")]
    return ok.groupBy(*group).agg(F.count(F.lit(1)).alias("n_folds"), *aggs)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_many(train: DataFrame, test: DataFrame, names, features, label: str, fold_col: str = "fold",
               keep=(), cv: bool = True, params: dict | None = None, parallelism: int = 5):
    """Train each model (failures recorded, others go on); returns
    (predictions long over model/split, cv rows, status rows, models)."""
    if not names:
        raise ValueError("no models to train")
    unknown = [n for n in names if n not in MODELS]
    if unknown:
        raise ValueError(f"unknown models {unknown}; available: {', '.join(MODELS)}")
    spark = train.sparkSession
    preds, cvs, status, models = None, None, [], {}
    for n in names:
        t0 = time.time()
        try:
            kw = (params or {}).get(n, {})
            if cv:
                c = cross_validate(train, n, features, label, fold_col, parallelism, **kw).withColumn("model", F.lit(n))
                cvs = c if cvs is None else cvs.unionByName(c)
            m = fit(train, n, features, label, **kw)
            models[n] = m
            p = predict(m, train, label, keep).withColumn("split", F.lit("train")).unionByName(
                predict(m, test, label, keep).withColumn("split", F.lit("test"))).withColumn("model", F.lit(n))
            preds = p if preds is None else preds.unionByName(p)
            status.append((n, "ok", None, time.time() - t0))
        except Exception as e:  # noqa: BLE001
            status.append((n, "failed", str(e)[:500], time.time() - t0))
    st = spark.createDataFrame(status, "model string, status string, error string, seconds double")
    return preds, cvs, st, models


def train_test_summary(preds: DataFrame, cv: DataFrame | None = None) -> DataFrame:
    """One row per model: train/test accuracy, precision, recall, F1, CV mean ± std, test ROC-AUC."""
    m = M.basic_metrics(preds, ["model", "split"])
    wide = m.groupBy("model").pivot("split", ["train", "test"]).agg(
        *[F.first(x).alias(x) for x in ("accuracy", "precision", "recall", "f1")])
    auc = M.roc_auc(preds.filter(F.col("split") == "test"), ["model"])
    out = wide.join(auc, "model", "left")
    if cv is not None:
        ok = cv.filter(F.col("status") == "ok").groupBy("model").agg(
            F.format_string("%.3f ± %.3f", F.avg("accuracy"), F.stddev_pop("accuracy")).alias("cv_accuracy"),
            F.format_string("%.3f ± %.3f", F.avg("f1"), F.stddev_pop("f1")).alias("cv_f1"))
        out = out.join(ok, "model", "left")
    return out


def best_model(summary: DataFrame, metric: str = "test_f1") -> DataFrame:
    """Model with the highest metric; ties -> first name."""
    return summary.agg(F.min_by("model", F.struct(-F.col(metric), F.col("model"))).alias("best_model"),
                       F.max(metric).alias(metric))


def evaluate_models(train: DataFrame, test: DataFrame, models: dict, label: str, cv: DataFrame | None = None,
                    metric: str = "test_f1"):
    """Score each fitted model (name -> model) on train and test in a try of
    its own, the scoring done inside it, so that a model that fails there is
    recorded and the others stay.  Returns (summary, long form over model /
    split / metric with the CV means, best model, status rows); without a
    scored model the first three are None."""
    if not test.limit(1).count():
        raise ValueError("no test rows")
    spark, preds, status = test.sparkSession, None, []
    for n, m in models.items():
        try:
            p = predict(m, train, label).withColumn("split", F.lit("train")).unionByName(
                predict(m, test, label).withColumn("split", F.lit("test"))).withColumn("model", F.lit(n))
            p = cut_lineage(p)
            preds = p if preds is None else preds.unionByName(p)
            status.append((n, "ok", None))
        except Exception as e:  # noqa: BLE001
            status.append((n, "failed", str(e)[:500]))
    st = spark.createDataFrame(status, "model string, status string, error string")
    if preds is None:
        return None, None, None, st
    names = ["accuracy", "precision", "recall", "f1"]
    by_split = M.basic_metrics(preds, ["model", "split"]).select("model", "split", *names)
    auc = M.roc_auc(preds, ["model", "split"]).select("model", "split", "roc_auc")
    wide = [(by_split.join(auc, ["model", "split"], "left"), [*names, "roc_auc"])]
    if cv is not None:
        scored = spark.createDataFrame([(n,) for n, s, _ in status if s == "ok"], "model string")
        means = cv_summary(cv, ["model"]).join(scored, "model", "left_semi").withColumn("split", F.lit("cv"))
        wide.append((means, [c for c in means.columns if c.startswith("cv_")]))
    long = None
    for d, cols in wide:
        part = d.unpivot(["model", "split"], cols, "metric", "value")
        long = part if long is None else long.unionByName(part)
    summary = train_test_summary(preds, cv)
    return summary, long, best_model(summary, metric), st
