"""Evaluation (§2.9): confusion counts, metrics, ROC / PR measures, sweeps.

Predictions are one long DataFrame ``(group..., label, prediction, score)``;
every metric is grouped by the ``group`` columns (model, split, fold ...),
so many models are scored in one pass.

Cumulative curves never use a window over all rows: scores are first
collapsed to distinct values per group; when those are many they are cut
into quantile buckets, bucket totals give offsets (a result-sized window),
and the running sums run inside (group, bucket) partitions only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from ..functions.exprs import safe_div


def _g(group):
    return list(group or [])


def confusion_counts(preds: DataFrame, group=None, label="label", prediction="prediction") -> DataFrame:
    """tp, fp, fn, tn per group (one aggregate)."""
    y, p = F.col(label), F.col(prediction)
    aggs = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn")]
    g = _g(group)
    return preds.groupBy(*g).agg(*aggs) if g else preds.agg(*aggs)


def confusion_matrix(preds: DataFrame, group=None, label="label", prediction="prediction") -> DataFrame:
    """Long 2x2 form (group..., label, prediction, n, share-of-row), zeros included."""
    c = confusion_counts(preds, group, label, prediction)
    cells = [(1, 1, "tp", "fn"), (0, 1, "fp", "tn"), (1, 0, "fn", "tp"), (0, 0, "tn", "fp")]
    structs = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(k).alias("n"),
                        safe_div(F.col(k), F.col(k) + F.col(o)).alias("share")) for a, b, k, o in cells]
    return c.select(*_g(group), F.inline(F.array(*structs)))


def _from_counts(tp, fp, fn, tn):
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    return {
        "accuracy": safe_div(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": safe_div(2 * tp, 2 * tp + fp + fn),
    }


def basic_metrics(preds: DataFrame, group=None, label="label", prediction="prediction") -> DataFrame:
    """accuracy, precision, recall, F1 of class 1 (0 where undefined)."""
    c = confusion_counts(preds, group, label, prediction)
    m = _from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return c.select(*_g(group), *[v.alias(k) for k, v in m.items()])


def classification_report(preds: DataFrame, group=None, class_names=("0", "1"),
                          label="label", prediction="prediction") -> DataFrame:
    """precision / recall / f1 / support per class, plus accuracy, macro and weighted averages."""
    c = confusion_counts(preds, group, label, prediction)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    # class 1 is positive; class 0 swaps the roles
    p1, r1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    p0, r0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp)
    f1_1, f1_0 = safe_div(2 * tp, 2 * tp + fp + fn), safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = safe_div(tp + tn, n)
    rows = [
        (class_names[0], p0, r0, f1_0, s0),
        (class_names[1], p1, r1, f1_1, s1),
        ("accuracy", acc, acc, acc, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        ("weighted avg", safe_div(p0 * s0 + p1 * s1, n), safe_div(r0 * s0 + r1 * s1, n),
         safe_div(f1_0 * s0 + f1_1 * s1, n), n),
    ]
    structs = [F.struct(F.lit(k).alias("class"), p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                        f.cast("double").alias("f1"), s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return c.select(*_g(group), F.inline(F.array(*structs)))


def score_curve(preds: DataFrame, group=None, label="label", score="p1",
                rows_per_bucket: int = 500_000) -> DataFrame:
    """Distinct scores per group with running counts at ``score >= s``.

    Columns: group..., score, pos, neg, tp, fp, P, N.  Scores are cut into
    quantile buckets; bucket totals give offsets, so every running sum stays
    inside one (group, bucket) partition whatever the number of scores.  The
    distinct scores are written, not cached: nothing stays in memory.
    """
    g = _g(group)
    dist = saved(preds.groupBy(*g, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg")))
    n_buckets = max(2, -(-dist.count() // rows_per_bucket))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = dist.agg(F.percentile_approx("score", probs, max(10_000, 10 * n_buckets)).alias("q")).first()["q"]
    splits = [float("-inf")] + sorted(set(float(x) for x in qs or [0.0])) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(dist)
    b = b.withColumn("bucket", F.col("bucket").cast("int"))
    tots = b.groupBy(*g, "bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    above = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(F.desc("bucket")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    allw = Window.partitionBy(*g) if g else Window.partitionBy()
    offs = tots.select(*g, "bucket",
                       F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("op"),
                       F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("on"),
                       F.sum("bp").over(allw).alias("P"), F.sum("bn").over(allw).alias("N"))
    j = b.join(offs, [*g, "bucket"])
    inb = Window.partitionBy(*g, "bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(*g, "score", "pos", "neg",
                    (F.col("op") + F.sum("pos").over(inb)).alias("tp"),
                    (F.col("on") + F.sum("neg").over(inb)).alias("fp"), "P", "N")


def _roc_area():
    num = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") * 0.5))
    den = F.first("P").cast("double") * F.first("N").cast("double")
    return (num / F.nullif(den, F.lit(0.0))).alias("roc_auc")


def _pr_area():
    return (F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
            / F.nullif(F.first("P").cast("double"), F.lit(0.0))).alias("average_precision")


def curve_areas(preds: DataFrame, group=None, label="label", score="p1", **kw) -> DataFrame:
    """Both areas, roc_auc and average_precision, from one curve."""
    return score_curve(preds, group, label, score, **kw).groupBy(*_g(group)).agg(_roc_area(), _pr_area())


def roc_auc(preds: DataFrame, group=None, label="label", score="p1", **kw) -> DataFrame:
    """Area under ROC with ties counted one half (null when a class is absent)."""
    return score_curve(preds, group, label, score, **kw).groupBy(*_g(group)).agg(_roc_area())


def average_precision(preds: DataFrame, group=None, label="label", score="p1", **kw) -> DataFrame:
    """Step-wise sum of (R_n - R_{n-1}) * P_n over descending thresholds."""
    return score_curve(preds, group, label, score, **kw).groupBy(*_g(group)).agg(_pr_area())


def pr_curve(preds: DataFrame, group=None, label="label", score="p1", **kw) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus (1, 0)."""
    c = score_curve(preds, group, label, score, **kw)
    g = _g(group)
    pts = c.select(
        *g, F.col("score").alias("threshold"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), F.col("P")).alias("recall"))
    ends = (preds.select(*g).distinct() if g else preds.sparkSession.range(1).select()).select(
        *g, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(ends)


def threshold_sweep(preds: DataFrame, thresholds, group=None, label="label", score="p1") -> DataFrame:
    """accuracy / precision / recall / F1 for ``score >= t`` at each threshold (one aggregate)."""
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        p = s >= F.lit(float(t))
        aggs += [F.count_if((y == 1) & p).alias(f"tp{i}"), F.count_if((y == 0) & p).alias(f"fp{i}"),
                 F.count_if((y == 1) & ~p).alias(f"fn{i}"), F.count_if((y == 0) & ~p).alias(f"tn{i}")]
    g = _g(group)
    c = preds.groupBy(*g).agg(*aggs) if g else preds.agg(*aggs)
    structs = []
    for i, t in enumerate(thresholds):
        m = _from_counts(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}"), F.col(f"tn{i}"))
        structs.append(F.struct(F.lit(float(t)).alias("threshold"), *[v.alias(k) for k, v in m.items()]))
    return c.select(*g, F.inline(F.array(*structs)))


def summary_table(preds: DataFrame, group=("model",), label="label", prediction="prediction",
                  score="p1") -> DataFrame:
    """One row per group: accuracy, precision, recall, F1, ROC-AUC."""
    m = basic_metrics(preds, group, label, prediction)
    a = roc_auc(preds, group, label, score)
    return m.join(a, list(group), "left")


def per_class_table(preds: DataFrame, metrics=("precision", "recall", "f1"), group=("model",), class_names=("0", "1"),
                    label="label", prediction="prediction") -> DataFrame:
    """group x metric x class table of the report's metrics."""
    r = classification_report(preds, group, class_names, label, prediction)
    long = r.filter(F.col("class").isin(*class_names)).select(*group, "class", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))
    return long.groupBy(*group, "metric").pivot("class", list(class_names)).agg(F.first("value"))


def weighted_objective(fold_metrics: DataFrame, group=(), w_recall: float = 0.7,
                       w_accuracy: float = 0.3) -> DataFrame:
    """w_r * mean(recall) + w_a * mean(accuracy); weights normalised to sum 1."""
    tot = w_recall + w_accuracy
    wr, wa = w_recall / tot, w_accuracy / tot
    e = (F.lit(wr) * F.avg("recall") + F.lit(wa) * F.avg("accuracy")).alias("objective")
    g = list(group)
    return fold_metrics.groupBy(*g).agg(e) if g else fold_metrics.agg(e)
