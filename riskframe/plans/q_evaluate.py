"""Evaluation queries (§2.9) on the ``scored`` view (two score columns as models)."""

from __future__ import annotations

from .. import config as C
from ..functions.exprs import round_all
from ..operators import metrics as M
from ..sources.fixtures import scored
from .catalog import register
from .oracle import with_views

G = ["model"]
CNT = """cnt AS (SELECT model,
 COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
 COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn
 FROM scored GROUP BY model)"""
CUR = """dist AS (SELECT model, p1 AS score, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY model, p1),
cur AS (SELECT *,
 SUM(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
 SUM(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
 SUM(pos) OVER (PARTITION BY model) AS P, SUM(neg) OVER (PARTITION BY model) AS N FROM dist)"""


def _sql(body, *ctes):
    s = with_views("SELECT 1", "scored")
    head = s[:s.rindex("\nSELECT 1")]
    return head + ",\n" + ",\n".join(ctes) + "\n" + body


def _div(a, b):
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


METRICS_SEL = (f"ROUND({_div('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, ROUND({_div('tp', 'tp + fp')}, 6) AS precision, "
               f"ROUND({_div('tp', 'tp + fn')}, 6) AS recall, ROUND({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1")


@register("confusion_matrix", _sql(f"""
SELECT model, label, prediction, n, ROUND({_div('n', 'rowsum')}, 6) AS share FROM (
 SELECT model, label, prediction, COUNT(*) FILTER (WHERE s.label = l AND s.prediction = p) AS n,
  SUM(COUNT(*) FILTER (WHERE s.label = l AND s.prediction = p)) OVER (PARTITION BY model, label) AS rowsum
 FROM scored s, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(l, p)
 GROUP BY model, l, p) t(model, label, prediction, n, rowsum)""".replace(
    "SELECT model, label, prediction, COUNT", "SELECT model, l, p, COUNT").replace(
    "OVER (PARTITION BY model, label)", "OVER (PARTITION BY model, l)")))
def q_confusion(spark, sf):
    return round_all(M.confusion_matrix(scored(spark, sf), G))


@register("basic_metrics", _sql(f"SELECT model, {METRICS_SEL} FROM cnt", CNT))
def q_basic(spark, sf):
    return round_all(M.basic_metrics(scored(spark, sf), G))


def _report_sql():
    p1, r1, f1 = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = _div("tn", "tn + fn"), _div("tn", "tn + fp"), _div("2 * tn", "2 * tn + fn + fp")
    acc = _div("tp + tn", "tp + fp + fn + tn")
    n = "(tp + fp + fn + tn)"
    rows = [
        (f"'{C.CLASS_NAMES[0]}'", p0, r0, f0, "tn + fp"),
        (f"'{C.CLASS_NAMES[1]}'", p1, r1, f1, "tp + fn"),
        ("'accuracy'", acc, acc, acc, n),
        ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", n),
        ("'weighted avg'", _div(f"{p0} * (tn + fp) + {p1} * (tp + fn)", n),
         _div(f"{r0} * (tn + fp) + {r1} * (tp + fn)", n), _div(f"{f0} * (tn + fp) + {f1} * (tp + fn)", n), n),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT model, {k} AS class, ROUND({p}, 6) AS precision, ROUND({r}, 6) AS recall, ROUND({f}, 6) AS f1, "
        f"CAST({s} AS BIGINT) AS support FROM cnt" for k, p, r, f, s in rows)


@register("classification_report", _sql(_report_sql(), CNT))
def q_report(spark, sf):
    return round_all(M.classification_report(scored(spark, sf), G, C.CLASS_NAMES))


ROC_SQL = _sql("""SELECT model, ROUND(SUM(neg * (tp - pos + pos * 0.5)) / (CAST(P AS DOUBLE) * CAST(N AS DOUBLE)), 6) AS roc_auc
FROM cur GROUP BY model, P, N""", CUR)


@register("roc_auc", ROC_SQL)
def q_roc(spark, sf):
    return round_all(M.roc_auc(scored(spark, sf), G))


@register("roc_auc_bucketed", ROC_SQL)
def q_roc_bucketed(spark, sf):
    """The same curve cut into many buckets; equal areas."""
    return round_all(M.roc_auc(scored(spark, sf), G, rows_per_bucket=50))


AP_SQL = _sql("""SELECT model, ROUND(SUM(pos * CAST(tp AS DOUBLE) / (tp + fp)) / CAST(P AS DOUBLE), 6) AS average_precision
FROM cur GROUP BY model, P""", CUR)


@register("average_precision", AP_SQL)
def q_ap(spark, sf):
    return round_all(M.average_precision(scored(spark, sf), G))


@register("average_precision_bucketed", AP_SQL)
def q_ap_bucketed(spark, sf):
    return round_all(M.average_precision(scored(spark, sf), G, rows_per_bucket=50))


@register("pr_curve", _sql(f"""
SELECT model, ROUND(score, 6) AS threshold, ROUND({_div('tp', 'tp + fp')}, 6) AS precision,
 ROUND({_div('tp', 'P')}, 6) AS recall FROM cur
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0E0, 0.0E0 FROM scored""", CUR))
def q_pr(spark, sf):
    return round_all(M.pr_curve(scored(spark, sf), G))


def _sweep_sql():
    parts = []
    for t in C.DEFAULT_THRESHOLDS:
        parts.append(f"""SELECT model, {t}E0 AS threshold, {METRICS_SEL} FROM (SELECT model,
 COUNT(*) FILTER (WHERE label = 1 AND p1 >= {t}E0) AS tp, COUNT(*) FILTER (WHERE label = 0 AND p1 >= {t}E0) AS fp,
 COUNT(*) FILTER (WHERE label = 1 AND p1 < {t}E0) AS fn, COUNT(*) FILTER (WHERE label = 0 AND p1 < {t}E0) AS tn
 FROM scored GROUP BY model)""")
    return _sql("\nUNION ALL\n".join(parts))


@register("threshold_sweep", _sweep_sql())
def q_sweep(spark, sf):
    return round_all(M.threshold_sweep(scored(spark, sf), C.DEFAULT_THRESHOLDS, G))


@register("summary_table", _sql(f"""
SELECT c.model, {METRICS_SEL}, r.roc_auc FROM cnt c JOIN (
 SELECT model, ROUND(SUM(neg * (tp - pos + pos * 0.5)) / (CAST(P AS DOUBLE) * CAST(N AS DOUBLE)), 6) AS roc_auc
 FROM cur GROUP BY model, P, N) r ON c.model = r.model""", CNT, CUR))
def q_summary(spark, sf):
    return round_all(M.summary_table(scored(spark, sf)))


@register("compare_models", _sql(f"""
SELECT c.model, {METRICS_SEL}, r.roc_auc, r.average_precision FROM cnt c JOIN (
 SELECT model, ROUND(SUM(neg * (tp - pos + pos * 0.5)) / (CAST(P AS DOUBLE) * CAST(N AS DOUBLE)), 6) AS roc_auc,
  ROUND(SUM(pos * CAST(tp AS DOUBLE) / (tp + fp)) / CAST(P AS DOUBLE), 6) AS average_precision
 FROM cur GROUP BY model, P, N) r ON c.model = r.model""", CNT, CUR))
def q_compare(spark, sf):
    s = scored(spark, sf)
    out = M.basic_metrics(s, G).join(M.curve_areas(s, G), G)
    return round_all(out)


@register("per_class_table", _sql(f"""
SELECT model, 'precision' AS metric, ROUND({_div('tn', 'tn + fn')}, 6) AS "{C.CLASS_NAMES[0]}", ROUND({_div('tp', 'tp + fp')}, 6) AS "{C.CLASS_NAMES[1]}" FROM cnt
UNION ALL SELECT model, 'recall', ROUND({_div('tn', 'tn + fp')}, 6), ROUND({_div('tp', 'tp + fn')}, 6) FROM cnt
UNION ALL SELECT model, 'f1', ROUND({_div('2 * tn', '2 * tn + fn + fp')}, 6), ROUND({_div('2 * tp', '2 * tp + fp + fn')}, 6) FROM cnt""", CNT))
def q_per_class(spark, sf):
    return round_all(M.per_class_table(scored(spark, sf), group=G, class_names=C.CLASS_NAMES))


@register("weighted_objective", _sql(f"""
SELECT model, ROUND(0.7 * recall + 0.3 * accuracy, 6) AS objective FROM (
 SELECT model, {_div('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_div('tp', 'tp + fn')} AS recall FROM cnt)""", CNT))
def q_objective(spark, sf):
    """Tuning objective .7 recall + .3 accuracy (normalised weights) per scored model."""
    m = M.basic_metrics(scored(spark, sf), G)
    return round_all(M.weighted_objective(m, G, C.OBJECTIVE_WEIGHTS["recall"], C.OBJECTIVE_WEIGHTS["accuracy"]))
