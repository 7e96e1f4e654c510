"""Profiling queries (§2.3) on the patient views and the second bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import round_all
from ..operators import profile as P
from ..sources.fixtures import KEY, patients, patients_dirty
from ..sources.tables import table
from .catalog import register
from .oracle import with_views

CONT = C.CONTINUOUS
REF9 = C.EXPECTED_COLUMNS


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# -- overview / head ----------------------------------------------------------
@register("overview", with_views("SELECT COUNT(*) AS n_rows, 12 AS n_features FROM patients", "patients"))
def q_overview(spark, sf):
    return P.overview(patients(spark, sf), target="diabetes")


@register("head", with_views(
    f"SELECT * FROM patients ORDER BY {', '.join(KEY)} LIMIT 5", "patients"))
def q_head(spark, sf):
    return P.head(patients(spark, sf), 5, order_by=KEY)


# -- column info / describe / nulls / duplicates ------------------------------
_DIRTY_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
                "l_linenumber": "int", "gender": "string", "age": "double", "hypertension": "int",
                "heart_disease": "int", "smoking_history": "string", "bmi": "double",
                "HbA1c_level": "double", "blood_glucose_level": "double", "diabetes": "int"}
COLUMN_INFO_SQL = with_views(_union([
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, COUNT({c}) AS non_null FROM patients_dirty"
    for c, t in _DIRTY_TYPES.items()]), "patients_dirty")


@register("column_info", COLUMN_INFO_SQL)
def q_column_info(spark, sf):
    return P.column_info(patients_dirty(spark, sf))


def _describe_sql(src, cols):
    return _union([
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, "
        f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, "
        f"ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS q50, "
        f"ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q75, ROUND(MAX({c}), 6) AS max FROM {src}"
        for c in cols])


@register("describe", with_views(_describe_sql("patients_dirty", CONT), "patients_dirty"))
def q_describe(spark, sf):
    return round_all(P.describe(patients_dirty(spark, sf), CONT))


@register("describe_events", _describe_sql("events", ["value"]))
def q_describe_events(spark, sf):
    return round_all(P.describe(table(spark, sf, "events"), ["value"], method="bounded"))


NULLS_SQL = with_views(f"""
SELECT * FROM ({_union([
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*), 6) AS share FROM patients_dirty"
    for c in REF9])}) WHERE n_missing > 0""", "patients_dirty")


@register("null_counts", NULLS_SQL)
def q_null_counts(spark, sf):
    return round_all(P.null_counts(patients_dirty(spark, sf), REF9))


DUP_SQL = with_views(f"""
SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(SUM(c-1) AS BIGINT) AS n_duplicates, ROUND(SUM(c-1)/SUM(c), 6) AS share
FROM (SELECT COUNT(*) AS c FROM patients_dirty GROUP BY {', '.join(REF9)})""", "patients_dirty")


@register("duplicate_count", DUP_SQL)
def q_duplicate_count(spark, sf):
    return round_all(P.duplicate_count(patients_dirty(spark, sf), REF9))


# -- value counts / class balance --------------------------------------------
def _vc_sql(src, cols):
    return _union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n "
                   f"FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols])


_VC_COLS = ["gender", "smoking_history", "hypertension", "heart_disease", "diabetes"]


@register("value_counts", with_views(_vc_sql("patients_dirty", _VC_COLS), "patients_dirty"))
def q_value_counts(spark, sf):
    return P.value_counts(patients_dirty(spark, sf), _VC_COLS)


@register("value_counts_orders", _vc_sql("orders", ["o_orderstatus", "o_orderpriority"]))
def q_value_counts_orders(spark, sf):
    return P.value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("class_share", with_views("""
SELECT diabetes, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share
FROM patients GROUP BY diabetes""", "patients"))
def q_class_share(spark, sf):
    return round_all(P.class_share(patients(spark, sf), "diabetes"))


_IMB_SQL = """
SELECT {t}, n, ROUND(n / SUM(n) OVER (), 6) AS share,
 ROUND(CAST(MAX(n) OVER () AS DOUBLE) / MIN(n) OVER (), 6) AS imbalance_ratio,
 CASE {t} WHEN 0 THEN '{a}' WHEN 1 THEN '{b}' END AS class_name
FROM (SELECT {t}, COUNT(*) AS n FROM {src} GROUP BY {t})"""


@register("class_imbalance", with_views(_IMB_SQL.format(
    t="diabetes", src="patients", a=C.CLASS_NAMES[0], b=C.CLASS_NAMES[1]), "patients"))
def q_class_imbalance(spark, sf):
    return round_all(P.class_imbalance(patients(spark, sf), "diabetes", C.CLASS_NAMES))


def _labelled_docs(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")


@register("class_imbalance_labels", _IMB_SQL.format(
    t="quality", src="(SELECT l.* FROM labels l JOIN documents d ON l.doc_id = d.doc_id)",
    a="low", b="high"))
def q_class_imbalance_labels(spark, sf):
    return round_all(P.class_imbalance(_labelled_docs(spark, sf), "quality", ["low", "high"]))


# -- distributions -------------------------------------------------------------
def _hist_sql(src, cols):
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, g.bin, ROUND(g.lo + g.bin * ((g.hi - g.lo) / g.k), 6) AS bin_lo,
 ROUND(g.lo + (g.bin + 1) * ((g.hi - g.lo) / g.k), 6) AS bin_hi, COUNT(x) AS n
FROM (SELECT lo, hi, k, CAST(UNNEST(range(k)) AS INTEGER) AS bin FROM
 (SELECT lo, hi, CASE WHEN hi = lo THEN 1 ELSE GREATEST(1, CAST(CEIL((hi - lo) / (
      CASE WHEN 2.0 * (q3 - q1) * POWER(n, -1.0 / 3.0) > 0
           THEN LEAST(2.0 * (q3 - q1) * POWER(n, -1.0 / 3.0), (hi - lo) / (LOG2(n) + 1.0))
           ELSE (hi - lo) / (LOG2(n) + 1.0) END)) AS INTEGER)) END AS k
  FROM (SELECT COUNT({c}) AS n, MIN(CAST({c} AS DOUBLE)) AS lo, MAX(CAST({c} AS DOUBLE)) AS hi,
        QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.75) AS q3 FROM {src})) s) g
LEFT JOIN (SELECT CAST({c} AS DOUBLE) AS x FROM {src} WHERE {c} IS NOT NULL) v
 ON g.bin = CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((x - lo) * k / (hi - lo)), k - 1) END AS INTEGER)
GROUP BY g.bin, g.lo, g.hi, g.k""")
    return _union(parts)


@register("histogram", with_views(_hist_sql("patients_dirty", CONT), "patients_dirty"))
def q_histogram(spark, sf):
    return round_all(P.histogram(patients_dirty(spark, sf), CONT))


@register("histogram_events", _hist_sql("events", ["value"]))
def q_histogram_events(spark, sf):
    return round_all(P.histogram(table(spark, sf, "events"), ["value"], method="bounded"))


KDE_SQL = with_views("""
SELECT CAST(i AS INTEGER) AS idx, ROUND(g0 + i * step, 6) AS grid,
 ROUND(SUM(w * EXP(-0.5 * POWER((g0 + i * step - x) / h, 2))) * (1.0 / (n * h * SQRT(2.0 * PI()))), 6) AS density
FROM (SELECT bmi AS x, COUNT(*) AS w FROM patients_dirty WHERE bmi IS NOT NULL GROUP BY bmi) p,
 (SELECT n, h, lo - 3.0 * h AS g0, ((hi + 3.0 * h) - (lo - 3.0 * h)) / 199 AS step
  FROM (SELECT COUNT(bmi) AS n, STDDEV_SAMP(bmi) * POWER(COUNT(bmi), -1.0 / 5.0) AS h,
               MIN(bmi) AS lo, MAX(bmi) AS hi FROM patients_dirty)) g,
 range(200) r(i)
GROUP BY i, g0, step, n, h""", "patients_dirty")


@register("kde_curve", KDE_SQL)
def q_kde(spark, sf):
    return round_all(P.kde_curve(patients_dirty(spark, sf), "bmi"))


def _box_sql(src, cols):
    return _union([f"""
SELECT '{c}' AS column_name, ROUND(q1, 6) AS q1, ROUND(q2, 6) AS median, ROUND(q3, 6) AS q3,
 ROUND(MIN(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_lo,
 ROUND(MAX(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_hi,
 COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {src}) v,
 (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS q2, QUANTILE_CONT({c}, 0.75) AS q3 FROM {src}) q
GROUP BY q1, q2, q3""" for c in cols])


@register("box_stats", with_views(_box_sql("patients_dirty", CONT), "patients_dirty"))
def q_box(spark, sf):
    return round_all(P.box_stats(patients_dirty(spark, sf), CONT))


@register("box_stats_events", _box_sql("events", ["value"]))
def q_box_events(spark, sf):
    return round_all(P.box_stats(table(spark, sf, "events"), ["value"], method="bounded"))


def _outlier_sql(src, cols):
    return _union([f"""
SELECT '{c}' AS column_name, ROUND(x, 6) AS value, COUNT(*) AS n FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {src}) v,
 (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.75) AS q3 FROM {src}) q
WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) GROUP BY x""" for c in cols])


@register("box_outliers", with_views(_outlier_sql("patients_dirty", CONT), "patients_dirty"))
def q_box_outliers(spark, sf):
    return round_all(P.box_outliers(patients_dirty(spark, sf), CONT))


@register("box_outliers_events", _outlier_sql("events", ["value"]))
def q_box_outliers_events(spark, sf):
    return round_all(P.box_outliers(table(spark, sf, "events"), ["value"]))


# -- correlations --------------------------------------------------------------
def _corr_sql(src, cols, strings):
    codes = {c: f"c_{c}" for c in strings}
    ctes = [f"""c_{c} AS (SELECT v, DENSE_RANK() OVER (ORDER BY v) - 1 AS code
 FROM (SELECT DISTINCT {c} AS v FROM {src} WHERE {c} IS NOT NULL))""" for c in strings]
    sel = ", ".join(f"COALESCE(c_{c}.code, -1) AS {c}" if c in codes else f"CAST(t.{c} AS DOUBLE) AS {c}"
                    for c in cols)
    joins = " ".join(f"LEFT JOIN c_{c} ON t.{c} = c_{c}.v" for c in strings)
    ctes.append(f"coded AS (SELECT {sel} FROM {src} t {joins})")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    body = _union([f"SELECT '{a}' AS col_i, '{b}' AS col_j, ROUND(CORR({a}, {b}), 6) AS r FROM coded\n"
                   f"UNION ALL SELECT '{b}', '{a}', ROUND(CORR({a}, {b}), 6) FROM coded"
                   for a, b in pairs])
    return ctes, body


def _with_ctes(ctes, body, *views):
    sql = with_views(body, *views)
    head = ",\n".join(ctes)
    if sql.startswith("WITH "):
        i = sql.rindex("\n", 0, sql.index(body))
        return sql[:i] + ",\n" + head + sql[i:]
    return "WITH " + head + "\n" + body


_ctes, _body = _corr_sql("patients_dirty", REF9, ["gender", "smoking_history"])


@register("corr_matrix", _with_ctes(_ctes, _body, "patients_dirty"))
def q_corr(spark, sf):
    return round_all(P.corr_matrix(patients_dirty(spark, sf).select(*REF9), REF9))


_LCOLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ctes2, _body2 = _corr_sql("lineitem", _LCOLS, [])


@register("corr_lineitem", "WITH " + ",\n".join(_ctes2) + "\n" + _body2)
def q_corr_lineitem(spark, sf):
    return round_all(P.corr_matrix(table(spark, sf, "lineitem"), _LCOLS))


_TC = [c for c in REF9 if c not in ("diabetes", "gender", "smoking_history")]


@register("target_corr", with_views(_union([
    f"SELECT '{c}' AS feature, ROUND(CORR(CAST({c} AS DOUBLE), CAST(diabetes AS DOUBLE)), 6) AS r FROM patients_dirty"
    for c in _TC]), "patients_dirty"))
def q_target_corr(spark, sf):
    return round_all(P.target_corr(patients_dirty(spark, sf), _TC, "diabetes"))
