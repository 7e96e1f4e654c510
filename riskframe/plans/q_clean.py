"""Cleaning queries (§2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import round_all
from ..operators import clean
from ..sources.fixtures import KEY, patients_dirty
from ..sources.tables import table
from .catalog import register
from .oracle import select_rounded, with_views

REF9 = C.EXPECTED_COLUMNS
CONT = C.CONTINUOUS
DISCRETE = C.CATEGORICAL + [c for c in C.BINARY if c != C.TARGET]


def mode_sql(src, c):
    return (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)")


def impute_select(src):
    cols = []
    for c in KEY + REF9:
        if c in CONT:
            cols.append(f"COALESCE({c}, (SELECT QUANTILE_CONT({c}, 0.5) FROM {src})) AS {c}")
        elif c in DISCRETE:
            cols.append(f"COALESCE({c}, {mode_sql(src, c)}) AS {c}")
        else:
            cols.append(c)
    return ", ".join(cols)


IMPUTE_SQL = with_views(f"""
SELECT {select_rounded(KEY + REF9, set(CONT))} FROM (SELECT {impute_select('patients_dirty')} FROM patients_dirty)""",
                        "patients_dirty")


@register("impute", IMPUTE_SQL)
def q_impute(spark, sf):
    """Median for continuous, mode (smallest on ties) for categorical and binary."""
    d = patients_dirty(spark, sf)
    imp = clean.fit_impute(d, CONT, C.CATEGORICAL, [c for c in C.BINARY if c != C.TARGET])
    return round_all(imp.transform(d))


@register("dedup", with_views("SELECT DISTINCT * FROM patients_dirty", "patients_dirty"))
def q_dedup(spark, sf):
    return clean.dedup(patients_dirty(spark, sf))


def _z_sql(src, cols):
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, ROUND(m, 6) AS mean, ROUND(s, 6) AS std,
 COUNT(*) FILTER (WHERE ABS(CAST({c} AS DOUBLE) - m) / s > 3.0) AS n_outliers
FROM {src}, (SELECT AVG(CAST({c} AS DOUBLE)) AS m, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS s FROM {src}) st
GROUP BY m, s""" for c in cols)


@register("zscore_outliers", with_views(_z_sql("patients_dirty", CONT), "patients_dirty"))
def q_zscore(spark, sf):
    return round_all(clean.zscore_outliers(patients_dirty(spark, sf), CONT))


@register("zscore_outliers_events", _z_sql("events", ["value"]))
def q_zscore_events(spark, sf):
    return round_all(clean.zscore_outliers(table(spark, sf, "events"), ["value"]))


def winsor_sql(src, cols, passthrough, stats_src=None):
    stats_src = stats_src or src
    st = ", ".join(
        f"AVG(CAST({c} AS DOUBLE)) AS {c}_m, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS {c}_s, "
        f"MIN(CAST({c} AS DOUBLE)) AS {c}_lo, MAX(CAST({c} AS DOUBLE)) AS {c}_hi, "
        f"QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75) AS {c}_q3"
        for c in cols)
    sel = []
    for c in cols:
        lo = f"({c}_q1 - 1.5 * ({c}_q3 - {c}_q1))"
        hi = f"({c}_q3 + 1.5 * ({c}_q3 - {c}_q1))"
        sel.append(f"CASE WHEN {c} IS NULL THEN NULL WHEN {c}_s > 0 AND GREATEST({c}_hi - {c}_m, {c}_m - {c}_lo) / {c}_s > 3.0 "
                   f"THEN GREATEST(LEAST(CAST({c} AS DOUBLE), {hi}), {lo}) ELSE CAST({c} AS DOUBLE) END AS {c}")
    return f"SELECT {', '.join(passthrough + sel)} FROM {src}, (SELECT {st} FROM {stats_src}) st"


_PASS = KEY + [c for c in REF9 if c not in CONT]


@register("winsorize_iqr", with_views(
    f"SELECT {select_rounded(KEY + REF9, set(CONT))} FROM ({winsor_sql('patients_dirty', CONT, _PASS)})",
    "patients_dirty"))
def q_winsorize(spark, sf):
    d = patients_dirty(spark, sf)
    return round_all(clean.fit_winsorize(d, CONT).transform(d).select(*KEY, *REF9))


@register("winsorize_events", f"SELECT event_id, ROUND(value, 6) AS value FROM ({winsor_sql('events', ['value'], ['event_id'])})")
def q_winsorize_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return round_all(clean.fit_winsorize(e, ["value"], method="bounded").transform(e))


# -- the imputation fit itself (§2.4 impute_median / impute_mode) -------------
_MODE_COLS = [("orders", ["o_orderstatus", "o_orderpriority"]), ("events", ["event_type"])]


def _median_sql(src, c):
    return (f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"ROUND(QUANTILE_CONT({c}, 0.5), 6) AS median, CAST(NULL AS VARCHAR) AS mode FROM {src}")


def _mode_row_sql(src, c):
    return (f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"CAST(NULL AS DOUBLE) AS median, CAST({mode_sql(src, c)} AS VARCHAR) AS mode FROM {src}")


@register("impute_median", with_views("\nUNION ALL\n".join(
    [_median_sql("patients_dirty", c) for c in CONT] + [_median_sql("events", "value"),
                                                       _median_sql("orders", "o_totalprice")]), "patients_dirty"))
def q_impute_median(spark, sf):
    """Median fill value and missing count per continuous column; the high-cardinality
    events / orders columns use the bounded exact selection."""
    return round_all(clean.impute_stats(patients_dirty(spark, sf), CONT)
                     .unionByName(clean.impute_stats(table(spark, sf, "events"), ["value"], method="bounded"))
                     .unionByName(clean.impute_stats(table(spark, sf, "orders"), ["o_totalprice"], method="bounded")))


@register("impute_mode", with_views("\nUNION ALL\n".join(
    [_mode_row_sql("patients_dirty", c) for c in DISCRETE]
    + [_mode_row_sql(t, c) for t, cols in _MODE_COLS for c in cols]), "patients_dirty"))
def q_impute_mode(spark, sf):
    """Most frequent value (smallest on ties) and missing count per categorical / binary column."""
    out = clean.impute_stats(patients_dirty(spark, sf), (), C.CATEGORICAL, [c for c in C.BINARY if c != C.TARGET])
    for t, cols in _MODE_COLS:
        out = out.unionByName(clean.impute_stats(table(spark, sf, t), (), cols))
    return out
