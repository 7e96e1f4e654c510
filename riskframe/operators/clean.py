"""Cleaning (§2.4): imputation, de-duplication, z-score outliers, IQR capping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted
from .profile import quantiles


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Spark separates NaN from NULL; the reference's NaN is missing -> NULL."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast("double")) for c in cols}) if cols else df


@dataclass
class Imputer(Fitted):
    """Continuous nulls -> median, categorical/binary nulls -> mode (smallest on ties)."""

    def transform(self, df: DataFrame) -> DataFrame:
        fills = self.params.get("fills", {})
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in fills.items()}) if fills else df


def _modes(df: DataFrame, cols) -> dict:
    """Most frequent value per column as text, the smallest on ties: a grouped
    count per column (partial on the map side), then one best row each."""
    best = None
    for c in cols:
        counts = df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        one = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].cast("string").alias("v")).select(
            F.lit(c).alias("c"), "v")
        best = one if best is None else best.unionByName(one)
    return {r["c"]: r["v"] for r in best.collect()} if best is not None else {}  # one row per column


def impute_stats(df: DataFrame, continuous=(), categorical=(), binary=(),
                 relative_error: float | None = None, method: str = "bounded") -> DataFrame:
    """The imputation fit as a frame, one aggregate over the table:
    ``(column_name, n_missing, median, mode)`` - the median for continuous
    columns, the most frequent value (smallest on ties, as text) for
    categorical and binary ones.  ``method='bounded'`` takes the medians
    from ``exact_quantiles`` (memory independent of the distinct values)."""
    from .profile import exact_quantiles
    meds = exact_quantiles(df, list(continuous), [0.5]) if method == "bounded" and continuous else {}
    modes = _modes(df, [*categorical, *binary])
    aggs, rows = [], []
    for c in continuous:
        med = (F.lit(meds[c][0] if meds[c] else None).cast("double") if method == "bounded"
               else quantiles(F.col(f"`{c}`"), [0.5], relative_error)[0].cast("double"))
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__nulls"), med.alias(f"{c}__fill")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}__nulls`").alias("n_missing"),
                             F.col(f"`{c}__fill`").alias("median"), F.lit(None).cast("string").alias("mode")))
    for c in [*categorical, *binary]:
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__nulls"),
                 F.lit(modes.get(c)).cast("string").alias(f"{c}__fill")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}__nulls`").alias("n_missing"),
                             F.lit(None).cast("double").alias("median"), F.col(f"`{c}__fill`").alias("mode")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def fit_impute(df: DataFrame, continuous=(), categorical=(), binary=(),
               relative_error: float | None = None, method: str = "bounded") -> Imputer:
    """One aggregate: null count, median or mode per column.  Columns without
    nulls are left out of the transform (the reference's skip rule)."""
    if not [*continuous, *categorical, *binary]:
        return Imputer("impute", {"fills": {}})
    types = dict(df.dtypes)
    fills = {}
    for r in impute_stats(df, continuous, categorical, binary, relative_error, method).collect():  # one row per column
        c = r["column_name"]
        v = r["median"] if c in continuous else r["mode"]
        if r["n_missing"] and v is not None:
            if c in continuous:
                fills[c] = float(v)
            elif types[c] in ("int", "bigint", "smallint", "tinyint"):
                fills[c] = int(v)
            elif types[c] in ("double", "float"):
                fills[c] = float(v)
            else:
                fills[c] = v
    return Imputer("impute", {"fills": fills})


def dedup(df: DataFrame, cols=None) -> DataFrame:
    """Drop identical rows (hash aggregate with map-side combine; a hot
    duplicate group collapses inside each map task before the shuffle)."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def _moments(df: DataFrame, cols, with_quartiles: bool = True):
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if with_quartiles:
            aggs.append(F.percentile(x, [0.25, 0.75]).alias(f"{c}__q"))
    return df.agg(*aggs).first()


def zscore_outliers(df: DataFrame, cols, threshold: float = 3.0) -> DataFrame:
    """(column_name, mean, std, n_outliers) with |x - mean| / std > threshold.

    Pass 1 fits mean/std (one aggregate, result-sized); pass 2 counts with
    the fitted numbers as literals.  A constant column (std 0) has none."""
    st = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"{c}__mean") for c in cols],
                *[F.stddev_samp(F.col(f"`{c}`").cast("double")).alias(f"{c}__std") for c in cols]).first()
    counts = []
    for c in cols:
        mean, std = st[f"{c}__mean"], st[f"{c}__std"]
        if mean is None or not std:
            n = F.lit(0).cast("long")
        else:
            z = F.abs(F.col(f"`{c}`").cast("double") - F.lit(mean)) / F.lit(std)
            n = F.count_if(z > F.lit(threshold))
        counts.append(n.alias(f"{c}__n"))
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(st[f"{c}__mean"]).cast("double").alias("mean"),
                        F.lit(st[f"{c}__std"]).cast("double").alias("std"), F.col(f"`{c}__n`").alias("n_outliers"))
               for c in cols]
    return df.agg(*counts).select(F.inline(F.array(*structs)))


@dataclass
class Winsorizer(Fitted):
    """Clip columns to fitted [lo, hi]; nulls stay null."""

    def transform(self, df: DataFrame) -> DataFrame:
        b = self.params.get("bounds", {})
        return df.withColumns({c: F.when(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")).otherwise(
            F.greatest(F.least(F.col(f"`{c}`").cast("double"), F.lit(hi)), F.lit(lo)))
            for c, (lo, hi) in b.items()}) if b else df


def fit_winsorize(df: DataFrame, cols, threshold: float = 3.0, factor: float = 1.5,
                  method: str = "bounded") -> Winsorizer:
    """Cap a column to [Q1 - 1.5 IQR, Q3 + 1.5 IQR] only when its z-test finds an
    outlier.  ``max |x - mean| / std > t`` equals "some z > t", so one
    aggregate decides the trigger and the bounds together.

    ``method='bounded'``: the aggregate decides the trigger only, and the
    quartiles of the triggered columns come from ``exact_quantiles`` (same
    values, memory independent of the number of distinct values)."""
    from .profile import exact_quantiles
    bounded = method == "bounded"
    r = _moments(df, cols, with_quartiles=not bounded)
    capped = []
    for c in cols:
        mean, std, lo, hi = r[f"{c}__mean"], r[f"{c}__std"], r[f"{c}__min"], r[f"{c}__max"]
        if mean is not None and std and max(hi - mean, mean - lo) / std > threshold:
            capped.append(c)
    qs = exact_quantiles(df, capped, [0.25, 0.75]) if bounded and capped else {}
    bounds = {}
    for c in capped:
        q = qs[c] if bounded else r[f"{c}__q"]
        iqr = q[1] - q[0]
        bounds[c] = [q[0] - factor * iqr, q[1] + factor * iqr]
    return Winsorizer("winsorize", {"bounds": bounds})


STAGES = {"impute": Imputer, "winsorize": Winsorizer}
