"""Scaling (§2.6): robust (median / IQR) and standard (mean / population std)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted
from .profile import quantiles


@dataclass
class Scaler(Fitted):
    """x -> (x - center) / scale per column."""

    def transform(self, df: DataFrame) -> DataFrame:
        p = self.params["columns"]
        return df.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s)
                               for c, (m, s) in p.items()}) if p else df


def fit_robust(df: DataFrame, cols, relative_error: float | None = None) -> Scaler:
    """Center = median, scale = Q3 - Q1 (0 -> 1); one aggregate."""
    if not cols:
        return Scaler("robust", {"columns": {}})
    from .profile import exact_quantiles
    r = exact_quantiles(df, list(cols), [0.25, 0.5, 0.75]) if relative_error is None else df.agg(
        *[quantiles(F.col(f"`{c}`").cast("double"), [0.25, 0.5, 0.75], relative_error).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        q = r[c]
        iqr = q[2] - q[0]
        out[c] = [q[1], iqr if iqr != 0 else 1.0]
    return Scaler("robust", {"columns": out})


def fit_standard(df: DataFrame, cols) -> Scaler:
    """Center = mean, scale = population std (0 -> 1); one aggregate."""
    if not cols:
        return Scaler("standard", {"columns": {}})
    r = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"{c}__m") for c in cols],
               *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"{c}__s") for c in cols]).first()
    out = {c: [r[f"{c}__m"], r[f"{c}__s"] if r[f"{c}__s"] else 1.0] for c in cols}
    return Scaler("standard", {"columns": out})


def fit_scalers(df: DataFrame, robust_cols, standard_cols, relative_error: float | None = None,
                method: str = "bounded"):
    """(robust, standard) scalers from one shared aggregate over ``df``
    (``method='bounded'``: the robust quartiles from ``exact_quantiles``)."""
    from .profile import exact_quantiles
    robust_cols, standard_cols = list(robust_cols), list(standard_cols)
    if not robust_cols and not standard_cols:
        return fit_robust(df, []), fit_standard(df, [])
    x = lambda c: F.col(f"`{c}`").cast("double")
    bounded = method == "bounded"
    qs = exact_quantiles(df, robust_cols, [0.25, 0.5, 0.75]) if bounded and robust_cols else {}
    aggs = [] if bounded else [quantiles(x(c), [0.25, 0.5, 0.75], relative_error).alias(f"{c}__q")
                               for c in robust_cols]
    aggs += [F.avg(x(c)).alias(f"{c}__m") for c in standard_cols]
    aggs += [F.stddev_pop(x(c)).alias(f"{c}__s") for c in standard_cols]
    r = df.agg(*aggs).first() if aggs else None
    rob = {}
    for c in robust_cols:
        q = qs[c] if bounded else r[f"{c}__q"]
        iqr = q[2] - q[0]
        rob[c] = [q[1], iqr if iqr != 0 else 1.0]
    std = {c: [r[f"{c}__m"], r[f"{c}__s"] if r[f"{c}__s"] else 1.0] for c in standard_cols}
    return Scaler("robust", {"columns": rob}), Scaler("standard", {"columns": std})


STAGES = {"robust": Scaler, "standard": Scaler}
