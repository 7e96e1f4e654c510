"""Encoding (§2.6): label codes (alphabetical) and one-hot indicator columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted

NAN_TEXT = "nan"


def _as_text(c: str):
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NAN_TEXT))


@dataclass
class LabelEncoder(Fitted):
    """Code = position of the value in the sorted fitted labels; unseen -> error."""

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, labels in self.params["labels"].items():
            m = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
            code = m[_as_text(c)]
            out[c] = F.when(code.isNull(), F.raise_error(F.concat(
                F.lit(f"unseen label in {c}: "), _as_text(c)))).otherwise(code).cast("int")
        return df.withColumns(out)


def sorted_distinct(df: DataFrame, exprs: dict, max_per_column: int) -> dict:
    """name -> sorted distinct non-null values of each expression, in one job.

    The expressions are unpivoted into (name, value), de-duplicated (map-side
    combine) and at most ``max_per_column * len(exprs) + 1`` rows come to the
    driver; a column over its limit raises instead of growing the result.
    """
    names = list(exprs)
    cells = F.array(*[F.struct(F.lit(n).alias("n"), e.alias("v")) for n, e in exprs.items()])
    d = df.select(F.inline(cells)).filter(F.col("v").isNotNull()).distinct()
    cap = max_per_column * len(names) + 1
    rows = d.limit(cap).collect()
    out = {n: [] for n in names}
    for r in rows:
        out[r["n"]].append(r["v"])
    over = [n for n, v in out.items() if len(v) > max_per_column]
    if over or len(rows) == cap:
        raise ValueError(f"{over or names}: more than {max_per_column} distinct values")
    return {n: sorted(v) for n, v in out.items()}


def fit_label_encoder(df: DataFrame, cols, max_labels: int = 100_000) -> LabelEncoder:
    """Sorted distinct values per column (text cast, null -> 'nan'), all
    columns in one job.  The labels are model-sized; their count is bounded
    before they reach the driver."""
    if not cols:
        return LabelEncoder("label", {"labels": {}})
    return LabelEncoder("label", {"labels": sorted_distinct(df, {c: _as_text(c) for c in cols}, max_labels)})


@dataclass
class OneHotEncoder(Fitted):
    """One double indicator per fitted category (``feature_value``); unknown or
    null -> all zeros; the original columns are dropped."""

    def transform(self, df: DataFrame) -> DataFrame:
        cats = self.params["categories"]
        new = {}
        for c, values in cats.items():
            for v in values:
                new[f"{c}_{v}"] = F.when(F.col(f"`{c}`").cast("string") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))
        keep = [F.col(f"`{x}`") for x in df.columns if x not in cats]
        return df.select(*keep, *[e.alias(n) for n, e in new.items()])


def fit_onehot(df: DataFrame, cols, max_categories: int = 1000) -> OneHotEncoder:
    """Sorted categories per column (nulls are no category), all columns in one job."""
    if not cols:
        return OneHotEncoder("onehot", {"categories": {}})
    cats = sorted_distinct(df, {c: F.col(f"`{c}`").cast("string") for c in cols}, max_categories)
    return OneHotEncoder("onehot", {"categories": cats})


STAGES = {"label": LabelEncoder, "onehot": OneHotEncoder}
