"""Rule-based validation (§2.2): one report DataFrame, all data rules in one scan.

Report schema: ``rule, column_name, severity, value, n_bad``.  Schema rules
come from ``df.schema`` (no data read); the data rules share a single
grouped aggregate over an unpivot of the discrete columns plus the
negative-value flags of the continuous ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from ..config import Roles
from ..session import cut_lineage

REPORT_SCHEMA = "rule string, column_name string, severity string, value string, n_bad long"
NULL_TEXT = "<null>"
ROWS = "__rows"  # value-profile entry holding the row count


def _rows(spark, rows):
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def validate(df: DataFrame, roles: Roles, binary_includes_target: bool = True) -> DataFrame:
    spark = df.sparkSession
    fields = {f.name: f.dataType for f in df.schema.fields}
    expected = roles.expected_columns
    schema_rows = []
    missing = [c for c in expected if c not in fields]
    for c in missing:
        schema_rows.append(("missing_column", c, "error", None, None))
    column_rules = not missing
    if column_rules:
        for c in df.columns:
            if c not in expected:
                schema_rows.append(("unexpected_column", c, "warning", None, None))
    target_ok = roles.target in fields
    if not target_ok:
        schema_rows.append(("target_missing", roles.target, "error", None, None))

    binary = list(roles.binary) + ([roles.target] if binary_includes_target and target_ok else [])
    discrete = []
    if column_rules:
        discrete += [c for c in roles.categorical if c in roles.valid_values] + binary
    if target_ok and roles.target not in discrete:
        discrete.append(roles.target)
    continuous = []
    if column_rules:
        for c in roles.continuous:
            if isinstance(fields[c], NumericType):
                continuous.append(c)
            else:
                schema_rows.append(("non_numeric", c, "error", None, None))
    schema_df = _rows(spark, schema_rows)
    # one pass over the data: the value profile also counts the rows, which
    # decides the not-empty rule (a failed basic check stops everything)
    vc = value_profile(df, discrete, continuous)
    n_rows = vc.filter(F.col("column_name") == ROWS).select("n_bad").first()
    if not n_rows or not n_rows[0]:
        return _rows(spark, [("not_empty", None, "error", None, 0)])
    if not discrete and not continuous:
        return schema_df
    parts = [schema_df]
    if column_rules:
        parts.append(_allowed(vc, {c: roles.valid_values[c] for c in roles.categorical
                                   if c in roles.valid_values}))
        parts.append(_binary(vc, binary))
        parts.append(_negative(vc, continuous))
    if target_ok:
        parts.append(_classes(vc, roles.target, roles.expected_classes))
    return _union(parts)


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _text(c: str, kind):
    """The value as text; whole numbers of any numeric type without a fraction
    (0.0 is 0), NaN as missing."""
    x = F.col(f"`{c}`")
    if not isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return x.cast("string")
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    text = F.when(whole, x.cast("long").cast("string")).otherwise(x.cast("string"))
    return text if isinstance(kind, DecimalType) else F.when(~F.isnan(x), text)


def value_profile(df: DataFrame, discrete, continuous=()) -> DataFrame:
    """``(column_name, value, n_bad)``: counts per distinct value of the discrete
    columns, the negative-value counts of the continuous ones and the row
    count (``column_name = '__rows'``).

    One unpivot and one grouped aggregate (map-side combine, so a value held
    by a third of the rows is a single partial counter per task).  The
    result is sized by the distinct values; it is checkpointed once and
    every rule reads it instead of re-scanning the table.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column_name"), _text(c, types[c]).alias("value")) for c in discrete]
    cells += [F.struct(F.lit(c).alias("column_name"),
                       F.when(F.col(f"`{c}`") < 0, F.lit("negative")).alias("value"))
              for c in continuous]
    cells.append(F.struct(F.lit(ROWS).alias("column_name"), F.lit(None).cast("string").alias("value")))
    # cells of continuous columns that are not negative are left out before the explode
    kept = F.filter(F.array(*cells), lambda x: x["value"].isNotNull() | ~x["column_name"].isin(list(continuous))) \
        if continuous else F.array(*cells)
    vc = (df.select(F.explode(kept).alias("cv")).select("cv.*")
          .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_bad")))
    return cut_lineage(vc)


def _bad(vc, rule, severity, cond):
    return vc.filter(cond).select(F.lit(rule).alias("rule"), "column_name", F.lit(severity).alias("severity"),
                                  F.coalesce("value", F.lit(NULL_TEXT)).alias("value"), "n_bad")


def _allowed(vc, domains: dict) -> DataFrame:
    cond = F.lit(False)
    for c, dom in domains.items():
        cond = cond | ((F.col("column_name") == c) & (F.col("value").isNull() | ~F.col("value").isin(list(dom))))
    return _bad(vc, "allowed_values", "warning", cond)


def _binary(vc, cols) -> DataFrame:
    cond = F.col("column_name").isin(list(cols)) & (F.col("value").isNull() | ~F.col("value").isin("0", "1")) \
        if cols else F.lit(False)
    return _bad(vc, "binary_domain", "error", cond)


def _negative(vc, cols) -> DataFrame:
    cond = F.col("column_name").isin(list(cols)) & (F.col("value") == "negative") if cols else F.lit(False)
    return _bad(vc, "non_negative", "warning", cond)


def _classes(vc, target: str, expected) -> DataFrame:
    spark = vc.sparkSession
    exp = [str(x) for x in expected]
    present = vc.filter(F.col("column_name") == target)
    bad = _bad(vc, "unexpected_class", "error", (F.col("column_name") == target) & (
        F.col("value").isNull() | ~F.col("value").isin(exp)))
    expected_df = spark.createDataFrame([(target, e) for e in exp], "column_name string, value string")
    missing = expected_df.join(present, ["column_name", "value"], "left_anti").select(
        F.lit("class_missing").alias("rule"), "column_name", F.lit("warning").alias("severity"),
        "value", F.lit(0).cast("long").alias("n_bad"))
    return bad.unionByName(missing)


# Single rules on any table (each one grouped aggregate over the named columns).

def not_empty(df: DataFrame) -> DataFrame:
    """One row ``(rule, severity, passed)``; reads at most one row."""
    ok = not df.isEmpty()
    return df.sparkSession.createDataFrame([("not_empty", "error", ok)], "rule string, severity string, passed boolean")


def allowed_values(df: DataFrame, domains: dict) -> DataFrame:
    """Values outside each column's domain (a missing value counts as invalid)."""
    return _allowed(value_profile(df, list(domains)), domains)


def binary_domain(df: DataFrame, cols) -> DataFrame:
    """Values other than 0/1 (missing included) per binary column."""
    return _binary(value_profile(df, list(cols)), cols)


def non_negative(df: DataFrame, cols) -> DataFrame:
    """Count of negative values per numeric column (only columns that have some)."""
    return _negative(value_profile(df, [], list(cols)), cols)


def target_classes(df: DataFrame, target: str, expected) -> DataFrame:
    """Unexpected target values (error) and expected classes that never occur (warning)."""
    if target not in df.columns:
        return _rows(df.sparkSession, [("target_missing", target, "error", None, None)])
    return _classes(value_profile(df, [target]), target, expected)


def validation_summary(report: DataFrame) -> DataFrame:
    """One row: is_valid, n_errors, n_warnings."""
    return report.agg(F.count_if(F.col("severity") == "error").alias("n_errors"),
                      F.count_if(F.col("severity") == "warning").alias("n_warnings")) \
        .select((F.col("n_errors") == 0).alias("is_valid"), "n_errors", "n_warnings")


def _metric(metric, column, value):
    return F.struct(F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column_name"),
                    value.cast("double").alias("value"))


def final_validation(df: DataFrame, numeric, categorical, target: str, split_col: str = "split") -> DataFrame:
    """Post-pipeline check in long form ``(metric, column_name, value)``.

    total nulls, duplicate rows, mean/std per numeric feature, the encoded
    columns (name contains a categorical name), class shares, split counts.
    """
    from .profile import duplicate_count
    aggs = [sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0)).alias("missing_values")]
    for c in numeric:
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"{c}__mean"), F.stddev_samp(F.col(f"`{c}`")).alias(f"{c}__std")]
    one = df.agg(*aggs)
    rows = [_metric("missing_values", None, F.col("missing_values"))]
    for c in numeric:
        rows.append(_metric("mean", c, F.col(f"`{c}__mean`")))
        rows.append(_metric("std", c, F.col(f"`{c}__std`")))
    encoded = [c for c in df.columns if any(cat in c for cat in categorical)]
    for c in encoded:
        rows.append(_metric("encoded_column", c, F.lit(None)))
    stats = one.select(F.inline(F.array(*rows)))
    dup = duplicate_count(df).select(F.lit("duplicates").alias("metric"), F.lit(None).cast("string").alias("column_name"),
                                     F.col("n_duplicates").cast("double").alias("value"))
    cls = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    cls = cls.select(F.lit("class_share").alias("metric"), F.col(target).cast("string").alias("column_name"),
                     (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("value"))
    spl = df.groupBy(split_col).agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .select(F.lit("split_count").alias("metric"), F.col(split_col).alias("column_name"), "value")
    return stats.unionByName(dup).unionByName(cls).unionByName(spl)
