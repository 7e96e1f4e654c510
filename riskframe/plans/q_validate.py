"""Validation queries (§2.2)."""

from __future__ import annotations

from .. import config as C
from ..config import PATIENT_ROLES
from ..operators import validate as V
from ..operators.validate import validate, validation_summary
from ..sources.fixtures import KEY, patients_dirty
from .catalog import register
from .oracle import with_views


def _validate_sql():
    parts = [f"SELECT 'unexpected_column' AS rule, '{k}' AS column_name, 'warning' AS severity, "
             f"CAST(NULL AS VARCHAR) AS value, CAST(NULL AS BIGINT) AS n_bad" for k in KEY]
    for c, dom in C.VALID_VALUES.items():
        lst = ", ".join(f"'{v}'" for v in dom)
        parts.append(f"SELECT 'allowed_values', '{c}', 'warning', COALESCE({c}, '<null>'), COUNT(*) "
                     f"FROM patients_dirty WHERE {c} IS NULL OR {c} NOT IN ({lst}) GROUP BY {c}")
    for c in C.BINARY:
        parts.append(f"SELECT 'binary_domain', '{c}', 'error', COALESCE(CAST({c} AS VARCHAR), '<null>'), COUNT(*) "
                     f"FROM patients_dirty WHERE {c} IS NULL OR {c} NOT IN (0, 1) GROUP BY {c}")
    for c in C.CONTINUOUS:
        parts.append(f"SELECT 'non_negative', '{c}', 'warning', 'negative', COUNT(*) FROM patients_dirty "
                     f"WHERE {c} < 0 HAVING COUNT(*) > 0")
    parts.append("SELECT 'unexpected_class', 'diabetes', 'error', COALESCE(CAST(diabetes AS VARCHAR), '<null>'), "
                 "COUNT(*) FROM patients_dirty WHERE diabetes IS NULL OR diabetes NOT IN (0, 1) GROUP BY diabetes")
    parts.append("SELECT 'class_missing', 'diabetes', 'warning', v, 0 FROM (VALUES ('0'), ('1')) e(v) "
                 "WHERE v NOT IN (SELECT CAST(diabetes AS VARCHAR) FROM patients_dirty WHERE diabetes IS NOT NULL)")
    return "\nUNION ALL\n".join(parts)


VALIDATE_SQL = with_views(_validate_sql(), "patients_dirty")


@register("validate", VALIDATE_SQL)
def q_validate(spark, sf):
    return validate(patients_dirty(spark, sf), PATIENT_ROLES)


@register("validation_summary", with_views(f"""
SELECT COUNT(*) FILTER (WHERE severity = 'error') = 0 AS is_valid,
 COUNT(*) FILTER (WHERE severity = 'error') AS n_errors,
 COUNT(*) FILTER (WHERE severity = 'warning') AS n_warnings
FROM ({_validate_sql()})""", "patients_dirty"))
def q_validation_summary(spark, sf):
    return validation_summary(validate(patients_dirty(spark, sf), PATIENT_ROLES))


# -- single rules, bound to other driver tables as well (§2.2 v_* rows) -------
# The domains and expected classes used by the second bindings.
ORDER_DOMAINS = {"o_orderstatus": ["F", "O"],
                 "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]}
SEGMENT_DOMAIN = {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]}
STATUS_CLASSES = ["F", "O", "X"]
NOT_EMPTY_TABLES = ["orders", "customer", "lineitem", "labels", "events"]
NON_NEGATIVE = [("customer", "c_acctbal"), ("supplier", "s_acctbal"), ("orders", "o_totalprice"),
                ("events", "value")]


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


def _bad_sql(rule, severity, src, col, cond, value_expr=None):
    v = value_expr or f"COALESCE(CAST({col} AS VARCHAR), '<null>')"
    return (f"SELECT '{rule}' AS rule, '{col}' AS column_name, '{severity}' AS severity, {v} AS value, "
            f"COUNT(*) AS n_bad FROM {src} WHERE {cond} GROUP BY {col}")


@register("v_not_empty", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'not_empty' AS rule, 'error' AS severity, "
    f"EXISTS (SELECT 1 FROM {t}) AS passed" for t in NOT_EMPTY_TABLES))
def q_v_not_empty(spark, sf):
    from pyspark.sql import functions as F
    from ..sources.tables import table
    parts = [V.not_empty(table(spark, sf, t)).select(F.lit(t).alias("table_name"), "*") for t in NOT_EMPTY_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("v_allowed_values", "\nUNION ALL\n".join(
    [_bad_sql("allowed_values", "warning", "orders", c, f"{c} IS NULL OR {c} NOT IN ({_in(d)})")
     for c, d in ORDER_DOMAINS.items()]
    + [_bad_sql("allowed_values", "warning", "customer", c, f"{c} IS NULL OR {c} NOT IN ({_in(d)})")
       for c, d in SEGMENT_DOMAIN.items()]))
def q_v_allowed(spark, sf):
    from ..sources.tables import table
    return V.allowed_values(table(spark, sf, "orders"), ORDER_DOMAINS).unionByName(
        V.allowed_values(table(spark, sf, "customer"), SEGMENT_DOMAIN))


_BIN_DIRTY = [c for c in C.BINARY if c != C.TARGET]


@register("v_binary_domain", with_views("\nUNION ALL\n".join(
    [_bad_sql("binary_domain", "error", "labels", c, f"{c} IS NULL OR {c} NOT IN (0, 1)") for c in ("quality", "toxic")]
    + [_bad_sql("binary_domain", "error", "patients_dirty", c, f"{c} IS NULL OR {c} NOT IN (0, 1)")
       for c in _BIN_DIRTY]), "patients_dirty"))
def q_v_binary(spark, sf):
    from ..sources.tables import table
    return V.binary_domain(table(spark, sf, "labels"), ["quality", "toxic"]).unionByName(
        V.binary_domain(patients_dirty(spark, sf), _BIN_DIRTY))


@register("v_non_negative", with_views("\nUNION ALL\n".join(
    [f"SELECT 'non_negative' AS rule, '{c}' AS column_name, 'warning' AS severity, 'negative' AS value, "
     f"COUNT(*) AS n_bad FROM {t} WHERE {c} < 0 HAVING COUNT(*) > 0" for t, c in NON_NEGATIVE]
    + [f"SELECT 'non_negative', '{c}', 'warning', 'negative', COUNT(*) FROM patients_dirty WHERE {c} < 0 "
       f"HAVING COUNT(*) > 0" for c in C.CONTINUOUS]), "patients_dirty"))
def q_v_non_negative(spark, sf):
    from ..sources.tables import table
    parts = [V.non_negative(table(spark, sf, t), [c]) for t, c in NON_NEGATIVE]
    parts.append(V.non_negative(patients_dirty(spark, sf), C.CONTINUOUS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _classes_sql(src, target, expected):
    exp = ", ".join(f"('{e}')" for e in expected)
    return (f"SELECT 'unexpected_class' AS rule, '{target}' AS column_name, 'error' AS severity, "
            f"COALESCE(CAST({target} AS VARCHAR), '<null>') AS value, COUNT(*) AS n_bad FROM {src} "
            f"WHERE {target} IS NULL OR CAST({target} AS VARCHAR) NOT IN ({_in(expected)}) GROUP BY {target}\n"
            f"UNION ALL\nSELECT 'class_missing', '{target}', 'warning', v, 0 FROM (VALUES {exp}) e(v) "
            f"WHERE v NOT IN (SELECT CAST({target} AS VARCHAR) FROM {src} WHERE {target} IS NOT NULL)")


@register("v_target_classes", with_views("\nUNION ALL\n".join([
    _classes_sql("labels", "quality", ["0", "1"]), _classes_sql("orders", "o_orderstatus", STATUS_CLASSES),
    _classes_sql("patients_dirty", C.TARGET, ["0", "1"])]), "patients_dirty"))
def q_v_target(spark, sf):
    from ..sources.tables import table
    return (V.target_classes(table(spark, sf, "labels"), "quality", [0, 1])
            .unionByName(V.target_classes(table(spark, sf, "orders"), "o_orderstatus", STATUS_CLASSES))
            .unionByName(V.target_classes(patients_dirty(spark, sf), C.TARGET, C.EXPECTED_CLASSES)))
