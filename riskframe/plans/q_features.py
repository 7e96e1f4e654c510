"""Feature-engineering queries (§2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_all
from ..operators.features import DERIVED, feature_transform
from ..sources.fixtures import KEY, patients, patients_dirty
from .catalog import register
from .oracle import feature_sql, select_rounded, with_views

RISK_BY_BMI_SQL = with_views("""
SELECT bmi_category, COUNT(*) AS n_patients,
 ROUND(AVG(combined_risk_score), 6) AS mean_combined_risk,
 ROUND(AVG(medical_risk_score), 6) AS mean_medical_risk,
 ROUND(AVG(metabolic_score), 6) AS mean_metabolic,
 ROUND(AVG(diabetes), 6) AS prevalence
FROM features GROUP BY bmi_category""", "patients", extra=feature_sql("patients"))


@register("risk_by_bmi_category", RISK_BY_BMI_SQL)
def risk_by_bmi_category(spark, sf_dir):
    """Flagship: risk features, then mean scores and prevalence per BMI class."""
    f = feature_transform(patients(spark, sf_dir))
    return f.groupBy("bmi_category").agg(
        F.count(F.lit(1)).alias("n_patients"),
        F.round(F.avg("combined_risk_score"), 6).alias("mean_combined_risk"),
        F.round(F.avg("medical_risk_score"), 6).alias("mean_medical_risk"),
        F.round(F.avg("metabolic_score"), 6).alias("mean_metabolic"),
        F.round(F.avg("diabetes"), 6).alias("prevalence"))


_DOUBLES = {"age_bmi_interaction", "medical_risk_score", "metabolic_score", "smoking_risk",
            "lifestyle_score", "age_hypertension", "age_heart_disease", "cardio_metabolic_risk",
            "combined_risk_score"}
_FEATURE_OUT = select_rounded(KEY + ["diabetes"] + DERIVED, _DOUBLES)
FEATURES_SQL = with_views(f"SELECT {_FEATURE_OUT} FROM features", "patients",
                          extra=feature_sql("patients"))


@register("feature_transform", FEATURES_SQL)
def feature_rows(spark, sf_dir):
    """All eleven derived features per patient row."""
    f = feature_transform(patients(spark, sf_dir))
    return round_all(f.select(*KEY, "diabetes", *DERIVED))


FEATURES_DIRTY_SQL = with_views(f"SELECT {_FEATURE_OUT} FROM features", "patients_dirty",
                                extra=feature_sql("patients_dirty"))


@register("feature_transform_nulls", FEATURES_DIRTY_SQL)
def feature_rows_dirty(spark, sf_dir):
    """Features on the dirty view: null BMI -> category -1, null inputs propagate."""
    f = feature_transform(patients_dirty(spark, sf_dir))
    return round_all(f.select(*KEY, "diabetes", *DERIVED))


# -- single feature expressions on the dirty view (§2.5 rows) -----------------
@register("bmi_category", with_views("""
SELECT bmi_category, COUNT(*) AS n, MIN(bmi) AS bmi_min, MAX(bmi) AS bmi_max
FROM (SELECT bmi, CASE WHEN bmi IS NULL THEN -1 WHEN bmi<=18.5E0 THEN 0 WHEN bmi<=24.9E0 THEN 1
      WHEN bmi<=29.9E0 THEN 2 ELSE 3 END AS bmi_category FROM patients_dirty) t
GROUP BY bmi_category""", "patients_dirty"))
def q_bmi_category(spark, sf):
    """Right-closed BMI classes (null -> -1): rows and BMI range per code."""
    from ..functions.features import bmi_category
    d = patients_dirty(spark, sf).select("bmi", bmi_category(F.col("bmi")).alias("bmi_category"))
    return d.groupBy("bmi_category").agg(F.count(F.lit(1)).alias("n"), F.min("bmi").alias("bmi_min"),
                                         F.max("bmi").alias("bmi_max"))


@register("smoking_risk", with_views("""
SELECT smoking_history, CASE smoking_history WHEN 'current' THEN 1.0E0 WHEN 'former' THEN 0.7E0
  WHEN 'ever' THEN 0.7E0 WHEN 'not current' THEN 0.5E0 WHEN 'never' THEN 0.0E0 WHEN 'No Info' THEN 0.5E0
  ELSE 0.0E0 END AS smoking_risk, COUNT(*) AS n
FROM patients_dirty GROUP BY smoking_history""", "patients_dirty"))
def q_smoking_risk(spark, sf):
    """Weight per smoking value (unknown or missing -> 0) and its row count."""
    from ..functions.features import smoking_risk
    d = patients_dirty(spark, sf)
    return d.groupBy("smoking_history").agg(F.count(F.lit(1)).alias("n")) \
        .select("smoking_history", smoking_risk(F.col("smoking_history")).alias("smoking_risk"), "n")
