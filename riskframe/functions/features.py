"""Risk-feature expressions.  All are stateless; they fuse into one projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .exprs import indicator


def bmi_category(bmi: Column, bins=C.BMI_CATEGORIES) -> Column:
    """Right-closed bins -> ordinal code 0..n-1 (null -> -1)."""
    expr = F.when(bmi.isNull() | F.isnan(bmi), F.lit(-1))
    for code, (_, upper) in enumerate(bins):
        if upper == float("inf"):
            return expr.otherwise(F.lit(code)).cast("int")
        expr = expr.when(bmi <= F.lit(upper), F.lit(code))
    expr = expr.otherwise(F.lit(-1))
    return expr.cast("int")


def age_risk(age: Column, threshold: float = C.AGE_RISK_THRESHOLD) -> Column:
    return indicator(age > F.lit(threshold))


def bmi_high(category: Column, code: int = C.OVERWEIGHT_CODE) -> Column:
    return indicator(category >= F.lit(code))


def smoking_risk(smoking: Column, weights: dict = C.SMOKING_WEIGHTS) -> Column:
    lookup = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(lookup[smoking], F.lit(0.0))


def feature_columns(hypertension="hypertension", heart_disease="heart_disease", age="age",
                    bmi="bmi", glucose="blood_glucose_level", hba1c="HbA1c_level",
                    smoking="smoking_history", cfg: dict | None = None) -> dict:
    """Ordered name -> Column map of all derived features (dependency order kept)."""
    cfg = cfg or {}
    bins = cfg.get("bmi_categories", C.BMI_CATEGORIES)
    age_t = cfg.get("age_risk_threshold", C.AGE_RISK_THRESHOLD)
    glu_t = cfg.get("glucose_risk_threshold", C.GLUCOSE_RISK_THRESHOLD)
    a1c_t = cfg.get("HbA1c_risk_threshold", C.HBA1C_RISK_THRESHOLD)
    weights = cfg.get("smoking_weights", C.SMOKING_WEIGHTS)
    h, hd, a, b = F.col(hypertension), F.col(heart_disease), F.col(age), F.col(bmi)

    cat = bmi_category(b, bins)
    risk = age_risk(a, age_t)
    high = bmi_high(cat)
    mw, gw, lw, cw = C.MEDICAL_WEIGHTS, C.METABOLIC_WEIGHTS, C.LIFESTYLE_WEIGHTS, C.COMBINED_WEIGHTS
    medical = (h * F.lit(mw["hypertension"]) + hd * F.lit(mw["heart_disease"])
               + risk * F.lit(mw["age_risk"]) + high) / F.lit(C.MEDICAL_NORM)
    metabolic = (indicator(F.col(glucose) > F.lit(glu_t), "double") * F.lit(gw["glucose_risk"])
                 + indicator(F.col(hba1c) > F.lit(a1c_t), "double") * F.lit(gw["hba1c_risk"])
                 + high.cast("double")) / F.lit(C.METABOLIC_NORM)
    smoke = smoking_risk(F.col(smoking), weights)
    lifestyle = smoke * F.lit(lw["smoking_risk"]) + high.cast("double") * F.lit(lw["bmi_high"])
    combined = (medical * F.lit(cw["medical_risk_score"]) + metabolic * F.lit(cw["metabolic_score"])
                + lifestyle * F.lit(cw["lifestyle_score"]))
    return {
        "bmi_category": cat,
        "age_risk": risk,
        "age_bmi_interaction": a * b / F.lit(100.0),
        "medical_risk_score": medical,
        "metabolic_score": metabolic,
        "smoking_risk": smoke,
        "lifestyle_score": lifestyle,
        "age_hypertension": a * h,
        "age_heart_disease": a * hd,
        "cardio_metabolic_risk": h * hd * metabolic,
        "combined_risk_score": combined,
    }
