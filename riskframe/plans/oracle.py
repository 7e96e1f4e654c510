"""SQL twins of the patient views and of the feature projection (for DuckDB).

These are independent re-statements in SQL used only to check the Spark
jobs; the driver's tables are pre-registered views in the oracle engine.
"""

from __future__ import annotations

VIEWS = {
    "patients": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
 CASE WHEN l_orderkey%1000=0 THEN 'Other' WHEN l_orderkey%5<3 THEN 'Female' ELSE 'Male' END AS gender,
 CAST((l_partkey*7+l_orderkey)%81 AS DOUBLE) AS age,
 CASE WHEN l_orderkey%13=0 THEN 1 ELSE 0 END AS hypertension,
 CASE WHEN l_partkey%25=0 THEN 1 ELSE 0 END AS heart_disease,
 CASE l_suppkey%6 WHEN 0 THEN 'never' WHEN 1 THEN 'current' WHEN 2 THEN 'former'
      WHEN 3 THEN 'not current' WHEN 4 THEN 'ever' ELSE 'No Info' END AS smoking_history,
 15.0E0+CAST((l_orderkey*31+l_partkey)%300 AS DOUBLE)/10.0E0
   +CASE WHEN l_orderkey%97=0 THEN 40.0E0 ELSE 0.0E0 END AS bmi,
 3.5E0+CAST((l_partkey*11+l_suppkey)%56 AS DOUBLE)/10.0E0 AS HbA1c_level,
 80.0E0+CAST((l_orderkey*17+l_suppkey*3)%221 AS DOUBLE) AS blood_glucose_level,
 CASE WHEN (l_partkey*11+l_suppkey)%56>38 AND (l_orderkey*17+l_suppkey*3)%221>130 THEN 1 ELSE 0 END AS diabetes
FROM (SELECT DISTINCT l_orderkey,l_partkey,l_suppkey,l_linenumber FROM lineitem) t""",
    "dirty_base": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey%501=0 THEN 'Unknown' ELSE gender END AS gender,
  CASE WHEN l_partkey%401=0 THEN -1.0E0 ELSE age END AS age,
  CASE WHEN l_orderkey%29=0 THEN NULL ELSE hypertension END AS hypertension,
  CASE WHEN l_suppkey%50=0 AND l_linenumber=1 THEN 2 ELSE heart_disease END AS heart_disease,
  CASE WHEN l_orderkey%23=0 THEN NULL ELSE smoking_history END AS smoking_history,
  CASE WHEN l_orderkey%19=0 THEN NULL ELSE bmi END AS bmi,
  HbA1c_level, blood_glucose_level, diabetes
 FROM patients""",
    "patients_dirty": """
SELECT * FROM dirty_base UNION ALL SELECT * FROM dirty_base WHERE l_orderkey%50=0""",
    "scored": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, diabetes AS label, model,
 CASE WHEN model='a1c' THEN HbA1c_level/10.0E0 ELSE blood_glucose_level/310.0E0 END AS p1,
 CASE WHEN (CASE WHEN model='a1c' THEN HbA1c_level/10.0E0 ELSE blood_glucose_level/310.0E0 END)>=0.7E0
      THEN 1 ELSE 0 END AS prediction
FROM patients, (SELECT 'a1c' AS model UNION ALL SELECT 'glucose' AS model) m""",
}
VIEW_DEPS = {"patients": [], "dirty_base": ["patients"], "patients_dirty": ["dirty_base"],
             "scored": ["patients"]}


def feature_sql(src: str) -> dict:
    """CTEs computing the eleven risk features over view ``src``; result view ``features``."""
    return {
        "f1": f"""
SELECT *,
 CASE WHEN bmi IS NULL THEN -1 WHEN bmi<=18.5E0 THEN 0 WHEN bmi<=24.9E0 THEN 1
      WHEN bmi<=29.9E0 THEN 2 ELSE 3 END AS bmi_category,
 CASE WHEN age>40.0E0 THEN 1 ELSE 0 END AS age_risk,
 age*bmi/100.0E0 AS age_bmi_interaction,
 CASE smoking_history WHEN 'current' THEN 1.0E0 WHEN 'former' THEN 0.7E0 WHEN 'ever' THEN 0.7E0
      WHEN 'not current' THEN 0.5E0 WHEN 'never' THEN 0.0E0 WHEN 'No Info' THEN 0.5E0
      ELSE 0.0E0 END AS smoking_risk,
 CASE WHEN blood_glucose_level>140.0E0 THEN 1.0E0 ELSE 0.0E0 END AS glucose_risk,
 CASE WHEN HbA1c_level>5.7E0 THEN 1.0E0 ELSE 0.0E0 END AS hba1c_risk
FROM {src}""",
        "f2": "SELECT *, CASE WHEN bmi_category>=2 THEN 1 ELSE 0 END AS bmi_high FROM f1",
        "f3": """
SELECT *,
 (hypertension*2.0E0+heart_disease*2.0E0+age_risk*1.5E0+bmi_high)/6.5E0 AS medical_risk_score,
 (glucose_risk*2.0E0+hba1c_risk*2.0E0+bmi_high)/5.0E0 AS metabolic_score,
 smoking_risk*0.6E0+bmi_high*0.4E0 AS lifestyle_score,
 age*hypertension AS age_hypertension, age*heart_disease AS age_heart_disease
FROM f2""",
        "features": """
SELECT * EXCLUDE (bmi_high, glucose_risk, hba1c_risk),
 hypertension*heart_disease*metabolic_score AS cardio_metabolic_risk,
 medical_risk_score*0.4E0+metabolic_score*0.4E0+lifestyle_score*0.2E0 AS combined_risk_score
FROM f3""",
    }


def with_views(body: str, *views: str, extra: dict | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (views in dependency order, then ``extra``)."""
    order: list = []

    def add(v):
        for d in VIEW_DEPS[v]:
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({VIEWS[v]})" for v in order]
    ctes += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


def select_rounded(cols, doubles, digits: int = 6) -> str:
    """Select list with ROUND(...) around the floating columns."""
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" if c in doubles else c for c in cols)
