"""Encoding, scaling, splitting and the preparation plan (§2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..config import PATIENT_ROLES
from ..functions.exprs import round_all
from ..operators import encode, scale, split
from ..operators.validate import final_validation
from ..sources.fixtures import KEY, patients, patients_dirty
from ..sources.tables import table
from .catalog import register
from .oracle import select_rounded, with_views
from .prepare import process_data
from .q_clean import CONT, DISCRETE, REF9, impute_select, winsor_sql

KEYS_SQL = ", ".join(KEY)


def _hash_sql(purpose, seed=C.SEED):
    return f"md5(concat_ws('|', '{seed}', {KEYS_SQL}, '{purpose}'))"


def _label_codes_sql(src, cols, fit_src=None):
    fit_src = fit_src or src
    ctes = {f"lab_{c}": f"SELECT v, DENSE_RANK() OVER (ORDER BY v) - 1 AS code FROM "
                        f"(SELECT DISTINCT COALESCE(CAST({c} AS VARCHAR), 'nan') AS v FROM {fit_src})"
            for c in cols}
    return ctes


_LE_CTES = _label_codes_sql("patients_dirty", C.CATEGORICAL)
LABEL_SQL = with_views(f"""
SELECT {KEYS_SQL}, CAST(lab_gender.code AS INTEGER) AS gender, CAST(lab_smoking_history.code AS INTEGER) AS smoking_history
FROM patients_dirty t
JOIN lab_gender ON COALESCE(t.gender, 'nan') = lab_gender.v
JOIN lab_smoking_history ON COALESCE(t.smoking_history, 'nan') = lab_smoking_history.v""",
                       "patients_dirty", extra=_LE_CTES)


@register("label_encode", LABEL_SQL)
def q_label(spark, sf):
    d = patients_dirty(spark, sf)
    enc = encode.fit_label_encoder(d, C.CATEGORICAL)
    return enc.transform(d).select(*KEY, *C.CATEGORICAL)


def _onehot_sql():
    status = ["F", "O", "P"]
    prio = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    cols = [f"CASE WHEN o_orderstatus = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS \"o_orderstatus_{v}\"" for v in status]
    cols += [f"CASE WHEN o_orderpriority = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS \"o_orderpriority_{v}\"" for v in prio]
    return f"SELECT o_orderkey, o_totalprice, {', '.join(cols)} FROM orders"


@register("onehot_encode", _onehot_sql())
def q_onehot(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    enc = encode.fit_onehot(o, ["o_orderstatus", "o_orderpriority"])
    return enc.transform(o)


ROBUST_SQL = with_views(f"""
SELECT {KEYS_SQL},
 ROUND((age - a_q2) / CASE WHEN a_q3 - a_q1 = 0 THEN 1.0 ELSE a_q3 - a_q1 END, 6) AS age,
 ROUND((blood_glucose_level - g_q2) / CASE WHEN g_q3 - g_q1 = 0 THEN 1.0 ELSE g_q3 - g_q1 END, 6) AS blood_glucose_level
FROM patients, (SELECT QUANTILE_CONT(age, 0.25) a_q1, QUANTILE_CONT(age, 0.5) a_q2, QUANTILE_CONT(age, 0.75) a_q3,
  QUANTILE_CONT(blood_glucose_level, 0.25) g_q1, QUANTILE_CONT(blood_glucose_level, 0.5) g_q2,
  QUANTILE_CONT(blood_glucose_level, 0.75) g_q3 FROM patients) s""", "patients")


@register("robust_scale", ROBUST_SQL)
def q_robust(spark, sf):
    p = patients(spark, sf)
    sc = scale.fit_robust(p, C.ROBUST_COLUMNS)
    return round_all(sc.transform(p).select(*KEY, *C.ROBUST_COLUMNS))


STANDARD_SQL = with_views(f"""
SELECT {KEYS_SQL},
 ROUND((bmi - b_m) / CASE WHEN b_s = 0 THEN 1.0 ELSE b_s END, 6) AS bmi,
 ROUND((HbA1c_level - h_m) / CASE WHEN h_s = 0 THEN 1.0 ELSE h_s END, 6) AS HbA1c_level
FROM patients, (SELECT AVG(bmi) b_m, STDDEV_POP(bmi) b_s, AVG(HbA1c_level) h_m, STDDEV_POP(HbA1c_level) h_s
  FROM patients) s""", "patients")


@register("standard_scale", STANDARD_SQL)
def q_standard(spark, sf):
    p = patients(spark, sf)
    sc = scale.fit_standard(p, C.STANDARD_COLUMNS)
    return round_all(sc.transform(p).select(*KEY, *C.STANDARD_COLUMNS))


SPLIT_SQL = with_views(f"""
SELECT {KEYS_SQL}, diabetes,
 CASE WHEN ROW_NUMBER() OVER (PARTITION BY diabetes ORDER BY {_hash_sql('split')})
      <= ROUND(COUNT(*) OVER (PARTITION BY diabetes) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM patients""", "patients")


@register("stratified_split", SPLIT_SQL)
def q_split(spark, sf):
    p = patients(spark, sf).select(*KEY, "diabetes")
    return split.stratified_split(p, "diabetes", KEY, C.TEST_SIZE, C.SEED)


FOLDS_SQL = with_views(f"""
SELECT {KEYS_SQL}, diabetes,
 CAST((ROW_NUMBER() OVER (PARTITION BY diabetes ORDER BY {_hash_sql('fold')}) - 1) % 5 AS INTEGER) AS fold
FROM patients""", "patients")


@register("stratified_folds", FOLDS_SQL)
def q_folds(spark, sf):
    p = patients(spark, sf).select(*KEY, "diabetes")
    return split.stratified_folds(p, "diabetes", KEY, C.N_FOLDS, C.SEED)


DOC_SPLIT_SQL = """
SELECT quality, split, COUNT(*) AS n FROM (
 SELECT l.quality, CASE WHEN ROW_NUMBER() OVER (PARTITION BY l.quality ORDER BY md5(concat_ws('|', '42', l.doc_id, 'split')))
   <= ROUND(COUNT(*) OVER (PARTITION BY l.quality) * 0.2) THEN 'test' ELSE 'train' END AS split
 FROM labels l JOIN documents d ON l.doc_id = d.doc_id) GROUP BY quality, split"""


@register("stratified_split_labels", DOC_SPLIT_SQL)
def q_split_docs(spark, sf):
    ld = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id"), "doc_id")
    s = split.stratified_split(ld, "quality", ["doc_id"], 0.2, 42)
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


# -- the whole preparation ----------------------------------------------------
def _process_sql(rounded: bool = True, final_body: str | None = None):
    imputed = f"SELECT DISTINCT {impute_select('patients_dirty')} FROM patients_dirty"
    splitted = f"""SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY diabetes ORDER BY {_hash_sql('split')})
      <= ROUND(COUNT(*) OVER (PARTITION BY diabetes) * 0.2) THEN 'test' ELSE 'train' END AS split FROM imputed"""
    passthrough = KEY + [c for c in REF9 if c not in CONT] + ["split"]
    capped = winsor_sql("splitted", CONT, passthrough, stats_src="(SELECT * FROM splitted WHERE split = 'train')")
    ctes = {"imputed": imputed, "splitted": splitted, "capped": capped}
    ctes.update(_label_codes_sql("capped", C.CATEGORICAL, fit_src="(SELECT * FROM capped WHERE split = 'train')"))
    ctes["encoded"] = f"""SELECT t.* REPLACE (CAST(lab_gender.code AS INTEGER) AS gender,
  CAST(lab_smoking_history.code AS INTEGER) AS smoking_history) FROM capped t
 JOIN lab_gender ON COALESCE(t.gender, 'nan') = lab_gender.v
 JOIN lab_smoking_history ON COALESCE(t.smoking_history, 'nan') = lab_smoking_history.v"""
    ctes["sc"] = """SELECT QUANTILE_CONT(age, 0.25) a_q1, QUANTILE_CONT(age, 0.5) a_q2, QUANTILE_CONT(age, 0.75) a_q3,
  QUANTILE_CONT(blood_glucose_level, 0.25) g_q1, QUANTILE_CONT(blood_glucose_level, 0.5) g_q2,
  QUANTILE_CONT(blood_glucose_level, 0.75) g_q3, AVG(bmi) b_m, STDDEV_POP(bmi) b_s,
  AVG(HbA1c_level) h_m, STDDEV_POP(HbA1c_level) h_s FROM encoded WHERE split = 'train'"""
    def r(e):
        return f"ROUND({e}, 6)" if rounded else e
    body = f"""SELECT {KEYS_SQL}, gender,
 {r("(age - a_q2) / CASE WHEN a_q3 - a_q1 = 0 THEN 1.0 ELSE a_q3 - a_q1 END")} AS age,
 hypertension, heart_disease, smoking_history,
 {r("(bmi - b_m) / CASE WHEN b_s = 0 THEN 1.0 ELSE b_s END")} AS bmi,
 {r("(HbA1c_level - h_m) / CASE WHEN h_s = 0 THEN 1.0 ELSE h_s END")} AS HbA1c_level,
 {r("(blood_glucose_level - g_q2) / CASE WHEN g_q3 - g_q1 = 0 THEN 1.0 ELSE g_q3 - g_q1 END")} AS blood_glucose_level,
 diabetes, split
FROM encoded, sc"""
    if final_body is not None:
        ctes["processed"] = body
        body = final_body
    return with_views(body, "patients_dirty", extra=ctes)


PROCESS_SQL = _process_sql()


def prepared_patients(spark, sf, materialize=True):
    d = patients_dirty(spark, sf)
    return process_data(d, PATIENT_ROLES, KEY, materialize=materialize)


@register("process_data", PROCESS_SQL)
def q_process(spark, sf):
    """Impute -> dedup -> exact split -> caps, codes, scalers fit on train."""
    out = prepared_patients(spark, sf).data
    return round_all(out.select(*KEY, *REF9, "split"))


def _final_sql():
    cols = KEY + REF9 + ["split"]
    nulls = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    parts = [f"SELECT 'missing_values' AS metric, CAST(NULL AS VARCHAR) AS column_name, CAST({nulls} AS DOUBLE) AS value FROM processed"]
    for c in CONT:
        parts.append(f"SELECT 'mean', '{c}', ROUND(AVG({c}), 6) FROM processed")
        parts.append(f"SELECT 'std', '{c}', ROUND(STDDEV_SAMP({c}), 6) FROM processed")
    for c in C.CATEGORICAL:
        parts.append(f"SELECT 'encoded_column', '{c}', CAST(NULL AS DOUBLE)")
    parts.append(f"SELECT 'duplicates', NULL, CAST(SUM(c - 1) AS DOUBLE) FROM (SELECT COUNT(*) AS c FROM processed GROUP BY {', '.join(cols)})")
    parts.append("SELECT 'class_share', CAST(diabetes AS VARCHAR), ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) FROM processed GROUP BY diabetes")
    parts.append("SELECT 'split_count', split, CAST(COUNT(*) AS DOUBLE) FROM processed GROUP BY split")
    return _process_sql(rounded=False, final_body="\nUNION ALL\n".join(parts))


@register("final_validation", _final_sql())
def q_final(spark, sf):
    """Post-preparation report: nulls, duplicates, mean/std, encoded columns, class shares, split counts."""
    out = prepared_patients(spark, sf).data.select(*KEY, *REF9, "split")
    return round_all(final_validation(out, CONT, C.CATEGORICAL, "diabetes"))


@register("factorize", with_views("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(COALESCE(c.code, -1) AS INTEGER) AS smoking_history
FROM patients_dirty t LEFT JOIN (SELECT v, DENSE_RANK() OVER (ORDER BY v) - 1 AS code
 FROM (SELECT DISTINCT smoking_history AS v FROM patients_dirty WHERE smoking_history IS NOT NULL)) c
 ON t.smoking_history = c.v""", "patients_dirty"))
def q_factorize(spark, sf):
    """Integer code per distinct value in sorted order, null -> -1."""
    from ..operators.profile import factorize
    d = patients_dirty(spark, sf).select(*KEY, "smoking_history")
    return factorize(d, "smoking_history")


@register("presplit_filter", with_views(f"""
SELECT {KEYS_SQL}, diabetes, split AS side FROM (
 SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY diabetes ORDER BY {_hash_sql('split')})
      <= ROUND(COUNT(*) OVER (PARTITION BY diabetes) * 0.2) THEN 'test' ELSE 'train' END AS split
 FROM patients)""", "patients"))
def q_presplit(spark, sf):
    """An existing split column: both sides, split column dropped from each."""
    p = patients(spark, sf).select(*KEY, "diabetes")
    train, test = split.presplit(split.stratified_split(p, "diabetes", KEY), "diabetes")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@register("recombine", with_views(f"""
SELECT {KEYS_SQL}, diabetes, split, COUNT(*) OVER (PARTITION BY split) AS n_side FROM (
 SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY diabetes ORDER BY {_hash_sql('split')})
      <= ROUND(COUNT(*) OVER (PARTITION BY diabetes) * 0.2) THEN 'test' ELSE 'train' END AS split
 FROM patients)""", "patients"))
def q_recombine(spark, sf):
    """Train and test sides tagged and stacked again (unionByName)."""
    p = patients(spark, sf).select(*KEY, "diabetes")
    train, test = split.presplit(split.stratified_split(p, "diabetes", KEY), "diabetes")
    r = split.recombine(train, test)
    sides = r.groupBy("split").agg(F.count(F.lit(1)).alias("n_side"))  # two rows
    return r.join(F.broadcast(sides), "split").select(*r.columns, "n_side")


@register("balanced_weights", with_views("""
SELECT diabetes, COUNT(*) AS n, ROUND(SUM(COUNT(*)) OVER () / (2.0 * COUNT(*)), 6) AS weight
FROM patients GROUP BY diabetes""", "patients"))
def q_weights(spark, sf):
    """class_weight='balanced': n / (classes * n_c) per class."""
    from ..operators.models import balanced_weights
    w = balanced_weights(patients(spark, sf), "diabetes")
    return round_all(w.groupBy("diabetes").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight")))
