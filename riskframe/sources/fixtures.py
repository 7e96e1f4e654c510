"""Patient-shaped views derived from the driver's ``lineitem`` table.

The reference works on one patient table; the views below give that
table's schema (and dirty / scored variants) over the driver's data, so
every job grows with ``lineitem``.  The formulas are the fixture
definitions; the SQL twins used by the oracle live in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
PATIENT_COLUMNS = KEY + ["gender", "age", "hypertension", "heart_disease", "smoking_history",
                         "bmi", "HbA1c_level", "blood_glucose_level", "diabetes"]


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


#: Rows of one task that looks for distinct keys.
KEYS_PER_TASK = 1_200_000


def distinct_keys(df: DataFrame, rows_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """Distinct rows of a table of keys.  Beyond ``rows_per_task`` rows they are
    spread by key first: a task then holds that many, and not the rows of a
    whole file split, as few of them repeat and a partial aggregate keeps all."""
    rows = df.count()  # from the footers of a Parquet table
    if rows > rows_per_task:
        df = df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task)), *df.columns)
    return df.distinct()


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean patient view: one row per distinct lineitem key, no nulls."""
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    keys = distinct_keys(table(spark, sf_dir, "lineitem").select(*KEY))
    smoking = (F.when(s % 6 == 0, "never").when(s % 6 == 1, "current")
               .when(s % 6 == 2, "former").when(s % 6 == 3, "not current")
               .when(s % 6 == 4, "ever").otherwise("No Info"))
    a1c_code = (p * 11 + s) % 56
    glucose_code = (o * 17 + s * 3) % 221
    return keys.select(
        *KEY,
        F.when(o % 1000 == 0, "Other").when(o % 5 < 3, "Female").otherwise("Male").alias("gender"),
        ((p * 7 + o) % 81).cast("double").alias("age"),
        _flag(o % 13 == 0).alias("hypertension"),
        _flag(p % 25 == 0).alias("heart_disease"),
        smoking.alias("smoking_history"),
        (F.lit(15.0) + ((o * 31 + p) % 300).cast("double") / F.lit(10.0)
         + F.when(o % 97 == 0, F.lit(40.0)).otherwise(F.lit(0.0))).alias("bmi"),
        (F.lit(3.5) + a1c_code.cast("double") / F.lit(10.0)).alias("HbA1c_level"),
        (F.lit(80.0) + glucose_code.cast("double")).alias("blood_glucose_level"),
        _flag((a1c_code > 38) & (glucose_code > 130)).alias("diabetes"),
    )


def patients_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients with nulls, out-of-domain values and duplicated rows."""
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    d = patients(spark, sf_dir).select(
        *KEY,
        F.when(o % 501 == 0, "Unknown").otherwise(F.col("gender")).alias("gender"),
        F.when(p % 401 == 0, F.lit(-1.0)).otherwise(F.col("age")).alias("age"),
        F.when(o % 29 == 0, F.lit(None)).otherwise(F.col("hypertension")).alias("hypertension"),
        F.when((s % 50 == 0) & (F.col("l_linenumber") == 1), F.lit(2))
         .otherwise(F.col("heart_disease")).alias("heart_disease"),
        F.when(o % 23 == 0, F.lit(None)).otherwise(F.col("smoking_history")).alias("smoking_history"),
        F.when(o % 19 == 0, F.lit(None)).otherwise(F.col("bmi")).alias("bmi"),
        "HbA1c_level", "blood_glucose_level", "diabetes",
    )
    return d.unionAll(d.filter(o % 50 == 0))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two score columns used as model outputs: (model, label, p1, prediction)."""
    pt = patients(spark, sf_dir)

    def one(model: str, p1: Column) -> DataFrame:
        return pt.select(*KEY, F.col("diabetes").alias("label"), F.lit(model).alias("model"),
                         p1.alias("p1"), _flag(p1 >= F.lit(0.7)).alias("prediction"))

    return one("a1c", F.col("HbA1c_level") / F.lit(10.0)).unionByName(
        one("glucose", F.col("blood_glucose_level") / F.lit(310.0)))
