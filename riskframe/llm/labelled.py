"""Splits and bounded training samples for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def remainder(mod: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def sample(docs: DataFrame, labels: DataFrame, grade: Column, held_out: Column, max_docs: int) -> DataFrame:
    """(text, grade) of at most ``max_docs`` labelled documents that are not
    held out, those of the smallest id hashes.  Rows without a grade do not
    count; of several labels of one id the largest does, and of several texts
    under one id the least."""
    known = (labels.select("doc_id", grade.alias("grade")).where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
             .where(~held_out).groupBy("doc_id").agg(F.max("grade").alias("grade")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("grade").alias("grade")).select("text", "grade")


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
