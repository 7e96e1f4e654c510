"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import nan_to_null

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan, NaN as null; projections and filters applied later reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
