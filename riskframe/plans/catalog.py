"""Query catalog: name -> Spark job, and name -> oracle SQL.

Each Spark job takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  Floating outputs are rounded to 6 digits on both sides so
that value hashes do not depend on summation order.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import workers_import

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        @functools.wraps(fn)
        def run(spark, sf):
            workers_import(spark)
            return fn(spark, sf)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (q_features, q_profile, q_validate, q_clean, q_prepare,  # noqa: F401
                   q_evaluate, q_balance, q_models, q_io)
