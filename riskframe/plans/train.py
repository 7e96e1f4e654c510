"""Modelling data and flows: features -> preparation -> SMOTE on train -> folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..config import PATIENT_ROLES
from ..operators import balance as B
from ..operators.features import feature_transform
from ..operators.split import stratified_folds
from ..session import cut_lineage, saved, scratch_tables
from ..sources.fixtures import KEY, patients
from .prepare import process_data

TARGET = C.TARGET


#: Most rows of one task of a fit, and the fewest worth one.
MOST_ROWS, FEWEST_ROWS = 500_000, 10_000


def spread(df, key: str, rows: int):
    """Rows dealt evenly by ``key`` for a fit, which goes through them many
    times: to all cores, in tasks of a bounded number of rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = max(min(cores, rows // FEWEST_ROWS), -(-rows // MOST_ROWS))
    return df.repartition(n, key) if n > 1 else df


def modelling_data(spark, sf, balance: str | None = "smote", folds: int = C.N_FOLDS, dealt: bool = True):
    """(train, test, features): train rebalanced and carrying a ``fold`` column.

    Both frames are written once; every model, fold and evaluation job then
    starts from there, and the tables on the way are dropped.  Tree fits draw by
    partition and go through copies of the rows: for them the train rows are
    ``dealt`` evenly and checkpointed.  The logistic fit reads Parquet tables.
    """
    with scratch_tables() as keep:
        f = feature_transform(patients(spark, sf))
        prep = process_data(f, PATIENT_ROLES, KEY).data.withColumn("rid", F.md5(F.concat_ws("|", *KEY)))
        features = [c for c in prep.columns if c not in (*KEY, "rid", TARGET, "split")]
        train = prep.filter(F.col("split") == "train").select("rid", *features, TARGET)
        test = prep.filter(F.col("split") == "test").select("rid", *features, TARGET)
        if balance:
            train = B.resample(train, balance, features, TARGET, "rid", C.KNN_K, C.SEED)
            train = train.select("rid", *features, TARGET)
        if folds:
            train = stratified_folds(train, TARGET, ["rid"], folds, C.SEED)
        if not dealt:
            if folds and balance:  # the keys have dealt the folds
                train = train.drop("rid")
            return keep(saved(train)), keep(saved(test)), features
        return cut_lineage(spread(train, "rid", prep.count())), cut_lineage(test), features
