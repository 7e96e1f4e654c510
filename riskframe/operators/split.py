"""Exact stratified split and stratified folds without a per-class sort (§2.6).

Definition (both engines agree): inside each class, order rows by
``md5(seed|key|purpose)``; the first ``round(n_c * test_size)`` rows are the
test rows, and fold = (rank - 1) mod k.

A window partitioned by the class would sort each class in one task (two
tasks for a binary target).  Instead the leading ``bits`` of the hash form
buckets: one grouped count per (class, bucket) gives every bucket's offset,
so

* the split needs only the per-class boundary bucket and the one threshold
  hash inside it (a few rows reach the driver), then a projection;
* the folds rank rows inside (class, bucket) partitions (many small sorts)
  and add the bucket offset.

Keys must be unique (deduplicate first), as the hash order must be total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_bucket, row_hash

BITS = 20


def _hashed(df, keys, seed, purpose, bits):
    h = row_hash(seed, keys, purpose)
    return df.withColumn("__h", h).withColumn("__b", hash_bucket(F.col("__h"), bits))


def _bucket_counts(d, target):
    hist = d.groupBy(target, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(target).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    return hist.withColumn("__cum", F.sum("__n").over(w)) \
        .withColumn("__tot", F.sum("__n").over(Window.partitionBy(target)))


def first_k_by_hash(df: DataFrame, target: str, keys, k_of_class, seed: int = 42,
                    purpose: str = "split", flag_col: str = "__first", bits: int = BITS) -> DataFrame:
    """Flag the first ``k_of_class(n_c)`` rows of each class in md5 order.

    ``k_of_class`` maps a class-size Column to the wanted count Column.
    Exact, and no per-class sort: one bucket histogram, one boundary pass.
    """
    d = _hashed(df, keys, seed, purpose, bits)
    hist = _bucket_counts(d, target).withColumn("__k", k_of_class(F.col("__tot")).cast("long"))
    bound = hist.filter((F.col("__cum") - F.col("__n") < F.col("__k")) & (F.col("__cum") >= F.col("__k"))) \
        .select(target, "__b", (F.col("__k") - (F.col("__cum") - F.col("__n"))).alias("__need")).collect()
    if not bound:
        return d.withColumn(flag_col, F.lit(False)).drop("__h", "__b")
    # the need-th smallest hash inside each class's boundary bucket
    in_b = reduce(lambda a, b: a | b, [(F.col(target) == r[target]) & (F.col("__b") == r["__b"]) for r in bound])
    w = Window.partitionBy(target).orderBy("__h")
    need = F.create_map(*[x for r in bound for x in (F.lit(r[target]), F.lit(r["__need"]))])
    thr = d.filter(in_b).select(target, "__h").withColumn("__rn", F.row_number().over(w)) \
        .filter(F.col("__rn") == need[F.col(target)]).select(target, "__h").collect()
    t_hash = {t[target]: t["__h"] for t in thr}
    cond = F.lit(False)
    for r in bound:
        cond = cond | ((F.col(target) == r[target]) & (
            (F.col("__b") < r["__b"]) | ((F.col("__b") == r["__b"]) & (F.col("__h") <= t_hash[r[target]]))))
    return d.withColumn(flag_col, cond).drop("__h", "__b")


def stratified_split(df: DataFrame, target: str, keys, test_size: float = 0.2, seed: int = 42,
                     split_col: str = "split", bits: int = BITS) -> DataFrame:
    """Add ``split`` = 'test' / 'train' (exact per-class counts: round(n_c * test_size))."""
    d = first_k_by_hash(df, target, keys, lambda n: F.round(n * F.lit(test_size)), seed, "split", "__t", bits)
    return d.withColumn(split_col, F.when(F.col("__t"), F.lit("test")).otherwise(F.lit("train"))).drop("__t")


def stratified_folds(df: DataFrame, target: str, keys, k: int = 5, seed: int = 42,
                     fold_col: str = "fold", bits: int = BITS) -> DataFrame:
    """Add ``fold`` in 0..k-1: (rank in class by hash - 1) mod k."""
    d = _hashed(df, keys, seed, "fold", bits)
    offs = _bucket_counts(d, target).select(target, "__b", (F.col("__cum") - F.col("__n")).alias("__off"))
    j = d.join(offs, [target, "__b"])  # co-partitioned on (class, bucket) for the window below
    w = Window.partitionBy(target, "__b").orderBy("__h")
    rank = F.col("__off") + F.row_number().over(w)
    return j.withColumn(fold_col, ((rank - 1) % k).cast("int")).drop("__h", "__b", "__off")


def presplit(df: DataFrame, target: str, split_col: str = "split"):
    """Use an existing split column: (train, test) without it; errors as the reference."""
    if split_col not in df.columns:
        raise ValueError(f"column {split_col!r} not found")
    if target not in df.columns:
        raise ValueError(f"target {target!r} not found")
    counts = {r[split_col]: r["n"] for r in df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get("train") or not counts.get("test"):
        raise ValueError(f"empty side in {split_col}: {counts}")
    return (df.filter(F.col(split_col) == "train").drop(split_col),
            df.filter(F.col(split_col) == "test").drop(split_col))


def recombine(train: DataFrame, test: DataFrame, split_col: str = "split") -> DataFrame:
    """Tag and stack train and test (``unionByName``)."""
    return train.withColumn(split_col, F.lit("train")).unionByName(test.withColumn(split_col, F.lit("test")))
