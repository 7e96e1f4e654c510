"""Helpers shared by the corpus operators: scratch tables, bit filters, hot-key joins, components."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _CLEANUP, saved  # noqa: F401 - the operators take them from here

#: Bits of a bit filter: 2^26 bits are 8 MB, whatever the input.
FILTER_BITS = 1 << 26
_BUCKET = 32768


#: Python workers outlive their tasks and wait, several an executor, for the
#: next stages: what a task frees goes back to the system, and no single block
#: of memory is kept for later.  Settings of the session's own stay.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": str(4 << 20), "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Rows that go to a Python worker at once (Spark's own number is 10 000): whole texts are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def workers_import(spark: SparkSession) -> None:
    """Python workers on this machine find the package whatever the working
    folder; a cluster without a shared install gets it by ``--py-files``.
    They get texts in small batches and give back the memory they free."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def filled(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def hashed(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def bit_filter(df: DataFrame, *cols: str, bits: int = FILTER_BITS) -> DataFrame:
    """A bitmap of the hashed keys of ``df``: at most ``bits`` / 32 768 rows of
    4 KB, so it may be broadcast.  More keys only make it let more through."""
    h = F.pmod(hashed(*[F.col(c) for c in cols]), F.lit(bits))
    return (df.select(F.floor(h / _BUCKET).cast("long").alias("__filter_bucket"),
                      F.pmod(h, F.lit(_BUCKET)).alias("__filter_bit"))
            .groupBy("__filter_bucket").agg(F.bitmap_construct_agg("__filter_bit").alias("__filter_bits")))


def marked(df: DataFrame, bitmap: DataFrame, *cols: str, name: str = "_maybe",
           bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean column: False only if the key is surely not in the bitmap."""
    h = F.pmod(hashed(*[F.col(c) for c in cols]), F.lit(bits))
    out = (df.withColumn("__filter_bucket", F.floor(h / _BUCKET).cast("long"))
           .withColumn("__filter_bit", F.pmod(h, F.lit(_BUCKET)).cast("int"))
           .join(F.broadcast(bitmap), "__filter_bucket", "left"))
    byte = F.conv(F.hex(F.expr("substring(__filter_bits, __filter_bit div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("1 << (__filter_bit % 8)").bitwiseAND(byte) != 0
    return out.withColumn(name, F.coalesce(F.col("__filter_bits").isNotNull() & bit, F.lit(False))).drop(
        "__filter_bucket", "__filter_bit", "__filter_bits")


def maybe_in(df: DataFrame, bitmap: DataFrame, *cols: str, bits: int = FILTER_BITS) -> DataFrame:
    return marked(df, bitmap, *cols, bits=bits).where("_maybe").drop("_maybe")


def without_ids(docs: DataFrame, dropped: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``docs`` whose keys (doc_id by default) are not in ``dropped``;
    only rows that the bit filter cannot clear are shuffled."""
    keys = keys or ("doc_id",)
    names = [f"_gone_{i}" for i in range(len(keys))]
    gone = dropped.select(*[F.col(k).alias(name) for k, name in zip(keys, names, strict=True)]).distinct()
    both = marked(docs, bit_filter(gone, *names), *keys, name="_maybe")
    clear = both.where(~F.col("_maybe")).drop("_maybe")
    rest = both.where("_maybe").drop("_maybe")
    same = [rest[k].eqNullSafe(gone[name]) for k, name in zip(keys, names, strict=True)]
    return clear.unionByName(rest.join(gone, same, "left_anti"))


def only_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is in ``ids`` (distinct, one column ``key``)."""
    return maybe_in(docs, bit_filter(ids, key), key).join(ids, key, "left_semi")


def key_bits(keys: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A bitmap of the well-mixed long column ``key`` as bytes: at most
    ``bits`` / 32 768 rows of 4 KB reach the driver, whatever the input."""
    place = F.pmod(F.col("key"), F.lit(bits))
    rows = keys.select(F.floor(place / _BUCKET).cast("int").alias("bucket"), (place % _BUCKET).alias("bit")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = bytearray(bits // 8)
    for row in rows:
        out[row["bucket"] * 4096:row["bucket"] * 4096 + len(row["bits"])] = row["bits"]
    return bytes(out)


def has_bit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The keys whose bit is set."""
    place = keys & np.int64(8 * len(bitmap) - 1)
    return keys[(bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str,
           total: int, joins: Column | None = None) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per ``key``).

    Groups of more than a thousandth of ``total`` rows are at most 1 000 and
    are broadcast; their rows, and those where ``joins`` is false, get a
    random-like salt in the shuffle join, so that no key is hot there.
    """
    cols = [c for c in groups.columns if c != key]
    big = F.col(size) > F.lit(max(1, total // 1000))
    hot = groups.where(big).select(key, *[F.col(c).alias(f"_hot_{c}") for c in cols])
    cold = groups.where(~big).select(key, *[F.col(c).alias(f"_cold_{c}") for c in cols]).withColumn(
        "_salt", F.lit(0).cast("long"))
    out = rows.join(F.broadcast(hot), key, "left")
    away = F.col(f"_hot_{size}").isNotNull()
    if joins is not None:
        away = away | ~joins
    out = out.withColumn("_salt", F.when(away, F.pmod(hashed(F.col(spread)), F.lit(1 << 30)) + 1).otherwise(
        F.lit(0)).cast("long"))
    out = out.join(cold, [key, "_salt"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(f"_hot_{c}", f"_cold_{c}"))
    return out.drop("_salt", *[f"_hot_{c}" for c in cols], *[f"_cold_{c}" for c in cols])


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the undirected ``edges`` (a, b: long).

    Each round hooks every vertex to its smallest neighbour, jumps once more
    along these pointers, and contracts the edges; vertices should be hashes,
    whose random order makes the rounds logarithmic.  The root is one vertex
    of the component.
    """
    def plain(df):
        return df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    current, steps = saved(plain(edges.select("a", "b"))), []
    vertices = current.select(F.col("a").alias("v")).union(current.select("b")).distinct()
    while current.limit(1).count():
        near = (current.union(current.select("b", "a")).groupBy("a").agg(F.min("b").alias("b"))
                .select(F.col("a").alias("v"), F.least("a", "b").alias("p")))
        near = saved(near)
        up = near.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        near = saved(near.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p")))
        steps.append(near)
        a = near.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        b = near.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        current = saved(plain(current.join(a, "a").join(b, "b").select(
            F.col("pa").alias("a"), F.col("pb").alias("b"))))
    out = vertices.select("v", F.col("v").alias("root"))
    for step in steps:
        out = out.join(step.select(F.col("v").alias("root"), "p"), "root", "left").select(
            "v", F.coalesce("p", "root").alias("root"))
    return saved(out)


#: Text bytes that a worker turns into Python objects at once.
TEXT_BYTES = 4 << 20


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes, so that a
    worker's memory does not follow the length of the texts (a single row is
    never cut)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        start, size = 0, 0
        sizes = pa.compute.binary_length(col).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
