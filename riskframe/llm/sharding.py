"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import filled

#: A tree: {region: {rack: {shard: weight}}}.
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(shards: int, per_rack: int = 2, racks: int = 2, first: int = 8) -> Tree:
    """The first ``first`` shards in full regions of ``racks`` x ``per_rack``,
    each later shard as a region of its own.  A tree with one more shard thus
    only gains a subtree; no other weight changes at any level."""
    tree: Tree = {}
    for s in range(shards):
        region = s // (per_rack * racks) if s < first else s
        rack = s // per_rack if s < first else s
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def _draw(key: Column, node: str, weight: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from the hash of key and node: the
    smallest draw among siblings is theirs in proportion to the weights, and
    a changed weight changes no sibling's draw."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{node}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))


def _choose(key: Column, nodes: dict[str, float]) -> Column:
    names = list(nodes)
    if len(names) == 1:
        return F.lit(names[0])
    return F.least(*[F.struct(_draw(key, n, w).alias("d"), F.lit(n).alias("n")) for n, w in nodes.items()])["n"]


def place(key: Column, tree: Tree) -> Column:
    """The shard of ``key`` by descending the tree; weights of inner nodes are
    the sums below them, nodes without weight are left out."""
    def total(node):
        return sum(total(x) if isinstance(x, dict) else x for x in node.values())

    def descend(nodes: dict, level: str) -> Column:
        live = {n: c for n, c in nodes.items() if (total(c) if isinstance(c, dict) else c) > 0}
        if not live:
            raise ValueError(f"no weight at {level}")
        named = {f"{level}/{n}": c for n, c in live.items()}
        first = next(iter(live.values()))
        if not isinstance(first, dict):
            shard_of = {f"{level}/{n}": n for n in live}
            pick = _choose(key, named)
            if len(shard_of) == 1:
                return F.lit(next(iter(shard_of.values()))).cast("int")
            out = F.when(F.lit(False), F.lit(0))
            for path, n in shard_of.items():
                out = out.when(pick == path, F.lit(n))
            return out.cast("int")
        if len(named) == 1:
            path, child = next(iter(named.items()))
            return descend(child, path)
        pick = _choose(key, {p: total(c) for p, c in named.items()})
        out = F.when(F.lit(False), F.lit(0))
        for path, child in named.items():
            out = out.when(pick == path, descend(child, path))
        return out.cast("int")

    return descend(tree, "root")


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None, rows_per_bucket: int = 20000) -> DataFrame:
    """Per row of ``docs``: doc_id, size (UTF-8 bytes + 1, null: 1), text_crc32,
    law (``key``), shard, slot (gapless from 0 in its shard) and, with
    ``grown``, grown_shard.

    Only doc_id and the tree decide the shard: rows repeated under one doc_id
    go together, and null doc_ids are one key.  Slots follow (bucket, doc_id,
    text_crc32), buckets being hashes of the row, so that no task numbers a
    whole shard: counts per (shard, bucket) give the offsets.  An empty table
    gives an empty result; other columns are not read.
    """
    total = docs.select(F.lit(1)).count()
    buckets = max(64, math.ceil(total / rows_per_bucket))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = filled().cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), place(key, tree).alias("shard"),
                       (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = rows.withColumn("_rank", F.row_number().over(
        Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")))
    out = ranked.join(offsets, ["shard", "bucket"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard",
                      (F.col("offset") + F.col("_rank") - 1).cast("long").alias("slot"), "grown_shard")
