"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, bit_filter, filled, marked, saved

#: The white space that does not count: fixed values of the contract.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: str = "text") -> Column:
    return F.translate(filled(text), BLANKS, "")


def exact_dedup(docs: DataFrame, prefix_chars: int = 64, digest: bool = False, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, with
    ``digest`` text_sha256 of every normalised text, with ``keyed`` row_key, a
    hash of doc_id and text.

    Rows are first grouped by the byte length of their normalised text, then
    the rows of shared lengths by a hash of their first characters; the full
    hash is taken only of rows that still share both.  Of equal texts the row
    with most code points stays, then the smallest doc_id.

    A null text counts as empty.  A null doc_id comes after all others.  Rows
    repeated under one doc_id count in group_size and share their decision.
    An empty table gives an empty result; other columns are not read.
    """
    norm = normalised()
    rows = docs.select("doc_id", F.char_length(filled()).alias("n_points"), norm.alias("_norm")).select(
        "doc_id", "n_points", F.octet_length("_norm").alias("size"),
        F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("prefix"))
    keys = saved(rows.select("size", "prefix"))
    total = keys.count()
    lengths = keys.groupBy("size").count().where("count > 1")
    shared = marked(keys, bit_filter(lengths, "size"), "size").where("_maybe")
    prefixes = shared.groupBy("size", "prefix").count().where("count > 1")
    survivors = bit_filter(prefixes, "size", "prefix")

    full = docs.select("doc_id", F.char_length(filled()).alias("n_points"), norm.alias("_norm"),
                       F.xxhash64("doc_id", filled()).alias("row_key")).withColumns({
        "size": F.octet_length("_norm"), "prefix": F.xxhash64(F.substring("_norm", 1, prefix_chars))})
    full = marked(full, survivors, "size", "prefix", name="survives")
    sha = F.sha2("_norm", 256) if digest else F.when(F.col("survives"), F.sha2("_norm", 256))
    full = saved(full.select("doc_id", "n_points", "survives", "row_key", sha.alias("sha")))
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    groups = (full.where("survives").groupBy("sha").agg(F.count("*").alias("group_size"), best.alias("best"))
              .where("group_size > 1").select("sha", "group_size", F.col("best.doc_id").alias("keep_id")))
    out = attach(full, saved(groups), "sha", "group_size", "doc_id", total, joins=F.col("survives"))
    out = out.withColumns({"keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
                           "group_size": F.coalesce("group_size", F.lit(1)).cast("long")})
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return out.select("doc_id", "keep_id", "group_size", "kept", *([F.col("sha").alias("text_sha256")] if digest else []),
                      *(["row_key"] if keyed else []))


def drop_copies(docs: DataFrame, prefix_chars: int = 64) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep; of wholly
    repeated rows (doc_id and text) one stays.  Only rows of groups of two or
    more are shuffled."""
    decided = exact_dedup(docs, prefix_chars, keyed=True).where("group_size > 1").select(
        F.col("row_key").alias("_row"), "kept")
    decided = saved(decided.distinct())
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", filled()))
    both = marked(keyed, bit_filter(decided, "_row"), "_row", name="_copied")
    alone = both.where("not _copied").select(docs.columns)
    rest = both.where("_copied").drop("_copied").join(decided, "_row", "left").where("kept IS NULL OR kept")
    single = rest.where("kept IS NULL").select(docs.columns)
    return alone.unionByName(single).unionByName(rest.where("kept").dropDuplicates(["_row"]).select(docs.columns))
