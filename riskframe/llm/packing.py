"""Harmonic packing of tokenised documents into sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from .bpe import encoded
from .common import by_bytes, saved

#: Pieces a bin holds, by class.  Class j takes pieces of up to capacity / j
#: ids; up to 32 the capacity divides evenly and cuts make pieces fill it.
COUNTS = (1, 2, 4, 8, 16, 32, 36, 42, 51, 64, 85, 128, 256)


def cuts(length: int, capacity: int, counts: tuple[int, ...] = COUNTS) -> list[tuple[int, int, int]]:
    """(start, length, class) of a document's pieces: whole sequences, then
    of the rest the largest capacity / j that divide evenly, then the tail in
    the class of most pieces a bin that it fits."""
    out, at = [], 0
    for j in counts:
        size = capacity // j
        if capacity % j or j > 32:
            break
        while length - at >= size:
            out.append((at, size, j))
            at += size
    if at < length:
        out.append((at, length - at, max(j for j in counts if capacity // j >= length - at)))
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 0,
                   counts: tuple[int, ...] = COUNTS, rows_per_bucket: int = 50000) -> DataFrame:
    """Every document's ids (and ``end_id``) cut into pieces, one row per piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The pieces of class j are numbered by hashed buckets in parallel, and each
    j of them make one sequence.  Less than j are left over per class, a
    number that does not depend on the input; these few are packed next-fit
    in descending length.  Sequences are numbered from 0 without gaps.

    Null and empty texts are one piece of ``end_id`` alone.  Rows repeated
    under one doc_id are packed each.  An empty table gives an empty result;
    other columns are not read.
    """
    kind = StructType([StructField("doc_id", docs.schema["doc_id"].dataType),
                       *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "per_bin"))])
    arrow = to_arrow_schema(kind)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, t) for b in by_bytes(batches) for k, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                                                        strict=True))
        out: list[tuple] = []
        for key, ids in encoded(rows, path):
            raw = ids.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
            total = len(raw) // 4
            for at, n, j in cuts(total, capacity, counts):
                out.append((key, at, n, zlib.crc32(raw[4 * at:4 * (at + n)]), total, j))
            if len(out) > 20000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow,
                                                                                        strict=True)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow,
                                                                                    strict=True)], schema=arrow)

    cut = saved(docs.select("doc_id", "text").mapInArrow(pieces, kind))
    totals = {r["per_bin"]: r["n"] for r in cut.groupBy("per_bin").agg(F.count("*").alias("n")).collect()}
    buckets = max(16, math.ceil(sum(totals.values()) / rows_per_bucket))
    even_most = max([0, *[j for j in counts if j <= 32 and capacity % j == 0][:-1]])
    first, at = {}, 0
    for j in sorted(totals):
        first[j] = at
        at += totals[j] // j
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counted = rows.groupBy("per_bin", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("per_bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("per_bin", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("per_bin", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    ranked = rows.withColumn("_rank", rank - 1).join(offsets, ["per_bin", "bucket"]).withColumn(
        "_rank", F.col("_rank") + F.col("_before"))
    base, full = F.lit(0), F.lit(0)
    for j in totals:
        base = F.when(F.col("per_bin") == j, F.lit(first[j])).otherwise(base)
        full = F.when(F.col("per_bin") == j, F.lit(totals[j] // j * j)).otherwise(full)
    ranked = saved(ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "per_bin", "_rank",
                                 (F.col("_rank") >= full).alias("_left"),
                                 (base + F.floor(F.col("_rank") / F.col("per_bin"))).cast("long").alias("sequence_id")))
    whole = ranked.where(~F.col("_left"))
    even = F.col("per_bin") <= even_most  # all their pieces have one length
    exact = whole.where(even).withColumn(
        "offset", (F.col("_rank") % F.col("per_bin") * F.col("length")).cast("long"))
    earlier = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    tails = whole.where(~even).withColumn(
        "offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def fill(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "per_bin", "_rank"], ascending=[False, True, True])
        bin_no, room, ids, offs = at - 1, 0, [], []
        for n in left["length"].tolist():
            if n > room:
                bin_no, room = bin_no + 1, capacity
            ids.append(bin_no)
            offs.append(capacity - room)
            room -= n
        return left.assign(sequence_id=ids, offset=offs)[names]

    out = StructType([*kind.fields[:5], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    rest = ranked.where("_left").groupBy("_left").applyInPandas(fill, out)
    return exact.select(names).unionByName(tails.select(names)).unionByName(rest.select(names))
