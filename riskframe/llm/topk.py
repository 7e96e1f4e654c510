"""Exact top-k inner products by a three-phase uniform threshold over lists of partial scores."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SCALE = 1024
#: Rows and queries of a block: one task holds one of each and scores them.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(1024 * x) of each component, x as double.  Vectors
    null, empty, or holding null or non-finite components are left out, as are
    null ids."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(column).isNotNull() & (F.size(column) > 0) & finite).select(
        F.col(id_col).alias("vec_id"), F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))


def _matrix(rows) -> np.ndarray:
    return np.stack([np.asarray(r, np.int64) for r in rows])


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products: as doubles while their sums stay below 2^53."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, lists: int = 2) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products
    of each row of ``queries`` with the rows of ``vectors`` (vec_id, v), its
    own id left out; ties go to the smaller vec_id.

    Equal vectors are scored once, for at most k rows of each of their smallest
    ids, as many ids as hold 2 k such rows: k remain whichever id is left out.
    Equal rows of ``queries`` are asked once and answered each.  The
    coordinates are cut into ``lists``; a list holds, per query, the partial
    scores of all vectors, and each is shifted by its least, so that none is
    negative.  Phase 1: every block sends each list's k + 1 highest partial
    scores per query, and these vectors' whole scores give a k-th best that no
    answer can be below.  Phase 2: with that cutoff divided by the number of
    lists, every block sends the entries not below it; a vector with no such
    entry in any list stays below the cutoff.  Phase 3: vectors whose known
    entries and bounds still reach the cutoff are scored on all coordinates.

    All vectors must have one length.  Repeated ids are rows of their own; with
    fewer than k candidates all are returned; no rows give an empty result.
    """
    kinds = vectors.groupBy(F.xxhash64("v").alias("vk"), "v", "vec_id").agg(
        F.least(F.count("*"), F.lit(k)).alias("copies"))
    first = Window.partitionBy("vk", "v").orderBy("vec_id")
    before = F.coalesce(F.sum("copies").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ids = saved(kinds.withColumns({"nth": F.row_number().over(first), "before": before}).where(F.col("before") < 2 * k))
    # rep and ask number the distinct vectors and query rows; being written, the numbers are fixed
    distinct = saved(ids.where("nth = 1").select(F.monotonically_increasing_id().alias("rep"), "vk", "v"))
    members = saved(ids.select("vec_id", "copies", "vk", "v").join(distinct, ["vk", "v"]).select("rep", "vec_id", "copies"))
    distinct = distinct.drop("vk")
    asked = queries.groupBy(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).agg(F.count("*").alias("times"))
    asked = saved(asked.withColumn("ask", F.monotonically_increasing_id()))
    n, n_q = distinct.count(), asked.count()
    parts, q_parts = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(n_q / BLOCK_QUERIES))

    def blocks(more: DataFrame) -> tuple[DataFrame, DataFrame]:
        v = distinct.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int")).withColumn(
            "q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))))
        q = more.drop("query_id", "times").withColumn("q_part", F.pmod(F.xxhash64("ask"), F.lit(q_parts)).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return q, v

    def spans(d: int):
        edges = np.linspace(0, d, lists + 1).astype(int)
        return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))

    entry = "ask long, list int, rep long, partial long, least long"

    def local_lists(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame([], columns=[c.split()[0] for c in entry.split(", ")])
        a, b, rep = _matrix(q["q"]), _matrix(v["v"]), v["rep"].to_numpy()
        out = []
        for at in range(0, len(a), 256):
            for j, (x, y) in enumerate(spans(a.shape[1])):
                s = _scores(a[at:at + 256, x:y], b[:, x:y])
                most = min(k + 1, s.shape[1])
                best = np.argpartition(-s, most - 1, axis=1)[:, :most]
                qid = np.repeat(q["ask"].to_numpy()[at:at + 256], most)
                out.append(pd.DataFrame({"ask": qid, "list": j, "rep": rep[best].ravel(),
                                         "partial": np.take_along_axis(s, best, 1).ravel(),
                                         "least": np.repeat(s.min(axis=1), most)}))
        return pd.concat(out)

    q, v = blocks(asked)
    phase1 = saved(q.groupBy("part", "q_part").cogroup(v.groupBy("part", "q_part")).applyInPandas(local_lists, entry))
    least = phase1.groupBy("ask", "list").agg(F.min("least").alias("least"))
    shift = least.groupBy("ask").agg(F.sum("least").alias("shift"),
                                          F.map_from_entries(F.collect_list(F.struct("list", "least"))).alias("leasts"))
    in_list = Window.partitionBy("ask", "list").orderBy(F.desc("partial"), "rep")
    tops = phase1.withColumn("r", F.row_number().over(in_list)).where(F.col("r") <= k + 1)
    pairs = tops.select("ask", "rep").distinct()

    def scored(pairs: DataFrame) -> DataFrame:
        product = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0).cast("long"), lambda acc, x: acc + x)
        return pairs.join(distinct, "rep").join(asked, "ask").select("ask", "query_id", "times", "rep", product.alias("score"))

    def answers(exact: DataFrame) -> DataFrame:
        each = exact.join(members, "rep").where("vec_id <> query_id").withColumn(
            "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        by = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    known = saved(scored(pairs))
    cutoff = answers(known).groupBy("ask").agg(F.min("score").alias("kth"), F.count("*").alias("found"))
    cutoff = saved(shift.join(cutoff, "ask", "left").select(
        "ask", "leasts", F.when(F.col("found") >= k, F.col("kth")).alias("kth"), "shift"))
    enough = asked.join(cutoff, "ask")

    def sufficient(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame([], columns=["ask", "rep", "bound"])
        a, b, rep = _matrix(q["q"]), _matrix(v["v"]), v["rep"].to_numpy()
        queries, kth, shift = (q[c].to_numpy() for c in ("ask", "kth", "shift"))
        out = []
        for at in range(0, len(a), 256):
            part = slice(at, at + 256)
            # an answer scores kth or more; shifted, some list then has a lists-th of it
            open_end = np.isnan(kth[part].astype(float))
            need = np.where(open_end, -np.inf, (kth[part].astype(float) - shift[part]) / lists)
            bound, sent = np.zeros((len(a[part]), len(b))), np.zeros((len(a[part]), len(b)), bool)
            for j, (x, y) in enumerate(spans(a.shape[1])):
                low = np.array([dict(m)[j] for m in q["leasts"].iloc[part]], np.int64)
                s = _scores(a[part, x:y], b[:, x:y]) - low[:, None]
                on = s >= (need - 1e-6 - np.where(open_end, 0, 1e-12 * np.abs(kth[part].astype(float))))[:, None]
                sent |= on
                bound += np.where(on, s, need[:, None])
            i, c = np.nonzero(sent)
            out.append(pd.DataFrame({"ask": queries[part][i], "rep": rep[c], "bound": bound[i, c] + shift[part][i]}))
        return pd.concat(out)

    q, v = blocks(enough)
    phase2 = q.groupBy("part", "q_part").cogroup(v.groupBy("part", "q_part")).applyInPandas(
        sufficient, "ask long, rep long, bound double")
    open_pairs = phase2.join(cutoff.select("ask", "kth"), "ask").where(
        F.col("kth").isNull() | (F.col("bound") >= F.col("kth") - 1e-3 - F.abs("kth") * 1e-12)).select("ask", "rep")
    final = answers(scored(open_pairs)).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return final.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
