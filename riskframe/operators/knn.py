"""Exact k nearest neighbours (Euclidean) for the rebalancing operators (§2.7).

Result: for every query row, the ``k`` nearest *other* rows ordered by
(squared distance, neighbour key) - ties included exactly as brute force.

Plan, chosen so that no pair table and no unbounded group ever exists:

1. **Collapse** identical feature vectors to one weighted, numbered point (a
   grouped count with map-side combine).  A vector held by a third of all rows
   becomes one row; its rows' neighbours among themselves are the smallest
   keys of that vector (kept per vector by a salted two-level top-k).
2. **Leaves**: a k-d tree of median splits, grown on the driver from a
   bounded sample, deals the distinct vectors to leaves of about
   ``slab_rows``; each leaf's tight box comes from all its vectors.
3. **Phase 1**: each query vector finds its nearest vectors inside its home
   leaf (``cogroup`` + ``applyInPandas``; numpy, a small k-d tree of the group
   leaves out what lies too far) - an upper bound ``r`` on its final radius.  Where the leaf holds too few, ``r`` is the
   farthest corner of the nearest boxes that together hold enough.
4. **Phase 2**: the query is sent only to the other leaves whose box lies
   within ``r`` in all features.  Groups are cut by hash to GROUP_ROWS
   queries and candidates.
5. **Merge** per query vector, expand vectors to keys, rank.

Rows need a unique key and non-null features.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved, workers_import

#: Leaves at most: bounds the broadcast tree and boxes.  Beyond, leaves grow and
#: their rows are searched in groups of GROUP_ROWS queries and candidates.
MAX_LEAVES = 4096
GROUP_ROWS = 65_536
#: Vectors a leaf; small inputs get up to FEW_LEAVES leaves of at least 1 024, so that all cores have work.
SLAB_ROWS = 16_384
FEW_LEAVES = 64
#: Vectors a leaf of the small tree inside a group.
INNER_ROWS = 64
#: Vectors the tree is grown from, at most.
SAMPLE = 131_072
CAND_SCHEMA = "qvid long, cvid long, d2 double, m long, need long, r2 double, summary boolean"


def _block_fn(features, k: int, radius: bool, max_cells: int = 4_000_000):
    """In-leaf search: for each query vector, candidate vectors up to the
    distance where their weights first cover ``need`` (boundary ties kept).

    The candidates form a small k-d tree.  The queries of one of its leaves get
    an upper bound from that leaf, and are compared with the candidates of the
    leaves whose boxes lie within it."""

    def frame(parts) -> pd.DataFrame:
        kinds = (np.int64, np.int64, np.float64, np.int64, np.int64, np.float64, bool)
        names = ("qvid", "cvid", "d2", "m", "need", "r2", "summary")
        return pd.DataFrame({n: np.concatenate([np.empty(0, t), *[p[i] for p in parts]]).astype(t)
                             for i, (n, t) in enumerate(zip(names, kinds))})

    def rows(qv, need, cv=None, d2=None, m=None, r2=None):
        n = len(qv)
        if cv is None:  # the summary of a query: its bound, no neighbour
            return (qv, np.full(n, -1), np.full(n, np.nan), np.zeros(n, np.int64), need, r2, np.ones(n, bool))
        return (qv, cv, d2, m, need, np.full(n, np.nan), np.zeros(n, bool))

    def distances(x, y, xv, yv):
        # sequential sum over features: same rounding as a left-to-right SQL sum
        d = (x[:, 0, None] - y[None, :, 0]) ** 2
        for j in range(1, x.shape[1]):
            d += (x[:, j, None] - y[None, :, j]) ** 2
        d[xv[:, None] == yv[None, :]] = np.inf
        return d

    def bound(d, m, need):
        """The distance where the weights first cover ``need``; inf where they do not."""
        nc = d.shape[1]
        # only the `need` (<= k) nearest matter: partial selection, then a tiny sort
        kk = int(min(nc, max(1, need.max())))
        part = np.argpartition(d, kk - 1, axis=1)[:, :kk] if kk < nc else np.tile(np.arange(nc), (len(d), 1))
        dp = np.take_along_axis(d, part, axis=1)
        order = np.argsort(dp, axis=1, kind="stable")
        ds = np.take_along_axis(dp, order, axis=1)
        ms = np.where(np.isfinite(ds), m[np.take_along_axis(part, order, axis=1)], 0)
        reach = np.cumsum(ms, axis=1) >= need[:, None]
        return np.where(reach.any(axis=1), ds[np.arange(len(d)), reach.argmax(axis=1)], np.inf)

    def fn(qdf: pd.DataFrame, cdf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty:
            return frame([])
        qv, need = qdf["vid"].to_numpy(np.int64), qdf["need"].to_numpy(np.int64)
        if cdf.empty:
            return frame([] if radius else [rows(qv, need, r2=np.full(len(qv), np.inf))])
        xq, xc = qdf[features].to_numpy(np.float64), cdf[features].to_numpy(np.float64)
        tree = _kd_tree(xc, -(-len(xc) // INNER_ROWS))
        leaf = _leaf_of(tree, xc)
        order = np.argsort(leaf, kind="stable")
        xc, cv, cm = xc[order], cdf["vid"].to_numpy(np.int64)[order], cdf["m"].to_numpy(np.int64)[order]
        number, first = np.unique(leaf[order], return_index=True)
        last = np.append(first[1:], len(xc))
        low, high = np.minimum.reduceat(xc, first), np.maximum.reduceat(xc, first)
        weight = np.add.reduceat(cm, first)
        home = np.searchsorted(number, _leaf_of(tree, xq))  # every leaf holds a candidate: it was grown from them
        order = np.argsort(home, kind="stable")
        xq, qv, need, home = xq[order], qv[order], need[order], home[order]
        centre = (xc.min(axis=0) + xc.max(axis=0)) / 2
        slack = 1e-12 * (((xc - centre) ** 2).sum(axis=1).max() + ((xq - centre) ** 2).sum(axis=1).max())
        given = qdf["r2"].to_numpy(np.float64)[order] if radius else np.full(len(qv), np.inf)
        starts = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
        parts = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(qv)]):
            at = home[a]
            for s in range(a, b, 4 * INNER_ROWS):
                e = min(b, s + 4 * INNER_ROWS)
                x, v, n = xq[s:e], qv[s:e], need[s:e]
                own = slice(first[at], min(last[at], first[at] + 4096))
                r2 = np.minimum(given[s:e], bound(distances(x, xc[own], v, cv[own]), cm[own], n))
                open_end = np.flatnonzero(~np.isfinite(r2))
                if len(open_end):  # a query's own vector has a weight of k at most
                    r2[open_end] = _covering_radius(x[open_end], low, high, weight[None, :], n[open_end] + k)
                limit = r2 * (1 + 1e-9) + 1e-12
                near = np.flatnonzero(_box_distances_between(x.min(axis=0), x.max(axis=0), low, high) <= limit.max())
                near = near[(_box_distances(x, low[near], high[near], False) <= limit[:, None]).any(axis=0)]
                if not len(near):
                    if not radius:
                        parts.append(rows(v, n, r2=np.full(e - s, np.inf)))
                    continue
                pick = np.concatenate([np.arange(first[i], last[i]) for i in near])
                step = max(1, max_cells // len(pick))
                for t in range(0, e - s, step):
                    u = slice(t, min(e - s, t + step))
                    # a matrix product finds the pairs that may lie within the limit; their distances are then exact
                    y = xc[pick]
                    about = (x[u] - centre) @ (-2 * (y - centre)).T
                    about += ((x[u] - centre) ** 2).sum(axis=1)[:, None]
                    about += ((y - centre) ** 2).sum(axis=1)[None, :] - slack
                    qi, ci = np.nonzero(about <= limit[u, None])
                    ci = pick[ci]
                    apart = v[u][qi] != cv[ci]
                    qi, ci = qi[apart], ci[apart]
                    d = (x[u][qi, 0] - xc[ci, 0]) ** 2
                    for f in range(1, x.shape[1]):
                        d += (x[u][qi, f] - xc[ci, f]) ** 2
                    if radius:
                        qi, ci, d = (z[d <= given[s:e][u][qi]] for z in (qi, ci, d))
                    by = np.lexsort((d, qi))
                    qi, ci, d = qi[by], ci[by], d[by]
                    total = np.cumsum(cm[ci])
                    here = np.searchsorted(qi, qi)  # where the query's pairs begin
                    covers = total - total[here] + cm[ci[here]] >= n[u][qi]
                    dstar = np.full(u.stop - u.start, np.inf)
                    np.minimum.at(dstar, qi[covers], d[covers])
                    stay = d <= dstar[qi]
                    qi, ci, d = qi[stay], ci[stay], d[stay]
                    parts.append(rows(v[u][qi], n[u][qi], cv[ci], d, cm[ci]))
                    if not radius:
                        parts.append(rows(v[u], n[u], r2=dstar))
        return frame(parts)

    return fn


def _kd_tree(sample: np.ndarray, leaves: int) -> dict:
    """Median splits of a sample on the widest feature, down to ``leaves``
    leaves: arrays feature (-1 at a leaf), threshold, left, right, leaf."""
    nodes: list[list] = []

    def grow(x: np.ndarray, n: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0])
        spread = x.std(axis=0) if len(x) else np.zeros(sample.shape[1])
        f = int(np.argmax(spread))
        if n < 2 or len(x) < 2 or spread[f] == 0:
            return at
        cut = float(np.median(x[:, f]))
        if not (x[:, f] > cut).any():  # the median is the largest value: split below it
            cut = float(x[x[:, f] < cut, f].max())
        right = x[:, f] > cut
        nodes[at][:2] = f, cut
        nodes[at][2] = grow(x[~right], n // 2)
        nodes[at][3] = grow(x[right], n - n // 2)
        return at

    grow(sample, leaves)
    count = 0
    for node in nodes:
        if node[0] < 0:
            node[4], count = count, count + 1
    cols = list(zip(*nodes))
    return {"feature": np.array(cols[0]), "cut": np.array(cols[1]), "left": np.array(cols[2]),
            "right": np.array(cols[3]), "leaf": np.array(cols[4])}


def _leaf_of(tree: dict, x: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while True:
        f = tree["feature"][node]
        inner = f >= 0
        if not inner.any():
            return tree["leaf"][node]
        go = x[rows, np.maximum(f, 0)] > tree["cut"][node]
        node = np.where(inner, np.where(go, tree["right"][node], tree["left"][node]), node)


def _box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray, far: bool) -> np.ndarray:
    """Squared distance of each point to each box: the nearest point, or the farthest corner."""
    out = np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        below, above = low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]
        step = np.maximum(np.abs(below), np.abs(above)) if far else np.maximum(np.maximum(below, above), 0)
        out += step * step
    return out


def _box_distances_between(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distance of one box to each of others."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return (gap * gap).sum(axis=1)


def _covering_radius(x: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Squared farthest corner of the nearest whole boxes that hold ``need``; inf where all do not."""
    far = _box_distances(x, low, high, True)
    order = np.argsort(far, axis=1)
    total = np.cumsum(np.take_along_axis(np.broadcast_to(weight, far.shape), order, 1), axis=1)
    has = total >= need[:, None]
    at = np.take_along_axis(order, has.argmax(axis=1)[:, None], 1)
    return np.where(has.any(axis=1), np.take_along_axis(far, at, 1)[:, 0] * (1 + 1e-9) + 1e-12, np.inf)


def knn(df: DataFrame, features, key: str, k: int = 5, query_col: str | None = None,
        slab_rows: int = SLAB_ROWS, salt: int = 256) -> DataFrame:
    """(q_key, rank, n_key, d2) - the ``k`` nearest other rows of each query row.

    ``query_col`` marks query rows (boolean); the candidates are all rows.
    """
    spark = df.sparkSession
    workers_import(spark)
    feats = list(features)
    fcols = [F.col(f"`{c}`").cast("double").alias(c) for c in feats]
    is_q = F.col(query_col).cast("boolean") if query_col else F.lit(True)
    rows = df.select(F.col(key).cast("string").alias("key"), *fcols, is_q.alias("is_q"))

    # 1. distinct vectors with multiplicity, numbered; smallest k+1 keys per vector
    vec = saved(rows.groupBy(*feats).agg(
        F.count(F.lit(1)).alias("m"), F.count_if("is_q").alias("mq"), F.min("key").alias("key")).withColumn(
        "vid", F.monotonically_increasing_id()))
    unset = [F.col(c).isNull() | F.isnan(c) for c in feats]
    if vec.where(functools.reduce(lambda a, b: a | b, unset)).limit(1).count():
        raise ValueError("k-NN needs features without nulls or NaN: impute them first")
    single = vec.where("m = 1")
    several = saved(rows.join(vec.where("m > 1").select(*feats, "vid"), feats).select("vid", "key", "is_q"))
    salted = several.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salt)))
    t1 = salted.withColumn("rn", F.row_number().over(Window.partitionBy("vid", "salt").orderBy("key"))) \
        .filter(F.col("rn") <= k + 1)
    top = t1.withColumn("rn", F.row_number().over(Window.partitionBy("vid").orderBy("key"))) \
        .filter(F.col("rn") <= k + 1).select("vid", F.col("key").alias("nkey"))
    top = top.unionByName(single.select("vid", F.col("key").alias("nkey")))

    # 2. leaves of a k-d tree over a bounded sample, with tight boxes over all vectors
    n_vec = vec.count()
    leaves = min(MAX_LEAVES, max(1, -(-n_vec // slab_rows), min(FEW_LEAVES, n_vec // 1024)))
    sample = vec.select(*feats).orderBy(F.xxhash64("vid")).limit(min(SAMPLE, 32 * leaves)).toPandas()
    tree = spark.sparkContext.broadcast(_kd_tree(sample.to_numpy(np.float64).reshape(-1, len(feats)), leaves))

    def assign(it):
        for pdf in it:
            yield pdf.assign(slab=_leaf_of(tree.value, pdf[feats].to_numpy(np.float64)).astype(np.int32))

    columns = ["vid", *feats, "m", "mq"]
    vec_s = saved(vec.select(*columns).mapInPandas(
        assign, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vec.select(*columns).schema) + ", slab int"))
    boxes = vec_s.groupBy("slab").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m").alias("weight"), F.count_if(F.col("mq") > 0).alias("nq"),
        F.array(*[F.min(c) for c in feats]).alias("low"), F.array(*[F.max(c) for c in feats]).alias("high"))
    boxes = boxes.orderBy("slab").toPandas()  # at most MAX_LEAVES rows
    box = spark.sparkContext.broadcast({
        "slab": boxes["slab"].to_numpy(np.int32), "weight": boxes["weight"].to_numpy(np.int64),
        "low": np.array(boxes["low"].tolist()).reshape(-1, len(feats)),
        "high": np.array(boxes["high"].tolist()).reshape(-1, len(feats))})
    cands = vec_s.select("slab", "vid", *feats, "m")
    queries = vec_s.filter(F.col("mq") > 0).withColumn(
        "need", (F.lit(k) - F.least(F.lit(k), F.col("m") - 1)).cast("long"))
    active = queries.filter(F.col("need") > 0)

    def search(q, per_slab, radius):
        """Groups of at most about GROUP_ROWS queries and as many candidates."""
        parts = spark.createDataFrame(
            [(int(b.slab), max(1, -(-int(per_slab.get(b.slab, 0)) // GROUP_ROWS)), max(1, -(-int(b.n) // GROUP_ROWS)))
             for b in boxes.itertuples()], "slab int, q_parts int, c_parts int")  # at most MAX_LEAVES rows
        spread = F.xxhash64("vid")
        qs = q.join(F.broadcast(parts), "slab").withColumn("qp", F.pmod(spread, F.col("q_parts")).cast("int")).withColumn(
            "cp", F.explode(F.sequence(F.lit(0), F.col("c_parts") - 1))).select("slab", "qp", "cp", "vid", *feats, "need", "r2")
        cs = cands.join(F.broadcast(parts), "slab").withColumn("cp", F.pmod(spread, F.col("c_parts")).cast("int")).withColumn(
            "qp", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1))).select("slab", "qp", "cp", "vid", *feats, "m")
        qs = qs.toDF(*qs.columns)  # fresh attribute ids: both cogroup sides come from `vec`
        return qs.groupBy("slab", "qp", "cp").cogroup(cs.groupBy("slab", "qp", "cp")).applyInPandas(
            _block_fn(feats, k, radius), CAND_SCHEMA)

    # 3. phase 1: home leaf
    out1 = saved(search(active.withColumn("r2", F.lit(None).cast("double")),
                        dict(zip(boxes["slab"], boxes["nq"])), False))
    summary = out1.filter("summary").groupBy(F.col("qvid").alias("vid")).agg(F.min("r2").alias("r2"))

    # 4. phase 2: other leaves whose box lies within the radius
    def reach(it):
        b = box.value
        for pdf in it:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at:at + 512].reset_index(drop=True)
                x, r2 = part[feats].to_numpy(np.float64), part["r2"].to_numpy(np.float64).copy()
                home, need = part["slab"].to_numpy(), part["need"].to_numpy()
                open_end = np.flatnonzero(~np.isfinite(r2))
                if len(open_end):  # the home leaf had too few: the nearest whole boxes that hold enough
                    weight = b["weight"][None, :] - np.where(
                        b["slab"][None, :] == home[open_end, None], part["m"].to_numpy()[open_end, None], 0)
                    r2[open_end] = _covering_radius(x[open_end], b["low"], b["high"], weight, need[open_end])
                near = _box_distances(x, b["low"], b["high"], False) <= (r2 * (1 + 1e-9) + 1e-12)[:, None]
                near &= b["slab"][None, :] != home[:, None]
                i, j = np.nonzero(near)
                yield part.iloc[i][["vid", *feats, "need"]].assign(r2=r2[i], slab=b["slab"][j])

    q2 = active.select("vid", *feats, "need", "m", "slab").join(summary, "vid")
    q2 = saved(q2.mapInPandas(reach, "vid long, " + ", ".join(f"`{c}` double" for c in feats)
                              + ", need long, r2 double, slab int"))
    out2 = search(q2, {r["slab"]: r["n"] for r in q2.groupBy("slab").agg(F.count(F.lit(1)).alias("n")).collect()}, True)

    # 5. merge per query vector: keep distances up to where weights cover `need`
    found = out1.filter(~F.col("summary")).unionByName(out2).select("qvid", "cvid", "d2", "m", "need")
    wq = Window.partitionBy("qvid").orderBy("d2").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("cum", F.sum("m").over(wq))
    found = found.withColumn("dstar", F.min(F.when(F.col("cum") >= F.col("need"), F.col("d2")))
                             .over(Window.partitionBy("qvid")))
    kept = found.filter(F.col("dstar").isNull() | (F.col("d2") <= F.col("dstar"))).select("qvid", "cvid", "d2")

    # expand vectors to keys: own duplicates at distance 0, then neighbour vectors
    others = kept.join(top.withColumnRenamed("vid", "cvid"), "cvid").select("qvid", "nkey", "d2")
    own = top.select(F.col("vid").alias("qvid"), "nkey", F.lit(0.0).alias("d2"))
    cand_keys = others.unionByName(own)
    qk = several.filter("is_q").unionByName(single.filter("mq = 1").select("vid", "key", F.lit(True).alias("is_q")))
    qk = qk.select(F.col("key").alias("q_key"), F.col("vid").alias("qvid"))
    j = qk.join(cand_keys, "qvid").filter(F.col("nkey") != F.col("q_key"))
    w = Window.partitionBy("q_key").orderBy("d2", "nkey")
    res = j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return res.select("q_key", "rank", F.col("nkey").alias("n_key"), "d2")


def knn_bruteforce(df: DataFrame, features, key: str, k: int = 5, query_col: str | None = None) -> pd.DataFrame:
    """Reference result on a small frame, computed on the driver (tests only)."""
    pdf = df.select(F.col(key).cast("string").alias("key"),
                    *[F.col(c).cast("double").alias(c) for c in features],
                    (F.col(query_col).cast("boolean") if query_col else F.lit(True)).alias("is_q")).toPandas()
    X = pdf[list(features)].to_numpy(np.float64)
    keys = pdf["key"].to_numpy()
    out = []
    for i in np.nonzero(pdf["is_q"].to_numpy())[0]:
        d = (X[i, 0] - X[:, 0]) ** 2
        for j in range(1, X.shape[1]):
            d = d + (X[i, j] - X[:, j]) ** 2
        cand = [(d[t], keys[t]) for t in range(len(keys)) if t != i]
        cand.sort()
        for r, (dd, kk) in enumerate(cand[:k], start=1):
            out.append((keys[i], r, kk, dd))
    return pd.DataFrame(out, columns=["q_key", "rank", "n_key", "d2"])
