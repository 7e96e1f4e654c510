"""Class rebalancing (§2.7): SMOTE, ADASYN, Tomek links, SMOTE+Tomek.

All randomness is ``md5(seed|key|copy|purpose)``, so a lost task recomputes
the same rows.  Synthetic rows are ``x + u * (x_nb - x)`` with ``x_nb`` one
of the ``k`` nearest same-class rows (exact, see ``knn``).  Synthetic keys
are ``<base key>#<copy>``.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_uniform, row_hash
from ..session import saved, scratch_tables
from .knn import SLAB_ROWS, knn
from .split import first_k_by_hash

STRATEGIES = ("smote", "adasyn", "tomek", "combined")


def _class_counts(df, label):
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


COPY_CHUNK = 4096  # synthetic rows made from one descriptor row after the spread


def _interpolate(base: DataFrame, nn: DataFrame, feats, key, label, k_avail: int, seed: int,
                 passthrough=(), max_copies: int | None = None) -> DataFrame:
    """base has (key, feats, label, passthrough, copies); one synthetic row per copy.

    Every base row first gets its (at most ``k``) neighbour vectors as a small
    array, so no join follows the explode and synthetic rows are never
    shuffled.  Copies are made in two steps: one descriptor row per chunk of
    ``COPY_CHUNK`` copies, spread over tasks by (key, chunk) when a row needs
    more than one chunk (a single minority row may have to produce a third
    of all rows), then the copies inside each chunk.
    """
    nbv = base.select(F.col(key).alias("n_key"), *[F.col(c).alias(f"nb__{c}") for c in feats])
    nbs = nn.select(F.col("q_key").alias(key), "rank", "n_key").join(nbv, "n_key") \
        .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", *[f"nb__{c}" for c in feats])))
                          .alias("__nbs"))  # <= k entries per key
    b = base.filter(F.col("copies") > 0).join(nbs, key)
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / F.lit(COPY_CHUNK)).cast("int")))
    ch = b.select(key, *feats, label, *passthrough, "copies", "__nbs", chunk.alias("__chunk"))
    if max_copies is None or max_copies > COPY_CHUNK:
        ch = ch.repartition(key, "__chunk")
    lo = F.col("__chunk") * F.lit(COPY_CHUNK)
    hi = F.least(F.col("copies"), lo + F.lit(COPY_CHUNK)) - 1
    ex = ch.select(key, *feats, label, *passthrough, "__nbs", F.explode(F.sequence(lo, hi)).alias("copy"))
    u_nb = hash_uniform(row_hash(seed, [key, "copy"], "nb"))
    u_gap = hash_uniform(row_hash(seed, [key, "copy"], "gap"))
    rank = (F.floor(u_nb * F.lit(k_avail)) + 1).cast("int")
    ex = ex.withColumn("__nb", F.filter("__nbs", lambda x: x["rank"] == rank)[0]).withColumn("gap", u_gap)
    out = [F.concat(F.col(key).cast("string"), F.lit("#"), F.col("copy").cast("string")).alias(key)]
    out += [(F.col(c) + F.col("gap") * (F.col("__nb")[f"nb__{c}"] - F.col(c))).alias(c) for c in feats]
    return ex.select(*out, label, *passthrough, F.lit(True).alias("synthetic"))


def smote(df: DataFrame, features, label: str, key: str, k: int = 5, seed: int = 42,
          passthrough=(), slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Oversample every non-majority class up to the majority count.

    Returns the original rows (``synthetic`` false) and the new rows; other
    columns in ``passthrough`` are copied from the base row.
    """
    feats = list(features)
    counts = _class_counts(df, label)
    n_max = max(counts.values())
    orig = df.select(F.col(key).cast("string").alias(key), *[F.col(c).cast("double").alias(c) for c in feats],
                     label, *passthrough, F.lit(False).alias("synthetic"))
    out = orig
    for cls, n_c in sorted(counts.items(), key=lambda kv: str(kv[0])):
        n_syn = n_max - n_c
        if n_syn == 0 or n_c < 2:
            continue
        rows = orig.filter(F.col(label) == F.lit(cls))
        q, rem = divmod(n_syn, n_c)
        flagged = first_k_by_hash(rows, label, [key], lambda n: F.lit(rem), seed, "smote", "__extra")
        base = flagged.withColumn("copies", F.lit(q) + F.col("__extra").cast("int")).drop("__extra")
        nn = knn(rows, feats, key, k, slab_rows=slab_rows)
        out = out.unionByName(_interpolate(base, nn, feats, key, label, min(k, n_c - 1), seed, passthrough,
                                           max_copies=q + (1 if rem else 0)))
    return out


def adasyn(df: DataFrame, features, label: str, key: str, k: int = 5, seed: int = 42,
           passthrough=(), slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Binary ADASYN: copies per minority row ~ share of other-class rows among
    its k nearest rows (all classes), rint-rounded; neighbours for the
    interpolation come from the minority class."""
    feats = list(features)
    counts = _class_counts(df, label)
    if len(counts) != 2:
        raise ValueError("adasyn needs exactly two classes")
    (c_min, n_min), (c_max, n_max) = sorted(counts.items(), key=lambda kv: (kv[1], str(kv[0])))
    orig = df.select(F.col(key).cast("string").alias(key), *[F.col(c).cast("double").alias(c) for c in feats],
                     label, *passthrough, F.lit(False).alias("synthetic"))
    g_total = n_max - n_min
    if g_total == 0:
        return orig
    is_min = (F.col(label) == F.lit(c_min)).alias("__q")
    with scratch_tables() as keep:
        nn_all = knn(orig.select(key, *feats, label, is_min), feats, key, k, query_col="__q", slab_rows=slab_rows)
        labels = orig.select(F.col(key).alias("n_key"), F.col(label).alias("__nl"))
        # share of other-class rows among the k neighbours, normalised over the
        # minority rows: (c / k) / sum(c / k) = c / sum(c) with c an integer
        # count, so the copies rint(c * G / sum c) do not depend on summation order
        ratio = nn_all.join(labels, "n_key").groupBy(F.col("q_key").alias(key)).agg(
            F.count_if(F.col("__nl") != F.lit(c_min)).alias("__c"))
        # read twice (its total, then the copies): written once, so the neighbour
        # search over all rows runs once; its tables go before the next search
        ratio = keep(saved(ratio))
    total = ratio.agg(F.sum("__c")).first()[0] or 0
    if total == 0:
        raise RuntimeError("no neighbour of the minority class belongs to the majority class")
    rows = orig.filter(F.col(label) == F.lit(c_min))
    base = rows.join(ratio, key).withColumn(
        "copies", F.bround(F.col("__c").cast("double") * F.lit(float(g_total)) / F.lit(float(total)), 0)
        .cast("int")).drop("__c")
    nn = knn(rows, feats, key, k, slab_rows=slab_rows)
    return orig.unionByName(_interpolate(base, nn, feats, key, label, min(k, n_min - 1), seed, passthrough,
                                         max_copies=g_total))


def tomek_links(df: DataFrame, features, label: str, key: str, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Pairs (a, b) that are each other's nearest row and differ in class."""
    # read twice by the join of mutual neighbours: written once
    with scratch_tables() as keep:
        nn = keep(saved(knn(df, features, key, 1, slab_rows=slab_rows).select("q_key", "n_key")))
    lab = df.select(F.col(key).cast("string").alias("k"), F.col(label).alias("l"))
    a = nn.alias("a")
    b = nn.select(F.col("q_key").alias("b_q"), F.col("n_key").alias("b_n"))
    mutual = a.join(b, (F.col("a.n_key") == F.col("b_q")) & (F.col("a.q_key") == F.col("b_n")))
    la = lab.select(F.col("k").alias("q_key"), F.col("l").alias("q_label"))
    lb = lab.select(F.col("k").alias("n_key"), F.col("l").alias("n_label"))
    return mutual.select("a.q_key", "a.n_key").join(la, "q_key").join(lb, "n_key") \
        .filter(F.col("q_label") != F.col("n_label")).select("q_key", "n_key", "q_label", "n_label")


def tomek(df: DataFrame, features, label: str, key: str, remove: str = "majority",
          slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Drop link members: ``majority`` (all but the minority class) or ``both``."""
    links = tomek_links(df, features, label, key, slab_rows)
    if remove == "both":
        drop = links.select(F.col("q_key").alias("__k"))
    else:
        counts = _class_counts(df, label)
        c_min = min(counts.items(), key=lambda kv: (kv[1], str(kv[0])))[0]
        drop = links.filter(F.col("q_label") != F.lit(c_min)).select(F.col("q_key").alias("__k"))
    return df.join(drop.distinct(), F.col(key).cast("string") == F.col("__k"), "left_anti")


def smote_tomek(df: DataFrame, features, label: str, key: str, k: int = 5, seed: int = 42,
                passthrough=(), slab_rows: int = SLAB_ROWS) -> DataFrame:
    """SMOTE, then remove both members of every Tomek link."""
    with scratch_tables() as keep:
        s = keep(saved(smote(df, features, label, key, k, seed, passthrough, slab_rows)))
    return tomek(s, features, label, key, remove="both", slab_rows=slab_rows)


def resample(df: DataFrame, strategy: str, features, label: str, key: str, k: int = 5, seed: int = 42,
             passthrough=(), slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Dispatch by name; unknown names raise."""
    s = strategy.lower()
    if s == "smote":
        return smote(df, features, label, key, k, seed, passthrough, slab_rows)
    if s == "adasyn":
        return adasyn(df, features, label, key, k, seed, passthrough, slab_rows)
    if s == "tomek":
        return tomek(df, features, label, key, "majority", slab_rows)
    if s == "combined":
        return smote_tomek(df, features, label, key, k, seed, passthrough, slab_rows)
    raise ValueError(f"strategy must be one of: {', '.join(STRATEGIES)}")


def resample_folds(df: DataFrame, strategy: str, features, label: str, key: str, fold_col: str = "fold",
                   k: int = 5, seed: int = 42, slab_rows: int = SLAB_ROWS, passthrough=(), each=None) -> DataFrame:
    """The train rows of every held-out fold, rebalanced without that fold: one
    frame with ``held_out``.  Class counts, neighbours and copies come from
    the other folds' rows alone.

    With ``each`` (frame -> frame) its result on every fold's rows is written
    instead, and the fold's tables are dropped before the next fold."""
    out = None
    for f in sorted(r[0] for r in df.select(fold_col).distinct().collect()):
        with scratch_tables() if each else contextlib.nullcontext() as keep:
            part = df.filter(F.col(fold_col) != f)
            part = resample(part if fold_col in passthrough else part.drop(fold_col), strategy, features, label, key, k, seed,
                            passthrough, slab_rows).withColumn("held_out", F.lit(f))
            part = keep(saved(each(part))) if each else part
        out = part if out is None else out.unionByName(part)
    return out


def split_and_resample(df: DataFrame, strategy: str, features, label: str, key: str,
                       test_size: float = 0.2, seed: int = 42, **kw) -> DataFrame:
    """Exact stratified split, resample the train rows only; one frame with ``split``."""
    from .split import stratified_split
    s = stratified_split(df, label, [key], test_size, seed)
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    rs = resample(train, strategy, features, label, key, seed=seed, **kw)
    cols = rs.columns
    test = test.select(F.col(key).cast("string").alias(key),
                       *[F.col(c).cast("double").alias(c) if c in features else F.col(c)
                         for c in cols if c not in (key, "synthetic")],
                       F.lit(False).alias("synthetic")) if "synthetic" in cols else test
    return rs.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")),
                                                              allowMissingColumns=True)
