"""Profiling: summaries, counts, distributions, correlations (§2.3).

Every statistic of one operator is gathered in one aggregate (or one
grouped aggregate); only result-sized frames reach the driver, and only to
turn fitted numbers into literals for the next projection.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.exprs import safe_div


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def quantiles(c, probs, relative_error: float | None = None):
    """Exact linear-interpolated quantiles (pandas ``quantile``), or approximate ones.

    The exact form keeps one counter per distinct value in the final merge;
    pass ``relative_error`` for high-cardinality columns at scale.
    """
    c = F.col(c) if isinstance(c, str) else c
    if relative_error is None:
        return F.percentile(c, list(probs))
    return F.percentile_approx(c, list(probs), int(1.0 / relative_error))


def overview(df: DataFrame, target: str | None = None) -> DataFrame:
    """Row count and feature count (columns minus the target)."""
    n_feat = len(df.columns) - (1 if target and target in df.columns else 0)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_features", F.lit(n_feat))


def head(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k, not a physical head)."""
    keys = order_by or df.columns
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def _long(df_agg: DataFrame, columns: list, stats: list) -> DataFrame:
    """Turn a one-row aggregate with ``{col}__{stat}`` fields into one row per column."""
    structs = [F.struct(F.lit(c).alias("column_name"),
                        *[F.col(f"`{c}__{s}`").alias(s) for s in stats]) for c in columns]
    return df_agg.select(F.inline(F.array(*structs)))


def column_info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) for every column; one aggregate."""
    agg = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"{c}__non_null") for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = _long(agg, df.columns, ["non_null"])
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return out.select("column_name", mapping[F.col("column_name")].alias("dtype"), "non_null")


def describe(df: DataFrame, cols=None, relative_error: float | None = None,
             method: str = "bounded") -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per numeric column; NaN is missing.

    ``method='bounded'`` takes the quartiles from ``exact_quantiles`` (same
    values, memory independent of the number of distinct values)."""
    from .clean import nan_to_null
    df = nan_to_null(df)
    cols = cols or numeric_columns(df)
    fixed = exact_quantiles(df, cols, [0.25, 0.5, 0.75]) if method == "bounded" else None
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        if fixed is not None:
            q = F.lit(fixed[c]).cast("array<double>") if fixed[c] else F.lit(None).cast("array<double>")
        else:
            q = quantiles(x, [0.25, 0.5, 0.75], relative_error)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 q.alias(f"{c}__q"), F.max(x).alias(f"{c}__max")]
    agg = df.agg(*aggs)
    long = _long(agg, cols, ["count", "mean", "std", "min", "q", "max"])
    return long.select("column_name", "count", "mean", "std", "min",
                       F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
                       F.col("q")[2].alias("q75"), "max")


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column, n_missing, share) for columns with at least one missing value."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        x = F.col(f"`{c}`")
        miss = x.isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            miss = miss | F.isnan(x)
        aggs.append(F.count_if(miss).alias(f"{c}__n_missing"))
    agg = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}__n_missing`").alias("n_missing"),
                        safe_div(F.col(f"`{c}__n_missing`"), F.col("__n")).alias("share"))
               for c in cols]
    return agg.select(F.inline(F.array(*structs))).filter(F.col("n_missing") > 0)


def duplicate_count(df: DataFrame, cols=None) -> DataFrame:
    """Rows beyond the first of each identical group, and their share.

    A grouped count with map-side combine: a hot group shrinks to one
    partial row per task before the shuffle.
    """
    cols = cols or df.columns
    g = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.sum("__c").alias("n_rows"), F.sum(F.col("__c") - 1).alias("n_duplicates")) \
        .select(F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                F.coalesce("n_duplicates", F.lit(0)).alias("n_duplicates")) \
        .withColumn("share", safe_div("n_duplicates", "n_rows"))


def long_values(df: DataFrame, cols) -> DataFrame:
    """(column, value) rows as strings for several columns (one scan)."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in cols])).alias("cv")).select("cv.column_name", "cv.value")


def value_counts(df: DataFrame, cols, normalize: bool = False) -> DataFrame:
    """Frequency per (column, value), nulls excluded, descending count then value."""
    g = long_values(df, cols).filter(F.col("value").isNotNull()) \
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        w = Window.partitionBy("column_name")  # result-sized: distinct values only
        g = g.withColumn("share", F.col("n") / F.sum("n").over(w))
    return g.orderBy("column_name", F.desc("n"), "value")


def class_share(df: DataFrame, target: str) -> DataFrame:
    """(class, n, share) of a target column."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def class_imbalance(df: DataFrame, target: str, class_names=None) -> DataFrame:
    """Count and share per class, class label, and the max/min count ratio."""
    g = class_share(df, target)
    w = Window.partitionBy()
    g = g.withColumn("imbalance_ratio", F.max("n").over(w) / F.min("n").over(w))
    if class_names:
        m = F.create_map(*[x for i, nm in enumerate(class_names) for x in (F.lit(i), F.lit(nm))])
        g = g.withColumn("class_name", m[F.col(target).cast("int")])
    return g


def _auto_bins(n: int, lo: float, hi: float, q25: float, q75: float) -> int:
    """numpy 'auto' rule: the smaller of the Freedman-Diaconis and Sturges widths."""
    if n == 0 or hi is None or hi == lo:
        return 1
    span = hi - lo
    sturges = span / (math.log2(n) + 1.0)
    fd = 2.0 * (q75 - q25) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil(span / width)))


def histogram(df: DataFrame, cols, bins: int | None = None, method: str = "bounded") -> DataFrame:
    """Equal-width bin counts per column (last bin closed), automatic bin count by
    default; empty bins count 0, and a column without values has no bins.

    One aggregate fits (min, max, n, IQR) per column; the counting is one
    grouped aggregate over (column, bin) after an unpivot.  With
    ``method='bounded'`` the quartiles come from ``exact_quantiles``.
    """
    bounded = method == "bounded" and not bins
    qs = exact_quantiles(df, cols, [0.25, 0.75]) if bounded else {}
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi")]
        if not bounded and not bins:
            aggs.append(F.percentile(x, [0.25, 0.75]).alias(f"{c}__q"))
    fit = df.agg(*aggs).first()
    params = {}
    for c in cols:
        n, lo, hi = fit[f"{c}__n"], fit[f"{c}__lo"], fit[f"{c}__hi"]
        q = qs.get(c) if bounded else (None if bins else fit[f"{c}__q"])
        if n == 0:
            continue
        k = bins or _auto_bins(n, lo, hi, q[0], q[1])
        params[c] = (float(lo), float(hi), int(k))
    if not params:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, bin_lo double, bin_hi double, n long")
    vals = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("x"),
                 F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(k).alias("k"))
        for c, (lo, hi, k) in params.items()])).alias("v")).select("v.*").filter(F.col("x").isNotNull())
    span = F.col("hi") - F.col("lo")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) * F.col("k") / span), F.col("k") - 1)).cast("int")
    g = vals.groupBy("column_name", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.createDataFrame([(c, *x) for c, x in params.items()],
                                           "column_name string, lo double, hi double, k int")
    grid = grid.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    width = (F.col("hi") - F.col("lo")) / F.col("k")
    return grid.join(g, ["column_name", "bin"], "left").select(
        "column_name", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def kde_curve(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott bandwidth (sample std * n^-1/5).

    Each task adds its values' kernels up over the whole grid, equal values of
    a batch at once; one row a task and grid point is shuffled.  Nulls and NaN
    take no part; without two different values there are no rows.
    """
    x = F.col(f"`{col}`").cast("double")
    x = F.when(~F.isnan(x), x)
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("s"),
                F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    n, s, lo, hi = st["n"], st["s"], st["lo"], st["hi"]
    if not n or not s:
        return df.sparkSession.createDataFrame([], "idx int, grid double, density double")
    h = float(s) * n ** (-1.0 / 5.0)
    g0, g1 = lo - cut * h, hi + cut * h
    step = (g1 - g0) / (gridsize - 1)
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))

    def partial(batches):
        """This task's sum of kernels at each grid point, one row a point."""
        grid, total = g0 + step * np.arange(gridsize), np.zeros(gridsize)
        for batch in batches:
            values, weights = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            for i in range(0, len(values), 4096):
                z = (grid[:, None] - values[None, i:i + 4096]) / h
                total += np.exp(-0.5 * z * z) @ weights[i:i + 4096]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(gridsize, dtype=np.int32)), pa.array(total)], ["idx", "v"])

    sums = df.select(x.alias("x")).where("x IS NOT NULL AND NOT isnan(x)").mapInArrow(partial, "idx int, v double")
    return sums.groupBy("idx").agg((F.sum("v") * F.lit(norm)).alias("density")) \
        .select("idx", (F.lit(g0) + F.col("idx") * F.lit(step)).alias("grid"), "density")


def _box_fit(df: DataFrame, cols, whisker: float, method: str) -> dict:
    """column -> (q1, median, q3, low fence, high fence); None without values."""
    if method == "bounded":
        fit = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    else:
        fit = df.agg(*[F.percentile(F.col(f"`{c}`").cast("double"), [0.25, 0.5, 0.75]).alias(c)
                       for c in cols]).first()
    return {c: (*fit[c], fit[c][0] - whisker * (fit[c][2] - fit[c][0]), fit[c][2] + whisker * (fit[c][2] - fit[c][0]))
            if fit[c] else None for c in cols}


def box_stats(df: DataFrame, cols, whisker: float = 1.5, method: str = "bounded") -> DataFrame:
    """Quartiles, whisker ends (furthest points inside 1.5 IQR) and outlier count
    per column; a column without values has nulls and no outliers."""
    aggs = []
    for c, q in _box_fit(df, cols, whisker, method).items():
        x, none = F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")
        low, high = (F.lit(q[3]), F.lit(q[4])) if q else (none, none)
        inside = (x >= low) & (x <= high)
        aggs += [*[(F.lit(q[i]) if q else none).alias(f"{c}__{n}") for i, n in enumerate(("q1", "median", "q3"))],
                 F.min(F.when(inside, x)).alias(f"{c}__whisker_lo"),
                 F.max(F.when(inside, x)).alias(f"{c}__whisker_hi"),
                 F.count_if((x < low) | (x > high)).alias(f"{c}__n_outliers")]
    return _long(df.agg(*aggs), cols, ["q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"])


def box_outliers(df: DataFrame, cols, whisker: float = 1.5, method: str = "bounded") -> DataFrame:
    """(column_name, value, n): the points beyond the whiskers, equal ones counted."""
    fences = {c: q[3:] for c, q in _box_fit(df, cols, whisker, method).items() if q}
    cells = [F.struct(F.lit(c).alias("column_name"), F.when(
        ~F.col(f"`{c}`").cast("double").between(lo, hi), F.col(f"`{c}`").cast("double")).alias("value"))
        for c, (lo, hi) in fences.items()]
    if not cells:
        return df.sparkSession.createDataFrame([], "column_name string, value double, n long")
    return (df.select(F.explode(F.filter(F.array(*cells), lambda x: x["value"].isNotNull())).alias("p")).select("p.*")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def factorize(df: DataFrame, col: str, out: str | None = None,
              broadcast_max_rows: int = 1_000_000, values_per_task: int = 1_000_000) -> DataFrame:
    """Integer code per distinct value in sorted order; null -> -1.

    Codes come from the distinct values and are joined back.  When their
    count is checked to be under ``broadcast_max_rows`` they are ranked in
    one small task and broadcast; above it the ranking is distributed
    (``_distributed_codes``) and the join is a shuffle join, where AQE splits
    a hot value's partition.
    """
    from ..session import cut_lineage
    out = out or col
    # distinct values: written once, then counted and ranked from the copy
    d = cut_lineage(df.select(F.col(f"`{col}`").alias("__v")).filter(F.col("__v").isNotNull()).distinct())
    codes = _codes(d, d.count(), broadcast_max_rows, values_per_task)
    return _attach(df, col, out, codes)


def _codes(d: DataFrame, n: int, broadcast_max_rows: int, values_per_task: int) -> DataFrame:
    if n <= broadcast_max_rows:
        return F.broadcast(d.withColumn("__code", F.dense_rank().over(Window.orderBy("__v")) - 1))
    return _distributed_codes(d, max(2, -(-n // values_per_task)))


def _attach(df: DataFrame, col: str, out: str, codes: DataFrame) -> DataFrame:
    codes = codes.select(F.col("__v").alias(f"__v_{out}"), F.col("__code").alias(f"__code_{out}"))
    j = df.join(codes, df[f"`{col}`"].eqNullSafe(codes[f"`__v_{out}`"]), "left")
    cols = [c for c in df.columns if c != col] if out == col else df.columns
    return j.select(*[F.col(f"`{c}`") for c in cols],
                    F.coalesce(F.col(f"`__code_{out}`"), F.lit(-1)).cast("int").alias(out))


def factorize_columns(df: DataFrame, cols, broadcast_max_rows: int = 1_000_000,
                      values_per_task: int = 1_000_000) -> DataFrame:
    """``factorize`` of several columns in place, with one pass for all string
    columns: their (column, value) pairs are unpivoted and de-duplicated
    together, written once, and every column's codes come from that copy.
    Other types keep their own ordering and go through ``factorize``."""
    from ..session import cut_lineage
    types = dict(df.dtypes)
    strs = [c for c in cols if types[c] == "string"]
    for c in cols:
        if c not in strs:
            df = factorize(df, c, None, broadcast_max_rows, values_per_task)
    if len(strs) < 2:
        return factorize(df, strs[0], None, broadcast_max_rows, values_per_task) if strs else df
    cells = F.array(*[F.struct(F.lit(c).alias("__c"), F.col(f"`{c}`").alias("__v")) for c in strs])
    d = cut_lineage(df.select(F.inline(cells)).filter(F.col("__v").isNotNull()).distinct())
    counts = {r["__c"]: r["n"] for r in d.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in strs:
        dc = d.filter(F.col("__c") == c).select("__v")
        df = _attach(df, c, c, _codes(dc, counts.get(c, 0), broadcast_max_rows, values_per_task))
    return df


def _distributed_codes(d: DataFrame, n_parts: int) -> DataFrame:
    """Dense 0-based rank of distinct values ``__v`` without a global window.

    The values are range-partitioned and sorted inside each partition, then
    written to the checkpoint folder, which fixes every row's partition and
    position.  A row's code is the number of values in earlier partitions
    (offsets from one count per partition, a table of ``n_parts`` rows) plus
    its position in its own partition.
    """
    from ..session import cut_lineage
    s = cut_lineage(d.repartitionByRange(n_parts, "__v").sortWithinPartitions("__v"))
    s = s.select("__v", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().alias("__m"))
    counts = s.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # n_parts rows
    offs = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.col("__m") - F.shiftleft(F.col("__p").cast("long"), 33)
    return s.join(F.broadcast(offs), "__p").select("__v", (F.col("__off") + local).alias("__code"))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (col_i, col_j, r) for i != j.

    String columns are factorized first.  Each task gathers the co-moments of
    all pairs in matrix products: counts, sums, squares and cross products
    under the pairs' own null masks, around the columns' means.  Spark adds
    the (i, j) rows up, so work and shuffle follow the pairs, not the plan.
    A pair with fewer than two complete rows, or of a constant column, has a
    null r; NaN counts as null.
    """
    cols = list(cols)
    strs = [c for c in cols if dict(df.dtypes)[c] == "string"]
    if strs:
        df = factorize_columns(df, strs)
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    rows = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(x)])
    means = np.array([m or 0.0 for m in rows.agg(*[F.avg(c) for c in rows.columns]).first()])
    names = ["n", "si", "sj", "qi", "qj", "c"]
    kind = "i int, j int, " + ", ".join(f"{n} double" for n in names)

    def moments(batches):
        d = len(means)
        there, sums, squares, cross = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            for at in range(0, len(table), 1 << 14):
                part = table[at:at + (1 << 14)] - means
                mask = ~np.isnan(part)
                part[~mask] = 0.0
                mask = mask.astype(np.float64)
                there += mask.T @ mask
                sums += part.T @ mask
                squares += (part * part).T @ mask
                cross += part.T @ part
        i, j = np.triu_indices(d, 1)
        parts = [there[i, j], sums[i, j], sums[j, i], squares[i, j], squares[j, i], cross[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, parts)],
                                         ["i", "j", *names])

    total = rows.mapInArrow(moments, kind).groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])
    n = F.col("n")

    def spread(s, q):  # what rounding leaves of a constant column is no spread
        left = F.col(q) - F.col(s) * F.col(s) / n
        return F.when((n > 1) & (left > 1e-13 * F.col(q)), left)

    r = (F.col("c") - F.col("si") * F.col("sj") / n) / F.sqrt(spread("si", "qi") * spread("sj", "qj"))
    r = F.when(n > 1, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    r = F.when(spread("si", "qi").isNotNull() & spread("sj", "qj").isNotNull(), r)
    label = F.array(*map(F.lit, cols))
    pair = total.select(label[F.col("i")].alias("a"), label[F.col("j")].alias("b"), r.alias("r"))
    return pair.select(F.inline(F.array(F.struct(F.col("a").alias("col_i"), F.col("b").alias("col_j"), "r"),
                                        F.struct(F.col("b").alias("col_i"), F.col("a").alias("col_j"), "r"))))


def target_corr(df: DataFrame, features, target: str) -> DataFrame:
    """Correlation of each feature with the target, descending."""
    agg = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c)
                   for c in features])
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("r")) for c in features]
    return agg.select(F.inline(F.array(*structs))).orderBy(F.desc_nulls_last("r"), "feature")



class _Bracket:
    """The open interval that holds the ranks ``first`` and ``last`` (of
    ``column``'s values from 0): None is an open end; ``below`` rows lie
    at or under its lower end, ``inner`` rows strictly inside."""

    def __init__(self, column: str, first: int, last: int, rows: int):
        self.column, self.first, self.last = column, first, last
        self.low = self.high = None
        self.below, self.inner = 0, rows
        self.width = 1.0  # of the margin, grown after a miss
        self.values: dict = {}

    def inside(self, low=None, high=None) -> Column:
        x = F.col(self.column)
        out = x.isNotNull()
        for end, keep in ((self.low, x.__gt__), (low, x.__gt__), (self.high, x.__lt__), (high, x.__lt__)):
            if end is not None:
                out = out & keep(F.lit(end))
        return out

    def ranks(self, error: float) -> list[float]:
        """Where the sketch of the inner rows is asked for the next ends; out of 0..1 for an end that stays."""
        margin = min(0.25, error * self.width)
        n = max(1, self.inner)
        return [(self.first - self.below + 0.5) / n - margin, (self.last - self.below + 0.5) / n + margin]


def _sketched(rows: DataFrame, brackets: list[_Bracket], size: int) -> dict:
    """bracket -> (low, high) proposals from one scan: a KLL sketch of the
    inner rows of each distinct interval, merged over the tasks."""
    error = 2.3 / size ** 0.9
    intervals: dict = {}
    for b in brackets:
        intervals.setdefault((b.column, b.low, b.high), []).append(b)
    sketches = [F.kll_sketch_agg_double(F.when(own[0].inside(), F.col(own[0].column)), F.lit(size)).alias(f"s{i}")
                for i, own in enumerate(intervals.values())]
    asked, where = [], []
    for i, own in enumerate(intervals.values()):
        ranks = [(b, side, r) for b in own for side, r in enumerate(b.ranks(error)) if 0 < r < 1]
        where.append(ranks)
        if ranks:
            asked.append(F.kll_sketch_get_quantile_double(F.col(f"s{i}"), F.array(*[F.lit(r) for *_, r in ranks])).alias(f"q{i}"))
    ends = {b: [b.low, b.high] for b in brackets}
    if asked:
        got = rows.agg(*sketches).select(*asked).first()
        for i, ranks in enumerate(where):
            for (b, side, _), value in zip(ranks, got[f"q{i}"] if ranks else [], strict=True):
                ends[b][side] = value
    return ends


def _counted(rows: DataFrame, ends: dict) -> dict:
    """bracket -> rows under low, at low, at high and strictly inside the new ends, from one scan."""
    aggs = []
    for i, (b, (low, high)) in enumerate(ends.items()):
        x, zero = F.col(b.column), F.lit(0)
        aggs += [(F.count_if(x < low) if low is not None else zero).alias(f"b{i}"),
                 (F.count_if(x == low) if low is not None else zero).alias(f"l{i}"),
                 (F.count_if(x == high) if high is not None and high != low else zero).alias(f"u{i}"),
                 F.count_if(b.inside(low, high)).alias(f"m{i}")]
    got = rows.agg(*aggs).first()
    return {b: tuple(got[f"{n}{i}"] for n in "blum") for i, b in enumerate(ends)}


def exact_quantiles(df: DataFrame, cols, probs, accuracy: int = 16_384, max_interior: int = 50_000) -> dict:
    """column -> exact linear-interpolated quantiles (equal to ``percentile``),
    None for a column without values, with memory bounded by ``accuracy`` and
    ``max_interior`` instead of by the number of distinct values.

    The columns are written once.  One scan sketches them all (a mergeable
    KLL sketch a column); around each quantile's ranks the sketch gives a
    bracket.  One scan counts the rows below every bracket, the ties at its
    ends and the rows strictly inside; one more collects the distinct values
    inside with their counts, where at most ``max_interior`` rows are there.
    A fuller bracket (tables of some 10^7 rows and more) is sketched again
    from its strictly inner rows, which shrink every time; one that misses its
    ranks is taken back with a wider margin.  A value held by a third of the
    rows is a tie count, never a list.  NaN sorts after all other values.
    """
    from ..session import saved
    cols, probs = list(cols), list(probs)
    x = {f"v{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(cols)}
    rows = saved(df.select(*[F.when(~F.isnan(v), v).alias(n) for n, v in x.items()],
                           *[(F.isnan(v)).alias(f"{n}_nan") for n, v in x.items()]))
    n_of = rows.agg(*[F.count(n).alias(n) for n in x], *[F.count_if(f"{n}_nan").alias(f"{n}_nan") for n in x]).first()
    open_, all_of = [], {}
    for name in x:
        n = n_of[name] + n_of[f"{name}_nan"]
        for q in probs if n else []:
            h = (n - 1) * q
            first, last = math.floor(h), math.ceil(h)
            b = _Bracket(name, min(first, n_of[name] - 1), min(last, n_of[name] - 1), n_of[name])
            b.values = {k: float("nan") for k in (first, last) if k >= n_of[name]}
            all_of[name, q] = (h, first, last, b)
            if len(b.values) < len({first, last}):
                open_.append(b)
    while open_:
        ends = {b: [b.low, b.high] for b in open_}
        wide = [b for b in open_ if b.inner > max(2, max_interior)]
        if wide:
            ends.update(_sketched(rows, wide, accuracy))
        known = {b: (b.below, 0, 0, b.inner) for b in open_ if b not in wide}
        if wide:
            known.update(_counted(rows, {b: ends[b] for b in wide}))
        small, left = [], []
        for b in open_:
            under, ties, over, inner = known[b]
            if b.first < under or b.last >= under + ties + inner + over:
                b.width *= 4  # missed: the interval stays as it was
                left.append(b)
                continue
            b.low, b.high = ends[b]
            b.below, b.inner = under + ties, inner
            ranks = [k for k in {b.first, b.last} if k not in b.values]
            b.values.update({k: b.low for k in ranks if under <= k < under + ties})
            b.values.update({k: b.high for k in ranks if k >= under + ties + inner})
            if any(k not in b.values for k in ranks):
                (small if inner <= max(2, max_interior) else left).append(b)
                inside = [k for k in ranks if k not in b.values]
                b.first, b.last = min(inside), max(inside)
        if small:
            cells = F.array(*[F.when(b.inside(), F.struct(F.lit(i).alias("t"), F.col(b.column).alias("v")))
                              for i, b in enumerate(small)])
            pairs = (rows.select(F.explode(F.filter(cells, lambda e: e.isNotNull())).alias("e"))
                     .groupBy("e.t", "e.v").agg(F.count("*").alias("n")).collect())  # at most max_interior rows a bracket
            hist: dict = {i: [] for i in range(len(small))}
            for r in pairs:
                hist[r["t"]].append((r["v"], r["n"]))
            for i, b in enumerate(small):
                at = b.below
                for v, count in sorted(hist[i]):
                    b.values.update({k: v for k in (b.first, b.last) if at <= k < at + count})
                    at += count
        open_ = left
    out = {}
    for c, name in zip(cols, x, strict=True):
        if not n_of[name] + n_of[f"{name}_nan"]:
            out[c] = None
            continue
        res = []
        for q in probs:
            h, first, last, b = all_of[name, q]
            low, high = b.values[first], b.values[last]
            res.append(low if first == last else (last - h) * low + (h - first) * high)
        out[c] = res
    return out
