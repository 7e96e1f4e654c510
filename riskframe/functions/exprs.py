"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default: float | None = 0.0) -> Column:
    """num / den; ``default`` when the denominator is 0 or null (ANSI safe)."""
    q = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def indicator(cond: Column, dtype: str = "int") -> Column:
    """1/0 for a condition; null conditions count as 0 (pandas comparison semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast(dtype)


def row_hash(seed: int | str, keys: Iterable, purpose: str = "") -> Column:
    """md5 hex of (seed, key columns, purpose): the only source of randomness."""
    parts = [F.lit(str(seed))] + [col(k).cast("string") for k in keys] + [F.lit(purpose)]
    return F.md5(F.concat_ws("|", *parts))


def hash_uniform(h: Column) -> Column:
    """Uniform [0,1) from the first 32 bits of an md5 hex string."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_bucket(h: Column, bits: int) -> Column:
    """Leading ``bits`` bits (multiple of 4) of the md5 hex string as a bucket number."""
    return F.conv(F.substring(h, 1, bits // 4), 16, 10).cast("long")


def round_all(df, digits: int = 6):
    """Round every floating column (stable value hashes against another engine)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
