"""``process_data``: impute -> dedup -> split -> (cap, encode, scale) fit on train.

One DataFrame with a ``split`` column flows through; every fit is one
aggregate over the train rows and every transform is a projection, so the
whole preparation is a handful of scans plus the de-duplication shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Roles
from ..operators import clean, encode, scale, split
from ..session import saved, scratch_tables


@dataclass
class Prepared:
    data: DataFrame
    stages: dict = field(default_factory=dict)


def process_data(df: DataFrame, roles: Roles, keys, test_size: float = C.TEST_SIZE,
                 seed: int = C.SEED, encoding: str = "label",
                 robust_cols=tuple(C.ROBUST_COLUMNS), standard_cols=tuple(C.STANDARD_COLUMNS),
                 outlier_threshold: float = C.OUTLIER_Z, cap_fit_on: str = "train",
                 relative_error: float | None = None, materialize: bool = True,
                 quantile_method: str = "bounded") -> Prepared:
    """Returns the prepared rows (with ``split``) and the fitted stages.

    ``cap_fit_on='each'`` reproduces the reference, which caps the test rows
    with test statistics; the default fits the caps on train only.
    ``quantile_method='bounded'`` fits medians and quartiles with
    ``exact_quantiles`` (same values; memory independent of the number of
    distinct values, for high-cardinality columns at scale).
    """
    df = clean.nan_to_null(df)
    with scratch_tables() as keep:
        if materialize:
            # the medians, modes and null counts read a few columns each: written
            # once as Parquet, none of them repeats the scan and its shuffle
            df = saved(df)
        imp = clean.fit_impute(df, roles.continuous, roles.categorical, roles.binary, relative_error, quantile_method)
        df = clean.dedup(imp.transform(df))
        if materialize:
            # the de-duplicated rows feed the split's two small jobs, and with the
            # split they feed four fits: both are written once, so that no fit
            # repeats the shuffle or the row hashes
            df = saved(df)
        df = split.stratified_split(df, roles.target, keys, test_size, seed)  # a projection
        if materialize:
            df = keep(saved(df))  # the tables before it are not read again
    train = df.filter(F.col("split") == "train")
    cont = [c for c in roles.continuous if c in df.columns]
    stages = {"impute": imp}
    if cap_fit_on == "each":
        test = df.filter(F.col("split") == "test")
        cap_tr = clean.fit_winsorize(train, cont, outlier_threshold, method=quantile_method)
        cap_te = clean.fit_winsorize(test, cont, outlier_threshold, method=quantile_method)
        df = cap_tr.transform(train).unionByName(cap_te.transform(test))
        stages["winsorize_train"], stages["winsorize_test"] = cap_tr, cap_te
    else:
        cap = clean.fit_winsorize(train, cont, outlier_threshold, method=quantile_method)
        df = cap.transform(df)
        stages["winsorize"] = cap
    train = df.filter(F.col("split") == "train")
    cats = [c for c in roles.categorical if c in df.columns]
    enc = encode.fit_label_encoder(train, cats) if encoding == "label" else encode.fit_onehot(train, cats)
    df = enc.transform(df)
    train = df.filter(F.col("split") == "train")
    rob, std = scale.fit_scalers(train, [c for c in robust_cols if c in df.columns],
                                 [c for c in standard_cols if c in df.columns], relative_error,
                                 quantile_method)
    df = std.transform(rob.transform(df))
    stages.update({"encode": enc, "robust": rob, "standard": std})
    return Prepared(df, stages)
