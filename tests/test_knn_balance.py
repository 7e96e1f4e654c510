"""k-NN and rebalancing against brute force on small inputs, plus properties."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import balance as B
from riskframe.operators.knn import knn, knn_bruteforce

FEATS = ["age", "hypertension", "heart_disease", "bmi", "HbA1c_level", "blood_glucose_level"]


def keyed(spark):
    from conftest import SF_SMALL
    from riskframe.plans.q_balance import keyed as k
    return k(spark, SF_SMALL)


def _same(a: pd.DataFrame, b: pd.DataFrame):
    a = a.sort_values(["q_key", "rank"]).reset_index(drop=True)
    b = b.sort_values(["q_key", "rank"]).reset_index(drop=True)
    assert len(a) == len(b)
    assert (a["q_key"].values == b["q_key"].values).all()
    assert (a["n_key"].values == b["n_key"].values).all()
    assert np.allclose(a["d2"].values, b["d2"].values)


def test_knn_minority_small_slabs(spark):
    m = keyed(spark).filter("diabetes = 1")
    _same(knn(m, FEATS, "rid", 5, slab_rows=50).toPandas(), knn_bruteforce(m, FEATS, "rid", 5))


def test_knn_queries_against_all_rows(spark):
    d = keyed(spark).filter("rid < '3'")  # a slice keeps brute force quick
    d = d.withColumn("q", F.col("diabetes") == 1)
    _same(knn(d, FEATS, "rid", 5, query_col="q", slab_rows=100).toPandas(),
          knn_bruteforce(d, FEATS, "rid", 5, query_col="q"))


def test_knn_hot_duplicate_vector(spark):
    # a third of the rows share one vector: collapsed, neighbours = smallest keys
    rows = [(f"k{i:04d}", 1.0, 2.0) for i in range(300)] + \
           [(f"r{i:04d}", float(i % 17), float(i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, a double, b double")
    _same(knn(df, ["a", "b"], "key", 5, slab_rows=64).toPandas(), knn_bruteforce(df, ["a", "b"], "key", 5))


def test_knn_k1_all_rows(spark):
    d = keyed(spark).filter("rid < '4'")
    _same(knn(d, FEATS, "rid", 1, slab_rows=128).toPandas(), knn_bruteforce(d, FEATS, "rid", 1))


def test_smote_properties(spark):
    d = keyed(spark)
    s = B.smote(d, FEATS, "diabetes", "rid", 5, 42).cache()
    counts = {r["diabetes"]: r["count"] for r in s.groupBy("diabetes").count().collect()}
    assert counts[0] == counts[1]
    syn = s.filter("synthetic").toPandas()
    base = d.toPandas().set_index("rid")
    nn = knn(d.filter("diabetes = 1"), FEATS, "rid", 5).toPandas()
    nbrs = nn.groupby("q_key")["n_key"].apply(set).to_dict()
    for _, r in syn.head(200).iterrows():
        b = r["rid"].split("#")[0]
        x = base.loc[b, FEATS].to_numpy(float)
        y = r[FEATS].to_numpy(float)
        # y lies on a segment from x to one of its 5 neighbours
        ok = False
        for n in nbrs[b]:
            z = base.loc[n, FEATS].to_numpy(float)
            dz = z - x
            t = np.dot(y - x, dz) / np.dot(dz, dz) if np.dot(dz, dz) > 0 else 0.0
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(x + t * dz, y, atol=1e-9):
                ok = True
                break
        assert ok
    # invariant to input partitioning
    s2 = B.smote(d.repartition(7), FEATS, "diabetes", "rid", 5, 42)
    assert s.exceptAll(s2).count() == 0 and s2.exceptAll(s).count() == 0


def _adasyn_reference(pdf, feats, k=5, seed=42):
    """numpy re-statement of the ADASYN counts for a small frame."""
    X = pdf[feats].to_numpy(float)
    keys = pdf["rid"].to_numpy()
    y = pdf["diabetes"].to_numpy()
    n_min, n_max = (y == 1).sum(), (y == 0).sum()
    ratios = {}
    for i in np.nonzero(y == 1)[0]:
        d = ((X - X[i]) ** 2).sum(axis=1)
        cand = sorted((d[j], keys[j], y[j]) for j in range(len(keys)) if j != i)[:k]
        ratios[keys[i]] = sum(1 for c in cand if c[2] != 1) / k
    tot = sum(ratios.values())
    return {kk: int(np.rint(v / tot * (n_max - n_min))) for kk, v in ratios.items()}


def test_adasyn_counts(spark):
    d = keyed(spark).filter("rid < '5'")
    pdf = d.toPandas()
    want = _adasyn_reference(pdf, FEATS)
    got = B.adasyn(d, FEATS, "diabetes", "rid", 5, 42).filter("synthetic") \
        .withColumn("base", F.split("rid", "#")[0]).groupBy("base").count().toPandas()
    got = dict(zip(got["base"], got["count"]))
    assert {k: v for k, v in want.items() if v} == got


def test_tomek_links_bruteforce(spark):
    d = keyed(spark).filter("rid < '6'")
    pdf = d.toPandas()
    nn = knn_bruteforce(d, FEATS, "rid", 1).set_index("q_key")["n_key"].to_dict()
    lab = dict(zip(pdf["rid"], pdf["diabetes"]))
    want = {(a, b) for a, b in nn.items() if nn.get(b) == a and lab[a] != lab[b]}
    got = {(r["q_key"], r["n_key"]) for r in B.tomek_links(d, FEATS, "diabetes", "rid").collect()}
    assert got == want
    kept = B.tomek(d, FEATS, "diabetes", "rid")
    # only majority members are removed; no minority row lost
    assert kept.filter("diabetes = 1").count() == d.filter("diabetes = 1").count()
    assert d.count() - kept.count() == len({a for a, _ in want if lab[a] == 0})


def test_unknown_strategy(spark):
    import pytest
    with pytest.raises(ValueError):
        B.resample(keyed(spark), "borderline", FEATS, "diabetes", "rid")


def test_smote_hot_copies_spread_in_chunks(spark, monkeypatch):
    """Three minority rows must produce ~200 rows: copies come in chunks spread over
    tasks; count, key uniqueness and the segment property hold as without chunks."""
    from pyspark.sql import functions as F

    from riskframe.operators import balance as B
    rows = [(f"M{i}", float(i), float(2 * i), 1) for i in range(3)]
    rows += [(f"J{i}", float(i % 17) + 10.0, float(i % 5), 0) for i in range(203)]
    df = spark.createDataFrame(rows, "rid string, x double, y double, lab int")
    whole = B.smote(df, ["x", "y"], "lab", "rid", k=2, seed=7).select("rid", "x", "y", "synthetic")
    monkeypatch.setattr(B, "COPY_CHUNK", 16)
    chunked = B.smote(df, ["x", "y"], "lab", "rid", k=2, seed=7).select("rid", "x", "y", "synthetic")
    a, b = sorted(map(tuple, whole.collect())), sorted(map(tuple, chunked.collect()))
    assert a == b
    syn = chunked.filter("synthetic")
    assert syn.count() == 200 and syn.select("rid").distinct().count() == 200
    # every synthetic point lies on the line y = 2x between two minority rows
    assert syn.filter(F.abs(F.col("y") - 2 * F.col("x")) > 1e-9).count() == 0
    assert syn.filter((F.col("x") < 0) | (F.col("x") > 2)).count() == 0
