"""Published results rebuilt from confusion counts (FIXTURES.md §3) and known AUC/AP."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M

# Confusion counts implied by the published test metrics.
GOLDEN = {
    "logistic_regression": (1467, 1948, 229, 15586, .886791472, .429575403, .864976415, .574056),
    "random_forest": (1366, 733, 330, 16801, .944721789, .650786089, .805424528, .719895),
    "xgboost": (1210, 121, 486, 17413, .968434737, .909090909, .713443396, .799471),
    "lightgbm": (1196, 374, 500, 17160, .954550182, .761783439, .705188679, .732394),
    "catboost": (1218, 151, 478, 17383, .967290692, .889700511, .718160377, .794780),
}


def _expand(spark):
    parts = []
    for m, (tp, fp, fn, tn, *_) in GOLDEN.items():
        for lab, pred, n in ((1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)):
            parts.append(spark.range(n).select(F.lit(m).alias("model"), F.lit(lab).alias("label"),
                                               F.lit(pred).alias("prediction")))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


def test_published_metrics(spark):
    got = {r["model"]: r for r in M.basic_metrics(_expand(spark), ["model"]).collect()}
    for m, (*_, acc, prec, rec, f1) in GOLDEN.items():
        r = got[m]
        assert abs(r["accuracy"] - acc) < 1e-9
        assert abs(r["precision"] - prec) < 1e-9
        assert abs(r["recall"] - rec) < 1e-9
        assert abs(r["f1"] - f1) < 1e-6


def test_scored_auc_ap(spark):
    from conftest import SF_MID
    from riskframe.sources.fixtures import scored
    s = scored(spark, SF_MID).filter(F.col("model") == "a1c")
    assert abs(M.roc_auc(s).first()[0] - 0.896597302) < 1e-8
    assert abs(M.average_precision(s).first()[0] - 0.404315423) < 1e-8


def test_patient_counts(spark):
    from conftest import SF_MID
    from riskframe.sources.fixtures import patients, patients_dirty
    p = patients(spark, SF_MID)
    assert p.count() == 60000
    assert p.filter("diabetes = 1").count() == 7430
    d = patients_dirty(spark, SF_MID)
    assert d.count() == 61176
    assert d.dropDuplicates().count() == 60000
