"""Split/fold exactness and invariance; models; I/O errors."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import models as MD
from riskframe.operators import metrics as M
from riskframe.operators.split import presplit, stratified_folds, stratified_split
from riskframe.sources.fixtures import KEY, patients


def test_split_exact_and_invariant(spark):
    from conftest import SF_MID
    p = patients(spark, SF_MID).select(*KEY, "diabetes")
    s = stratified_split(p, "diabetes", KEY).groupBy("diabetes", "split").count().collect()
    got = {(r["diabetes"], r["split"]): r["count"] for r in s}
    assert got == {(0, "test"): 10514, (1, "test"): 1486, (0, "train"): 42056, (1, "train"): 5944}
    a = stratified_split(p, "diabetes", KEY, bits=8)
    b = stratified_split(p.repartition(13), "diabetes", KEY, bits=16)
    assert a.exceptAll(b).count() == 0


def test_folds_balanced(spark):
    from conftest import SF_SMALL
    p = patients(spark, SF_SMALL).select(*KEY, "diabetes")
    f = stratified_folds(p, "diabetes", KEY, 5).groupBy("diabetes", "fold").count().collect()
    for cls in (0, 1):
        sizes = [r["count"] for r in f if r["diabetes"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_presplit_errors(spark):
    df = spark.createDataFrame([(1, "train")], "diabetes int, split string")
    with pytest.raises(ValueError):
        presplit(df, "diabetes")
    with pytest.raises(ValueError):
        presplit(df.drop("split"), "diabetes")


def test_model_fit_save_load(spark, tmp_path):
    from conftest import SF_SMALL
    from riskframe.plans.train import modelling_data
    train, test, feats = modelling_data(spark, SF_SMALL)
    m = MD.fit(train, "logistic_regression", feats, "diabetes")
    p = MD.predict(m, test, "diabetes", keep=["rid"])
    assert M.roc_auc(p).first()[0] > 0.8
    MD.save(m, str(tmp_path / "lr"))
    p2 = MD.predict(MD.load(str(tmp_path / "lr")), test, "diabetes", keep=["rid"])
    assert p.exceptAll(p2).count() == 0
    with pytest.raises(ValueError):
        MD.build("svm", feats)
    preds, cv, st, _ = MD.train_many(train, test, ["logistic_regression"], feats, "diabetes", cv=True)
    assert cv.filter("status = 'ok'").count() == 5
    summ = MD.train_test_summary(preds, cv).first()
    assert summ["test_accuracy"] > 0.8 and "±" in summ["cv_f1"]


def test_failed_model_isolated(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1)], "x double, diabetes int").withColumn("fold", F.lit(0))
    _, _, st, _ = MD.train_many(df, df, ["logistic_regression"], ["missing_col"], "diabetes", cv=False)
    assert st.first()["status"] == "failed"


def test_io_errors(spark, tmp_path):
    from riskframe.sources import files, snapshots
    with pytest.raises(ValueError):
        files.read_file(spark, str(tmp_path / "x.parquet"), "a int")
    with pytest.raises(ValueError):
        files.read_file(spark, str(tmp_path / "x.xlsx"), "a int")
    with pytest.raises(KeyError):
        snapshots.get_version(spark, str(tmp_path / "snap"), "nope")


def test_zip_roundtrip_paths_and_retry(spark, tmp_path):
    import pytest
    from riskframe.sources import files
    df = spark.range(500).selectExpr("id", "id * 0.5 AS x", "CAST(id % 3 AS STRING) AS s")
    for folder in (str(tmp_path / "plain"), "file:" + str(tmp_path / "uri")):
        files.write_zip_csv(df, folder, partitions=3).collect()
        files.write_zip_csv(df, folder, partitions=3).collect()  # a re-run replaces its own archives
        back = files.read_zip_csv(spark, folder, df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.zip").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="not a zip archive"):
        files.read_zip_csv(spark, str(bad), df.schema).collect()
