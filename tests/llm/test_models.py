import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import langid, quality, toxicity
from riskframe.llm.labelled import remainder, sample
from riskframe.llm.queries import QUERIES

from .conftest import edge_rows

SF = "/root/testdata/sf0.1"


def held(r, mod, value):
    return zlib.crc32(str(r).encode()) % mod == value


def test_toxicity_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op1_mil_toxicity"](spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == 10000 and all(r.held_out == held(i, 5, 0) for i, r in got.items())
    out = [(got[i].predicted, t) for i, t in labels.items() if got[i].held_out]
    assert np.mean([p == t for p, t in out]) > 0.97
    assert np.mean([p for p, t in out if t]) > 0.8 and np.mean([p for p, t in out if not t]) < 0.01


def test_quality_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op2_ordinal_quality"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = [(got[i].kept, q) for i, q in labels.items() if got[i].held_out]
    assert np.mean([int(k) == q for k, q in out]) > 0.97
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_prob <= 1 for r in got.values())


def test_language_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op3_hd_langid"](spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r.held_out == held(i, 3, 1) for i, r in got.items())
    assert np.mean([r.lang_pred == lang[i] for i, r in got.items() if r.held_out]) > 0.97


def test_toxicity_edges(edge, empty):
    model = toxicity.fit_rows([{"text": "you idiot. a fine day.", "grade": 1}, {"text": "a fine day. all good", "grade": 0}] * 20,
                              400, 0.3, 1e-3, 1e-5, 1.0)
    got = toxicity.score_toxicity(edge, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and not r.offending for r in got if r.doc_id in (4, 5, 6))
    text = "A fine day.\nYou IDIOT! All good."
    df = edge.sparkSession.createDataFrame([(1, text)], "doc_id long, text string")
    row = toxicity.score_toxicity(df, model).first()
    assert row.score > 0.5 and [text.encode()[s.start:s.end] for s in row.offending] == [b"You IDIOT"]
    assert toxicity.keep_clean(edge, model).columns == edge.columns
    assert toxicity.keep_clean(df, model).count() == 0
    assert toxicity.score_toxicity(empty, model).count() == 0
    none = toxicity.fit(empty.select("text", F.lit(1).alias("grade")))
    assert {r.score < 0.5 for r in toxicity.score_toxicity(df, none).collect()} == {True}


def test_quality_edges(edge, empty):
    none = quality.fit(empty.select("text", F.lit(1).alias("grade")))
    got = quality.score_quality(edge, none).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert r.grade_probs[0] >= r.grade_probs[1] and abs(sum(r.grade_probs) - r.expected_grade) < 1e-12
    assert quality.score_quality(empty, none).count() == 0


def test_language_edges(edge, empty):
    profiles = langid.fit(edge)
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(edge, profiles).collect()}
    assert {x for x in got if x[0] in (4, 5, 6)} == {(4, "und", 0.0), (5, "und", 0.0), (6, "und", 0.0)}
    assert all(0 <= s <= 1 for _, _, s in got)
    assert {r.lang_pred for r in langid.identify(edge, langid.fit(empty)).collect()} == {"und"}
    assert langid.identify(empty, profiles).count() == 0


def test_trigram_vectors_bind_rotated_letters():
    s = langid.Space(64, 3)
    grams, counts = s.grams("ab")
    want = sum(np.roll(x, 2) * np.roll(y, 1) * z for x, y, z in (
        (s.of_letter(0), s.of_letter(97), s.of_letter(98)), (s.of_letter(97), s.of_letter(98), s.of_letter(0))))
    assert np.array_equal(s.bundle(grams, counts), want)


def test_sample_is_bounded_and_leaves_the_held_out(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    assert sample(docs, labels, F.col("toxic"), remainder(5) == 0, 100).count() == 100
    everything = sample(docs, labels, F.col("toxic"), remainder(5) == 0, 10000).count()
    assert everything == sum(not held(i, 5, 0) for i in range(500))


@pytest.mark.parametrize("word,want", [("Word!!", "Aa!"), ("ABC", "A"), ("12", "0"), ("|", "|")])
def test_shapes(word, want):
    assert quality.shape(word) == want


def test_sample_takes_one_row_of_a_repeated_id(spark):
    docs = spark.range(600).select(F.when(F.col("id") < 300, F.lit(1)).otherwise(F.col("id")).alias("doc_id"),
                                   F.concat(F.lit("text "), F.lpad(F.col("id").cast("string"), 3, "0")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    rows = sample(docs, labels, F.col("toxic"), F.col("doc_id") < 0, 10000).collect()
    assert len(rows) == 301 and "text 000" in {r.text for r in rows}
