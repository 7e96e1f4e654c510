import corpus_pipeline
from riskframe.llm import toxicity
from riskframe.llm.dedup import BLANKS
from riskframe.llm.queries import QUERIES, toxicity_model

from . import test_jaccard, test_suffix
from .conftest import PHRASE, SCHEMA


def test_stages_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        out = corpus_pipeline.saved(out)
        assert 0 < out.count() <= before
        before, docs = out.count(), out
    pieces = corpus_pipeline.pack(spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert "pipeline" in QUERIES


def test_stages_on_edge_rows(edge, empty, spark):
    kept = [r.doc_id for r in corpus_pipeline.drop_exact_copies(spark, edge, "").collect()]
    assert 1 in kept and 2 not in kept and kept.count(None) == 1
    near = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, edge, "").collect()]
    assert 2 not in near and 4 in near and near.count(None) == 2 and near.count(14) == 2
    cut = {r.doc_id: r for r in corpus_pipeline.cut_repeated_passages(spark, edge, "").collect()}
    assert PHRASE not in cut[13].text if "start" in (cut[13].text or "") else True
    assert cut[1].text == "" and cut[1].n_chars == 0 and cut[4].text is None and cut[20].text == "😀😀 it's 12³ items!?"
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, "").count() == 0


def test_near_copies_go_by_row_not_by_id(edge, spark):
    near = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, edge, "").collect()]
    assert (13, "repeated id, other text") in near and (1, PHRASE) in near
    assert (13, "start of its own " + PHRASE + " and another end") not in near
    twins = [(5, PHRASE, "en", "a", 1), (5, PHRASE + " indeed", "en", "a", 2), (5, "a text of its own", "en", "a", 3)]
    docs = spark.createDataFrame(twins, SCHEMA)
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    texts = [r.text for r in out.collect()]
    assert len(texts) == 2 and "a text of its own" in texts


def test_stages_equal_brute_force(spark):
    """Kept ids and texts of the stages before packing, chained, on a whole table of distinct ids."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity_model(spark, docs, sf)

    def clean(rows):
        cache = model.scorer()
        return [(i, t) for i, t in rows if model.score(model.sentence_logits(*toxicity.sentences(t)[1:], cache)) < 0.5]

    def single(rows):
        best = {}
        for i, t in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0])):
            best.setdefault((t or "").translate({ord(c): None for c in BLANKS}), (i, t))
        return list(best.values())

    def apart(rows):
        first = {i: least for i, _, least in test_jaccard.brute(rows, 5, 80, 100)}
        return [(i, t) for i, t in rows if first[i] == i]

    def cut(rows):
        kept = {i: left.decode("utf-8", "ignore") for i, _, _, _, left in test_suffix.brute(rows, 200)}
        return [(i, t if t is None else kept[str(i)]) for i, t in rows]

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len({i for i, _ in rows}) == len(rows)
    for (name, stage), whole in zip(corpus_pipeline.STAGES[:-1], [clean, single, apart, cut], strict=True):
        docs = corpus_pipeline.saved(stage(spark, docs, sf))
        rows = whole(rows)
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows), name


def test_workers_get_small_batches_and_free_memory(spark):
    """A worker waits for the next stage with what the last one left in it."""
    def seen(batches):
        import os

        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "trim": [os.environ.get("MALLOC_TRIM_THRESHOLD_")],
                                              "pool": [pa.default_memory_pool().backend_name]})

    got = spark.range(0, 2500, 1, 1).mapInArrow(seen, "rows long, trim string, pool string").collect()
    assert sorted(r.rows for r in got) == [500, 1000, 1000]
    assert all(r.trim and r.pool == "system" for r in got)
