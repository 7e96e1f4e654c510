"""The opN_ queries and their DuckDB twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, langid, lexical, quality, toxicity
from .alignment import align_documents
from .bpe import digests, encode_documents
from .common import benchmark, documents, workers_import
from .dedup import exact_dedup
from .jaccard import near_duplicates
from .labelled import label_table, remainder, sample
from .packing import pack_documents
from .sharding import shard_documents, tree_of
from .suffix import cut_repeats
from .topk import integer_vectors, top_k

#: Vocabulary file of the tokenizing queries.
VOCABULARY = "byte_bpe_50k.json"
#: Model that it is aligned with.
PIECES = "piece_bpe_32k.model"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_import(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


#: Labelled documents that a classifier is fitted on, at most.
MAX_DOCS = 6000


def toxicity_model(spark, docs, sf_dir) -> toxicity.NoisyOr:
    """Fitted on at most MAX_DOCS labelled rows of ``docs`` outside the held-out fifth."""
    labels = label_table(spark, sf_dir)
    return toxicity.fit(sample(docs, labels, F.col("toxic"), remainder(5) == 0, MAX_DOCS))


@query("op1_mil_toxicity")
def op1_mil_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.size("offending").alias("n_offending"),
                         F.when(F.size("offending") > 0, F.array_max(F.transform(
                             "offending", lambda x: F.struct(x["score"], x["start"], x["end"])))["start"]).alias("worst_start"))


@query("op2_ordinal_quality")
def op2_ordinal_quality(spark, sf_dir):
    """Grades 0 (low quality), 1 (good but toxic), 2 (good and not toxic)."""
    docs, labels = documents(spark, sf_dir), label_table(spark, sf_dir)
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = quality.fit(sample(docs, labels, grade, remainder(5) == 0, MAX_DOCS), grades=3)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), F.col("tail_prob").alias("score"),
                         F.col("kept").cast("int").alias("predicted"), "expected_grade", "tail_prob", "kept")


@query("op3_hd_langid")
def op3_hd_langid(spark, sf_dir):
    docs = documents(spark, sf_dir)
    profiles = langid.fit(docs.where(remainder(3) != 1))
    return langid.identify(docs, profiles).select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


@query("op4_harmonic_packing")
def op4_harmonic_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), vocabulary())


@query("op5_threshold_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op5_threshold_topk(spark, sf_dir):
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op6_exact_dedup", f"""
WITH n AS (SELECT doc_id, sha256({_NORM}) AS text_sha256, length(coalesce(text, '')) AS p FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, struct_pack(a := -p, b := doc_id)) AS keep_id
      FROM n GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)""")
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir), digest=True)


@query("op7_hash_tree_sharding")
def op7_hash_tree_sharding(spark, sf_dir):
    return shard_documents(documents(spark, sf_dir), tree_of(8), tree_of(9))


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark, sf_dir):
    cut = cut_repeats(documents(spark, sf_dir))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_bpe_pair_index")
def op9_bpe_pair_index(spark, sf_dir):
    return encode_documents(documents(spark, sf_dir), vocabulary(), digests,
                            "n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op10_count_vector_jaccard")
def op10_count_vector_jaccard(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), words=3, num=90, den=100)


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


@query("op11_aho_corasick_search", lexical.TWIN)
def op11_aho_corasick_search(spark, sf_dir):
    return lexical.rank_documents(documents(spark, sf_dir), benchmark(spark, sf_dir), k=50)


@query("op12_positional_index", decontamination.TWIN)
def op12_positional_index(spark, sf_dir):
    return decontamination.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir), size=10)


@query("op13_pair_hash_alignment")
def op13_pair_hash_alignment(spark, sf_dir):
    return align_documents(documents(spark, sf_dir), vocabulary(), vocabulary(PIECES))
