import hashlib
import re
import zlib
from collections import defaultdict

from riskframe.llm.dedup import drop_copies, exact_dedup
from riskframe.llm.sharding import shard_documents, tree_of

from .conftest import edge_rows


def test_exact_dedup_edges(edge):
    groups = defaultdict(list)
    for i, t, *_ in edge_rows():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    got = exact_dedup(edge, digest=True).collect()
    assert len(got) == len(edge_rows())
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        own = by_sha[r.text_sha256]
        keep = min(own, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(own), r.doc_id == keep)


def test_drop_copies_keeps_one_text_each(edge, empty):
    kept = drop_copies(edge)
    assert kept.columns == edge.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert drop_copies(empty).count() == 0 and exact_dedup(empty).count() == 0


def test_shards(edge, empty):
    got = shard_documents(edge, tree_of(8), tree_of(9), rows_per_bucket=2).collect()
    assert len(got) == len(edge_rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and 0 <= r.shard < 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    assert shard_documents(empty, tree_of(8), tree_of(9)).count() == 0


def test_tree_moves_rows_only_into_changed_subtrees(spark):
    from pyspark.sql import functions as F

    from riskframe.llm.sharding import place
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    old, new = tree_of(8), tree_of(8)
    new["region1"]["rack2"][5] = 3.0
    moved = keys.select(place(F.col("k"), old).alias("a"), place(F.col("k"), new).alias("b")).where("a <> b")
    assert moved.where("b < 4").count() == 0  # region 0 only loses
    share = keys.select(place(F.col("k"), new).alias("s")).groupBy("s").count().collect()
    share = {r.s: r["count"] / 20000 for r in share}
    assert abs(share[5] - 0.3) < 0.02 and all(abs(share[s] - 0.1) < 0.02 for s in share if s != 5)
