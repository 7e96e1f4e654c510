import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np

from riskframe.llm import suffix as S
from riskframe.llm.queries import op8_suffix_array_dedup

from .conftest import edge_rows


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r), bool)
        for a in range(len(r) - length + 1):
            if seen[r[a:a + length]] > 1:
                gone[a:a + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(i), len(r), int(gone.sum()), runs, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return sorted(out)


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for _ in range(40):
        contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        for length in (3, 6):
            count = Counter(c[i:i + length] for c in contexts for i in range(len(c) - length + 1))
            want = [[i for i in range(len(c) - length + 1) if count[c[i:i + length]] > 1] for c in contexts]
            assert [x.tolist() for x in S.repeated_starts(contexts, length)] == want


def test_merging_by_binary_search():
    rng = random.Random(4)
    one, two = ([bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(4, 30))) for _ in range(9)] for _ in range(2))
    a, b = S.shared_starts(one, two, 4)
    for own, other, got in ((one, two, a), (two, one, b)):
        there = {c[i:i + 4] for c in other for i in range(len(c) - 3)}
        assert [x.tolist() for x in got] == [[i for i in range(len(c) - 3) if c[i:i + 4] in there] for c in own]


def test_each_start_is_in_one_run():
    rng = random.Random(6)
    pieces = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 10, 50, 51, 300, 49, 700)]
    piece, first, last, _ = S.anchored_runs(pieces, 50)
    found = sorted((p, s) for p, a, z in zip(piece, first, last, strict=True) for s in range(a, z + 1))
    assert found == [(p, s) for p, raw in enumerate(pieces) for s in range(len(raw) - 49)]


def test_cut_equals_brute_force(edge, empty):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    for length, shard in ((200, 8000), (40, 8000)):
        got = S.cut_repeats(edge, length).collect()
        out = sorted((str(r.doc_id), len((r.text or "").encode()), sum(s.end - s.start for s in r.spans), len(r.spans),
                      bytes(r.kept)) for r in got)
        assert out == brute(rows, length)
    assert S.cut_repeats(empty).count() == 0


def test_hot_anchors_are_split_and_merged(spark):
    from .conftest import SCHEMA
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(60)) + passage + "".join(rng.choice("abcdefgh ") for _ in range(60)))
            for i in range(24)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    spans = {(r.doc_id, s.start, s.end) for r in S.repeated_spans(docs, 50, shard_contexts=5).collect() for s in r.spans}
    raws = [t.encode() for _, t in rows]
    seen = Counter(r[i:i + 50] for r in raws for i in range(len(r) - 49))
    for i, r in enumerate(raws):
        starts = [a for a in range(len(r) - 49) if seen[r[a:a + 50]] > 1]
        assert {(z - a) for d, a, z in spans if d == i} and (i, starts[0], starts[-1] + 50) in spans


def test_query_digest(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, n, gone, runs, kept in brute(rows, 200)}
    got = {str(r.doc_id): tuple(r)[1:] for r in op8_suffix_array_dedup(spark, sf).collect()}
    assert got == want


def test_fingerprints_let_all_repeats_through():
    rng = np.random.default_rng(6)
    contexts = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) for n in rng.integers(0, 60, 400)]
    contexts += [contexts[7][3:40] + b"zz", b"", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for length in (12, 20):
        want = S.array_starts(contexts, length)
        assert [x.tolist() for x in S.repeated_starts(contexts, length)] == [x.tolist() for x in want]
        assert not (~S.may_repeat(contexts, length) & np.array([len(x) > 0 for x in want])).any()


def test_int_ids(spark):
    text = "some words that are here twice in one text " * 12
    docs = spark.createDataFrame([(1, text), (2, "x"), (None, None)], "doc_id int, text string")
    assert sorted((str(r.doc_id), len(r.spans)) for r in S.cut_repeats(docs).collect()) == [("1", 1), ("2", 0), ("None", 0)]


def test_anchors_are_found_in_little_memory():
    raws = [bytes(np.random.default_rng(i).integers(97, 123, 4000, dtype=np.uint8)) for i in range(600)]
    tracemalloc.start()
    found = sum(len(S.anchored_runs(pieces, 200)[0]) for _, pieces in S.text_slices(((0, r) for r in raws), 200))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(len(S.anchored_runs([r], 200)[0]) for r in raws) and peak < 16 << 20
