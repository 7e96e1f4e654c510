import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

from riskframe.llm import alignment as A
from riskframe.llm import bpe
from riskframe.llm.queries import PIECES, vocabulary

from .conftest import edge_rows


def brute(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha), token by token."""
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    back = {c: b for b, c in bpe.byte_alphabet().items()}
    s = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    docs, counts = [], Counter()
    for i, text in rows:
        a, b = [], []
        if text:
            a = [(x, bytes(back[c] for c in t.id_to_token(x))) for x in t.encode(" " + text, add_special_tokens=False).ids]
            for x in s.encode(text):
                p = s.id_to_piece(x)
                b.append((x, bytes([int(p[3:-1], 16)]) if s.is_byte(x) else p.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(y for _, y in a) != whole or b"".join(y for _, y in b) != whole:
                a, b = [], []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for x, y in side:
                own.append((x, at, at + len(y)))
                at += len(y)
            spans.append(own)
        pairs, j = [], 0
        for x, lo, hi in spans[0]:
            while j and spans[1][j][1] > lo:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < hi:
                if spans[1][j][2] > lo:
                    pairs.append((x, spans[1][j][0]))
                j += 1
            j = max(j - 1, 0)
        counts.update(pairs)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, lo = [], 0
        side = defaultdict(list)
        for k, own in enumerate(spans):
            for x, _, e in own:
                side[k, min(z for z in ends if z >= e) if len(ends) < 400 else ends[np.searchsorted(ends, e)]].append(x)
        groups = [",".join(map(str, side[0, e])) + "|" + ",".join(map(str, side[1, e])) for e in ends]
        docs.append((i, len(a), len(b), len(groups), pairs, ";".join(groups)))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i, na, nb, ng, len(p), sum(counts[x] == best[x[1]] for x in p), sum(counts[x] for x in p),
                    hashlib.sha256(g.encode()).hexdigest() if na else "") for i, na, nb, ng, p, g in docs), key=str)


def aligned(docs, **more):
    return sorted(map(tuple, A.align_documents(docs, vocabulary(), vocabulary(PIECES), **more).collect()), key=str)


def test_edge_rows(spark, edge, empty):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    want = brute(rows)
    assert aligned(edge) == want
    clash = edge.withColumns({c: edge.doc_id for c in ("row", "a", "b", "key", "bucket", "n_a")})
    assert aligned(clash.repartition(5), bucket_pairs=16, round_pairs=64) == want  # many buckets, many rounds
    assert aligned(empty) == []


def test_random_and_real_texts(spark):
    rng = random.Random(2)
    alphabet = "ab  's\n\t▁é1½!?日本😀 <0x41>\x00  the of <s></s><unk><|endoftext|>"
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 50)))) for i in range(300)]
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows += list(zip((1000 + i for i in table["doc_id"].to_pylist()), table["text"].to_pylist(), strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert aligned(docs, bucket_pairs=500, round_pairs=3000) == brute(rows)


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 50, 5000))
    buckets = 7
    own = (A.mixed(keys, 0) % np.uint64(buckets)).astype(int)
    rows = []
    for b in range(buckets):
        ordered, levels = A.build_hash(keys[own == b])
        rows.append((b, ordered.astype("<i8").tobytes(), np.packbits(np.concatenate(levels)).tobytes(), [len(x) for x in levels]))
    whole = A.PairHash(rows, buckets)
    assert sorted(whole.find(keys).tolist()) == list(range(len(keys)))
    assert (whole.keys[whole.find(keys)] == keys).all()
    other = np.setdiff1d(rng.integers(0, 1 << 50, 5000), keys)
    assert (whole.find(other) == -1).all()
    part = A.PairHash(rows[2:4], buckets)
    assert ((part.find(keys) >= 0) == np.isin(own, [2, 3])).all()
    assert len(A.build_hash(keys[:0])[0]) == 0 and A.build_hash(keys[:1])[0].tolist() == keys[:1].tolist()
