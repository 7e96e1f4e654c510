import hashlib
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskframe.llm import bpe
from riskframe.llm.packing import cuts, pack_documents
from riskframe.llm.queries import vocabulary

from .conftest import edge_rows


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_equal_the_library(reference):
    rng = random.Random(1)
    alphabet = "ab's tmdrevl\n\t  ' é1½!?日 \x1c"
    texts = [t or "" for _, t, *_ in edge_rows()]
    texts += ["a's it's 'sfoo ''s 's", "a <|endoftext|> b  <|endoftext|><|endoftext|>'s", "aaaa aaaaa " * 3]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    got = [ids.tolist() for _, ids in bpe.encoded(enumerate(texts), vocabulary(), chunk=500, most=300)]
    assert got == [reference.encode(t, add_special_tokens=False).ids for t in texts]
    table = bpe.word_table(vocabulary()).vocab.token_bytes
    assert [bpe.decode(i, table) for i in got] == [reference.decode(i, skip_special_tokens=False) for i in got]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_with_equal_keys(reference):
    """Polynomials modulo 2^64 agree on a Thue-Morse word and its complement, whatever the base."""
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    table = bpe.WordTable(vocabulary())
    points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in (one, other)]
    table._powers(1025)
    assert len({int((table.values[p] * table.powers[:1024]).sum(dtype=np.uint64)) for p in points}) == 1
    rng = random.Random(8)
    texts = [one, other, other + " " + one, one, f"x {other}", thue_morse(2048), *("".join(rng.choices("ab", k=1024)) for _ in range(50))]
    for options in ({}, {"chunk": 100, "most": 10}, {"keep_special": False}):
        got = [ids.tolist() for _, ids in bpe.encoded(enumerate(texts), vocabulary(), **options)]
        assert got == [reference.encode(t, add_special_tokens=False).ids for t in texts]
        assert [bpe.decode(i, table.vocab.token_bytes) for i in got] == texts


def test_long_texts_in_parts(reference):
    rng = random.Random(9)
    alphabet = "ab's \n\t  é1!日zz<|endoftext|>"
    text = "".join(rng.choice(alphabet) for _ in range(20000))
    texts = [text, "", "x" * 5000, text[:3000] + "end of part\n\n 's", " " * 4000, "word <|endoftext|> " * 400]
    for chunk in (50, 997, 4000):
        assert "".join(bpe.cut_at_words(text, chunk)) == text
        got = [(k, ids.tolist()) for k, ids in bpe.encoded(enumerate(texts), vocabulary(), chunk=chunk, most=700)]
        assert got == [(i, reference.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)]


def test_classes_follow_the_splitter(reference):
    table, rng = bpe.class_table(vocabulary()), random.Random(3)
    for c in [*range(0x3000), *rng.sample(range(0x3000, 0xD800), 2000), *rng.sample(range(0xE000, 0x110000), 3000)]:
        one = [len(reference.pre_tokenizer.pre_tokenize_str(x + chr(c))) == 1 for x in "a1!"]
        assert one == [table[c] == k for k in (bpe.LETTER, bpe.NUMBER, bpe.OTHER)], hex(c)


def test_query_columns(edge, empty, reference):
    spec = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    got = bpe.encode_documents(edge, vocabulary(), bpe.digests, spec).collect()
    want = []
    for i, t, *_ in edge_rows():
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert bpe.encode_documents(empty, vocabulary()).count() == 0


@pytest.mark.parametrize("n", [1, 31, 32, 33, 511, 512, 1023, 1024, 1025, 5000])
def test_cuts_cover(n):
    at = 0
    for start, size, j in cuts(n, 1024):
        assert start == at and size * j <= 1024
        at += size
    assert at == n


def test_packing(edge, empty, reference):
    rows = pack_documents(edge, vocabulary(), rows_per_bucket=3).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert sorted(bins) == list(range(len(bins)))
    texts = defaultdict(list)
    for i, t, *_ in edge_rows():
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 0]
        texts[(i, len(ids))].append(ids)
    assert set(texts) == set(pieces)
    for key, own in texts.items():
        want = sorted((a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes())) for ids in own for a, n, _ in
                      cuts(len(ids), 1024))
        assert sorted(pieces[key]) == want
    assert pack_documents(empty, vocabulary()).count() == 0


def test_texts_are_encoded_in_little_memory():
    rng = random.Random(12)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(700)]
    path = vocabulary()
    bpe.word_table(path).clear()
    tracemalloc.start()
    total = sum(len(ids) for _, ids in bpe.encoded(enumerate(texts), path))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = sum(len(ids) for _, ids in bpe.encoded(enumerate(texts), path, chunk=1_000_000, most=1_000_000))
    assert total == whole and peak < 32 << 20
