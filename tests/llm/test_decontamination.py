import hashlib
import random
import re

import pytest

from riskframe.llm import decontamination as D

from .conftest import PHRASE, edge_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = [("a", "The QUICK brown fox jumps over the lazy dog while seven"), ("b", "One, TWO!"), ("c", None), ("d", ""), ("e", "-- !"),
         ("f", "été 日本語"), ("g", PHRASE), ("g", "one"), ("a10", PHRASE), ("h", "a b a b a b a b a b a b"), ("x", "nul\x1c \x85 marks"),
         (None, "no id here"), ("y", "not in any of the texts of this table at all now")]


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(items, size):
    out = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - size + 1, 1) if w else 0):
            out.setdefault(tuple(w[s:s + size]), set()).add(item)
    return out


def brute(rows, items, size=10):
    known, out = windows(items, size), []
    lengths = {len(p) for p in known}
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                own = known.get(tuple(w[s:s + n]))
                if own:
                    hit |= set(range(s, s + n))
                    found |= own - {None}
        ids = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(docs, items, **more):
    return sorted(map(tuple, D.contamination(docs, items, **more).collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def test_edge_rows(spark, edge, empty, items):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    assert got(edge, items) == brute(rows, ITEMS)
    assert got(edge.withColumns({c: edge.doc_id for c in ("row", "phrase", "term", "pos")}), items) == brute(rows, ITEMS)
    assert got(edge, items.limit(0)) == brute(rows, [])
    assert got(empty, items) == []


def test_overlaps_and_copies(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(f"i{j}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for j in range(25)] + [("s", "w1 " * 30)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(120)]
    rows += [(1000 + i % 7, items[3][1] + " w1 " * 8) for i in range(60)] + [(5000, "w1 w2 " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    table = spark.createDataFrame(items, "item_id string, text string")
    want = brute(rows, items, 4)
    assert got(docs, table, size=4) == want
    monkeypatch.setattr(D, "SMALL_BYTES", 0)  # nothing is small enough to be sent whole
    assert got(docs, table, size=4) == want


def test_near_matches(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(15)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(80)]
    items = [(f"i{j}", " ".join(rng.choices(vocabulary, k=n))) for j, n in enumerate([1, 2, 2, 3, 3, 4, 5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    phrases, _ = D.item_phrases(spark.createDataFrame(items, "item_id string, text string"), 5)
    index = D.build_index(docs)
    ids = {r.row: r.doc_id for r in index.where("term IS NULL").collect()}
    texts = {r.phrase: set(r.terms) for r in phrases.collect()}
    for span in (3, 7):
        found = D.near_matches(index, D.plan_phrases(index, phrases), span).collect()
        want = {(i, frozenset(own)) for i, t in rows for own in texts.values()
                if any(own <= set(words(t)[s:s + span]) for s in range(len(words(t))))}
        assert {(ids[r.row], frozenset(texts[r.phrase])) for r in found} == want
        by_row = {i: words(t) for i, t in rows}
        for r in found:
            assert texts[r.phrase] <= set(by_row[ids[r.row]][r.start:r.end]) and r.end - r.start <= span


def test_postings(spark):
    docs = spark.createDataFrame([(7, "A b, a"), (8, None)], "doc_id long, text string")
    index = D.build_index(docs)
    row = {r.doc_id: (r.row, r.pos) for r in index.where("term IS NULL").collect()}
    assert (row[7][1], row[8][1]) == (3, 0)
    assert sorted((r.term, r.pos) for r in index.where("term IS NOT NULL").collect()) == [("a", 0), ("a", 2), ("b", 1)]
