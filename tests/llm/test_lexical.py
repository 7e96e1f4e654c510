import math
import random
import re
from collections import Counter

from riskframe.llm.lexical import Scanner, rank_documents

from .conftest import PHRASE, edge_rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = [("a", "the quick brown fox"), ("b", "One, TWO! one"), ("c", None), ("d", ""), ("e", "--- !!"), ("f", "é日本語 été x"),
         ("g", PHRASE), ("g", PHRASE), ("h", "nowhere_to be-seen zzz"), ("x", "\x00nul\x1c \x85 marks 12³"), (None, "lazy dog")]


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, items, k):
    docs = [(i, Counter(TERM.findall(small(t)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = 0
            for term in set(TERM.findall(small(text))) & set(c):
                df = sum(term in other for _, other in docs)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 20 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(str(item), r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(spark, rows, items, k, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id string, text string")
    got = rank_documents(docs, items, k=k, **more).collect()
    return sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in got), key=str)


def test_edge_rows(spark, edge, empty):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    want = brute(rows, ITEMS, 3)
    assert ranked(spark, rows, ITEMS, 3) == want
    assert ranked(spark, rows, ITEMS, 3, block_pairs=5) == want
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = rank_documents(edge, items, k=3).collect()
    assert sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in got), key=str) == want
    assert rank_documents(empty, items).count() == 0
    assert rank_documents(edge, items.limit(0)).count() == 0


def test_ties_and_copies(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(300)]
    rows += [(1000 + i, "w1 w2, w3") for i in range(200)] + [(2000, "w7 " * 50000)]
    items = [(f"i{j}", " ".join(rng.choices(words, k=6))) for j in range(30)]
    assert ranked(spark, rows, items, 10, block_pairs=60) == brute(rows, items, 10)


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("ccc", "x"), ("d", "z")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "X")], "item_id int, text string")
    got = rank_documents(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == ["ccc", "a", "b", None]


def test_guards():
    n, found = Scanner(["a", "ab", "b"]).counts("A ab-b a_bé ba a".encode())
    assert (n, dict(found)) == (7, {0: 3, 1: 1, 2: 1})
    assert Scanner(["a"]).counts(None)[0] == Scanner(["a"]).counts(b"..")[0] == 0
