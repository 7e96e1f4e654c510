import numpy as np
import pytest

from riskframe.llm.topk import integer_vectors, top_k


def brute(rows, asked, k):
    out = []
    for q, v in asked:
        best = sorted((-int(np.dot(np.array(v, object), np.array(w, object))), i) for i, w in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def ints(rows):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    return [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in ok]


@pytest.mark.parametrize("lists,k", [(2, 10), (3, 3), (1, 5)])
def test_equals_brute_force(spark, lists, k):
    rng = np.random.default_rng(lists)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # copies: ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = integer_vectors(df)
    got = sorted(tuple(r) for r in top_k(vectors, vectors.where("vec_id % 10 = 0"), k, lists).collect())
    own = ints(rows)
    assert got == brute(own, [x for x in own if x[0] % 10 == 0], k)


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -4.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    v = integer_vectors(df)
    got = top_k(v, v, 10).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, r) for q in range(3) for r in (1, 2)]
    assert top_k(v.where("false"), v.where("false"), 10).count() == 0


def test_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=4) * 1e5).astype(np.float32).tolist()) for i in range(60)]
    v = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted(tuple(r) for r in top_k(v, v.where("vec_id % 20 = 0"), 5).collect())
    assert got == brute(ints(rows), [x for x in ints(rows) if x[0] % 20 == 0], 5)


def test_repeated_ids_are_rows_of_their_own(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(40)]
    rows += [rows[0]] * 2 + [(20, rng.normal(size=4).astype(np.float32).tolist())]  # a query row three times; two under one id
    rows += [(7, rows[5][1])] + [rows[9]] * 7  # a candidate id with two vectors; one of more than k copies
    rows += [(10, [9.0] * 4)] * 7 + [(11, [9.0] * 4)] * 2 + [(12, [9.0] * 4)]  # copies of a query's own id hide no others
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    own = ints(rows)
    got = sorted(tuple(r) for r in top_k(vectors, vectors.where("vec_id % 10 = 0"), 4).collect())
    assert got == brute(own, [x for x in own if x[0] % 10 == 0], 4)
