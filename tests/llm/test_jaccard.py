import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskframe.llm import jaccard as J

from .conftest import PHRASE, SCHEMA, edge_rows


def brute(rows, words, num, den):
    sets = {}
    for k, (i, t) in enumerate(rows):
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[k] = frozenset(zip(*[w[a:] for a in range(words)], strict=False)) if len(w) >= words else frozenset(
            [tuple(w)] if w else [])
    root = {k: k for k in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    live = [k for k in sets if sets[k] and rows[k][0] is not None]
    for a in live:
        for b in live:
            if a < b and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[x][0] for x in live if find(x) == find(k)] if i is not None else []
        out.append((i, len(sets[k]), min([*ids, i]) if i is not None else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[1], str(r[2])))


@pytest.mark.parametrize("words,num,chunk", [(3, 90, 1024), (5, 80, 1024), (2, 70, 4)])
def test_equals_brute_force(spark, edge, words, num, chunk):
    rng, base = np.random.default_rng(words), PHRASE.split()
    rows = [(i, t) for i, t, *_ in edge_rows()]
    for k in range(30):
        w = base[:]
        for at in rng.integers(0, len(w), k % 4):
            w[at] = f"w{k}"
        rows.append((100 + k, " ".join(w)))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = J.near_duplicates(docs, words, num, 100, chunk_sets=chunk).collect()
    assert order([tuple(r) for r in got]) == order(brute(rows, words, num, 100))


def test_empty(empty):
    assert J.near_duplicates(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 2 ** 32), st.sampled_from([80, 90]))
def test_similar_sets_share_a_tile_and_pass_the_bound(n, changes, seed, num):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
    drop = min(changes, len(a) - 1)
    b = np.unique(np.concatenate([a[drop // 2:], rng.integers(0, 2 ** 64, drop - drop // 2, dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    if 100 * both < num * (len(a) + len(b) - both):
        return
    bands = J.Bands(num, 100)
    assert len(np.intersect1d(J.tile_keys(a, bands), J.tile_keys(b, bands)))
    vectors, sizes = np.stack([J.count_vector(x).astype(np.int64) for x in (a, b)]), np.array([len(a), len(b)])
    assert 1 in J.CountTree(vectors, sizes).candidates(vectors[0], len(a), num, 100)


def test_tree_loses_no_candidate():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2 ** 64, rng.integers(5, 90), dtype=np.uint64)) for _ in range(300)]
    vectors, sizes = np.stack([J.count_vector(x).astype(np.int64) for x in sets]), np.array([len(x) for x in sets])
    tree = J.CountTree(vectors, sizes)
    for i in range(0, 300, 7):
        bound = np.minimum(vectors, vectors[i]).sum(axis=1)
        want = np.flatnonzero((bound * 3 >= sizes + sizes[i]) & (sizes * 2 >= sizes[i]) & (sizes[i] * 2 >= sizes))
        assert sorted(tree.candidates(vectors[i], int(sizes[i]), 1, 2).tolist()) == want.tolist()


def test_repeated_keys_are_found_over_runs_and_no_other():
    import pandas as pd
    rng = np.random.default_rng(3)
    runs = [rng.integers(-2 ** 63, 2 ** 63, 500) for _ in range(4)]
    runs[1][:5], runs[3][7], runs[2][:400] = runs[0][:5], runs[1][100], runs[2][0]  # across runs, and a hot key within one
    table = pd.concat([J.dealt([r[:250], r[250:]], 64).to_pandas() for r in [*runs, np.empty(0, np.int64)]])
    assert table["keys"].map(len).sum() == J.KEY_BYTES * (4 * 500 - 398)
    got = pd.concat([J.repeated(part)["key"] for _, part in table.groupby("bucket")])
    value, times = np.unique(np.concatenate(runs), return_counts=True)
    mask = (1 << 8 * J.KEY_BYTES) - 1
    assert sorted(got) == sorted(int(v) & mask for v in value[times > 1])


def test_a_written_table_keeps_the_session_setting(spark):
    from riskframe.llm import common
    setting = spark.conf.get(common._CLEANUP, "false")
    assert common.saved(spark.range(5000).groupBy((J.F.col("id") % 700).alias("k")).count()).count() == 700
    assert spark.conf.get(common._CLEANUP, "false") == setting


def test_whole_sets_of_long_unlike_texts_do_not_move(spark, monkeypatch):
    """Texts of thousands of words pass the bound on 128 groups although they
    share only some passages; finer vectors part them before their sets move."""
    moved, saved = [], J.saved

    def spy(df):
        out = saved(df)
        if "hashes" in out.columns:
            moved.append(out.count())
        return out
    monkeypatch.setattr(J, "saved", spy)
    rng = np.random.default_rng(7)
    passage = [f"c{x}" for x in rng.integers(0, 10**6, 3500)]
    rows = [(k, " ".join(passage + [f"u{x}" for x in rng.integers(0, 10**9, 4000)])) for k in range(12)]
    rows.append((50, rows[3][1] + " and more"))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = J.near_duplicates(docs, 5, 80, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == {**{k: k for k in range(12)}, 50: 3}
    assert moved[0] == 2


def test_fine_vectors_bound_the_overlap():
    rng = np.random.default_rng(3)
    for n in (1, 40, 9000):
        one = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        two = np.unique(np.concatenate([one[: n // 2], rng.integers(0, 1 << 63, n).astype(np.uint64)]))
        a, b = J.unpacked_vectors([J.packed_vector(x, J.FINE_GROUPS) for x in (one, two)])
        assert np.minimum(a, b).sum() >= len(np.intersect1d(one, two))
    crowd = np.arange(300, dtype=np.uint64)  # all in one group, beyond a byte
    (v,) = J.unpacked_vectors([J.packed_vector(crowd, J.FINE_GROUPS)])
    assert v[0] >= 300
