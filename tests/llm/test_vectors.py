import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import queries, topk, vectors
from tests.llm.helpers import vectors as table
from tests.oracle import compare, connect


def search(v, q, ids, qids, k, scale=1, cuts=()):
    """Best of several queries over a block, or over the blocks between cuts."""
    best = topk.Best(len(q), k)
    edges = [0, *cuts, len(v)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            own = topk.Lists(ids[a:b], v[a:b])
            stored = topk.Lists.read(own.ids.tobytes(), own.v.tobytes(), own.until.tobytes(), np.array(own.heads).tobytes(), v.shape[1], scale)
            topk.threshold_search(qids, topk.whole(q, scale), stored, best)
    return best.held


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 90), st.integers(1, 6), st.integers(0, 2**31), st.integers(1, 7), st.integers(1, 5))
def test_threshold_search_is_exact(n, dim, seed, k, queries):
    rng = np.random.RandomState(seed)
    v, q = rng.randint(-4, 5, (n, dim)).astype(float), rng.randint(-4, 5, (queries, dim)).astype(float)
    ids = rng.permutation(n * 2)[:n].astype(np.int64)
    qids = rng.choice(np.append(ids, 1000), queries).astype(np.int64)
    got = search(v, q, ids, qids, k, cuts=sorted(rng.randint(0, n, 2)))
    for i in range(queries):
        assert got[i] == sorted((-int(s), int(j)) for s, j in zip(v @ q[i], ids, strict=True) if j != qids[i])[:k]


def test_threshold_search_of_huge_components():
    v = np.array([[1.0, 1.0], [2.0**41, 0.0], [1.0, 0.0], [1e308, -1e308], [0.0, 2.0**60 + 2**10]])
    got = search(v, v[[0, 3]], np.arange(5), np.array([0, 3]), 3, scale=256)
    whole = [[int(x) * 256 for x in row] for row in v]
    for i, own in enumerate((0, 3)):
        assert got[i] == sorted((-sum(a * b for a, b in zip(whole[own], w)), j) for j, w in enumerate(whole) if j != own)[:3]


def test_threshold_search_stops_early():
    rng = np.random.RandomState(1)
    v = np.concatenate([rng.randint(0, 3, (5000, 4)), np.full((5, 4), 100)]).astype(float)
    lists = topk.Lists(np.arange(5005), v)
    seen = []
    best = topk.Best(1, 5)
    best.take = lambda which, score, ids, none: (seen.append(len(ids)), topk.Best.take(best, which, score, ids, none))
    topk.threshold_search(np.array([-1]), np.ones((1, 4)), lists, best)
    assert sum(seen) < 1000 and [i for _, i in best.held[0]] == [5000, 5001, 5002, 5003, 5004]


def test_top_k_of_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [2e300, 0.0]), (3, [-1e300, 0.0]), (4, [-2e300, 0.0]), (5, [0.0, 1.0]), (6, [2.0**41, 0.0])], "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(df, k=6, every=50).orderBy("rank").collect()]
    most, least = 2**63 - 1, -(2**63)
    assert got == [(1, 2, most), (2, 1, most), (3, 6, most), (4, 5, 65536), (5, 3, least), (6, 4, least)]


def test_top_k_query(spark, sf, tmp_path):
    compare(queries.op1_topk(spark, sf), connect(sf, tmp_path), queries.ORACLE_SQL["op1_topk"])


def test_top_k_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [1.0, 0.5], 1), (3, None, 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [], 0), (8, [0.0, -0.001], 0), (9, [1.0, 0.5, 2.0], 0), (None, [9.0, 9.0], 0), (50, [-1.0, 0.25], 0), (50, [-1.0, 0.25], 0), (2, [1.0, 0.5], 1)]
    got = {}
    for r in topk.top_k(table(spark, rows), k=5, every=50).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 50]
    s = 256 * 256 + 128 * 128
    want = sorted([(-s, 1), (-s, 2), (-s, 2), (128, 8), (256 * 256 - 64 * 128, 50), (256 * 256 - 64 * 128, 50)])[:5]
    assert [(-x, i) for _, i, x in sorted(got[0])] == want
    assert all(i != 50 for _, i, _ in got[50]) and [r for r, _, _ in sorted(got[50])] == [1, 2, 3, 4, 5]
    assert topk.top_k(table(spark, [])).count() == 0
    assert topk.top_k(table(spark, [(1, [1.0], 0)])).count() == 0


def brute(rows, threshold):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = {i: set() for i, _, _ in rows}
    for i, v, a in rows:
        for j, w, b in rows:
            if i != j and a is not None and a == b and ok(v) and ok(w) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links[i].add(j)
    part = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        part[i] = min(seen)
    return {i: (len(links[i]), part[i], part[i] == i) for i in links}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_vector_duplicates_query(spark, sf, tmp_path):
    compare(queries.op4_vector_dups(spark, sf), connect(sf, tmp_path), queries.ORACLE_SQL["op4_vector_dups"])


def test_vector_duplicates_large_group(spark, monkeypatch):
    """Groups larger than a window and than a block, copies, labels; links are counted exactly."""
    monkeypatch.setattr(vectors, "BLOCK", 100)
    rng = np.random.RandomState(3)
    center = rng.standard_normal(16)
    rows = [(k, (center + 0.04 * rng.standard_normal(16)).tolist(), 1) for k in range(300)]
    rows += [(300 + k, rng.standard_normal(16).tolist(), k % 2) for k in range(100)]
    rows += [(400 + k, center.tolist(), 1) for k in range(50)] + [(450, center.tolist(), 2), (451, center.tolist(), None)]
    out = vectors.vector_duplicates(table(spark, rows), passes=8, window=16)
    assert got(out) == brute(rows, 0.98)


def test_vector_duplicates_dense_label(spark, monkeypatch):
    """Vectors that share a direction: windows miss links, the answers don't; more than one block."""
    monkeypatch.setattr(vectors, "BLOCK", 64)
    rng = np.random.RandomState(5)
    center = rng.standard_normal(32)
    v = center / np.linalg.norm(center) + 0.26 / math.sqrt(32) * rng.standard_normal((300, 32))
    near = v[:60] + 0.18 / math.sqrt(32) * rng.standard_normal((60, 32))
    rows = [(k, x.tolist(), 1) for k, x in enumerate([*v, *near])]
    rows += [(2000 + k, x.tolist(), 2) for k, x in enumerate(v[:20])]
    assert got(vectors.vector_duplicates(table(spark, rows), passes=2, window=4)) == brute(rows, 0.98)


def test_vector_duplicates_of_one_id(spark):
    """Rows of one id and different vectors are vectors of their own; links join what both are linked to."""
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.001], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (1, [0.001, 1.0], 0)]
    out = vectors.vector_duplicates(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1)]


def test_vector_duplicates_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [1.0, None], 0), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 0), (11, [1e30, 0.0], 0), (12, [-1.0, 0.0], 0)]
    assert got(vectors.vector_duplicates(table(spark, rows))) == brute(rows, 0.98)
    twice = vectors.vector_duplicates(table(spark, [*rows, rows[0], (None, [1.0, 0.0], 0)]))
    assert twice.count() == len(rows) + 2
    assert {r.vec_id: r.n_links for r in twice.collect()}[1] == 2
    assert vectors.vector_duplicates(table(spark, [])).count() == 0
