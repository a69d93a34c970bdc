from __future__ import annotations

import numpy as np

from tracemill.llm import embedding_dedup, hamming_search
from tracemill.llm.embedding_dedup import near_vectors


def clusters(n=900, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 3, 64))
    rows = [b + rng.standard_normal(64) * s for b in base for s in (0.0, 0.2, 0.6)]
    return [(i, [float(x) for x in r]) for i, r in enumerate(rows)]


def plain_links(rows, cosine=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in ok])
    i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    return {(ok[a][0], ok[b][0]) for a, b in zip(i, j)}


def run(spark, rows, **k):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rep int, unit string")
    return near_vectors(frame, **k).collect()


def test_recall_and_no_false_link(spark):
    rows = clusters()
    out = run(spark, rows)
    links = plain_links(rows)
    found = sum(r["n_links"] for r in out) / 2
    assert 0.95 * len(links) <= found <= len(links)
    together = {frozenset(p) for p in links}
    component = {r["vec_id"]: r["component_id"] for r in out}
    for r in out:
        assert r["kept"] == (r["vec_id"] == r["component_id"]) and r["component_id"] <= r["vec_id"]
    assert np.mean([component[a] == component[b] for a, b in map(tuple, together)]) > 0.95


def test_blocks_cut_no_window(spark, monkeypatch):
    rows = clusters(300, 1)
    whole = sorted(map(tuple, run(spark, rows)))
    monkeypatch.setattr(embedding_dedup, "BLOCK", 70)
    assert sorted(map(tuple, run(spark, rows))) == whole


def unit_rows(x):
    return [(i, v) for i, v in enumerate(x.tolist())]


def test_tight_group_has_all_links(spark):
    """10,000 distinct vectors, all linked with each other, among others."""
    rng = np.random.default_rng(5)
    x = np.r_[rng.standard_normal(64) + 0.1 * rng.standard_normal((10_000, 64)), rng.standard_normal((500, 64))]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(1) - 1
    assert want[:10_000].min() > 9_000
    got = {r["vec_id"]: r["n_links"] for r in run(spark, unit_rows(x))}
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_recall_in_a_dense_cluster(spark):
    """Planted pairs near the threshold, inside one cluster whose own members don't link."""
    rng = np.random.default_rng(6)
    x = 1.4 * rng.standard_normal(64) + rng.standard_normal((20_000, 64))
    x[1::20] = x[::20] + 0.8 * rng.standard_normal((1000, 64))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    planted = np.flatnonzero((np.abs(np.einsum("ij,ij->i", u[::20], u[1::20]) - 0.91) <= 0.01)) * 20
    assert len(planted) > 100
    component = {r["vec_id"]: r["component_id"] for r in run(spark, unit_rows(x))}
    found = np.mean([component[i] == component[i + 1] for i in planted])
    print(f"recall of {len(planted)} planted pairs: {found:.4f}")
    assert found >= 0.99


def test_edge_rows(spark):
    v = [1.0] + [0.0] * 63
    rows = [(1, v), (2, [3.0] + [0.0] * 63), (3, None), (4, []), (5, [0.0] * 64), (6, [float("nan")] * 64), (7, [None] * 64),
            (8, [float("inf")] * 64), (9, [1.0, 0.0]), (10, [1e300] * 64), (11, [1e-300] * 64), (None, v), (1, v), (12, [-1.0] + [0.0] * 63)]
    out = run(spark, rows)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out)
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9),
                   (10, 1, 10), (11, 1, 10), (12, 0, 12)]
    assert run(spark, []) == []


def brute_top(codes, queries, k):
    out = []
    for q, c in queries:
        near = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in set(codes) if i != q)[:k]
        out += [(q, n + 1, i, far) for n, (far, i) in enumerate(near)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(-2**63, 2**63, 40)
    codes = [(i, int(base[i % 40]) ^ (1 << int(rng.integers(0, 63)) if i % 3 else 0)) for i in range(500)] + [
        (500 + i, int(c)) for i, c in enumerate(rng.integers(-2**63, 2**63, 300))] + [(900 + i, 12345) for i in range(60)]
    queries = [(i, c) for i, c in codes if i % 20 == 0]
    frame = spark.createDataFrame(codes + codes[:9] + [(None, 1), (7, None)], "id long, code long")
    asked = spark.createDataFrame(queries + [(None, 1)], "query_id long, code long")
    want = brute_top(codes, queries, 10)
    assert sorted(map(tuple, hamming_search.top_k(frame, asked, 10).collect())) == want
    monkeypatch.setattr(hamming_search, "BLOCK_CODES", 90)
    monkeypatch.setattr(hamming_search, "QUERY_ROWS", 7)
    assert sorted(map(tuple, hamming_search.top_k(frame, asked, 10).collect())) == want


def test_top_k_edges(spark):
    make = lambda rows, n: spark.createDataFrame(rows, f"{n} long, code long")
    assert hamming_search.top_k(make([], "id"), make([], "query_id")).count() == 0
    assert hamming_search.top_k(make([], "id"), make([(1, 2)], "query_id")).count() == 0
    out = hamming_search.top_k(make([(1, 5), (2, 4)], "id"), make([(1, 5)], "query_id")).collect()
    assert list(map(tuple, out)) == [(1, 1, 2, 1)]
