from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from tracemill.llm import graph, jaccard_join
from tracemill.llm.graph import components
from tracemill.llm.jaccard_join import jaccard_components
from tracemill.llm.shingles import shingle_set


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    return [w for w in lower.split(" ") if w]


def plain_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = {i: plain_set(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


def run(docs, rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs(rows)).collect()}


def corpus(seed, groups=12, copies=6):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows, i = [], 0
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(8, 160))]
        if rnd.random() < 0.6:
            base = base[:20] + passage + base[20:]
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
            i += 1
    rnd.shuffle(rows)
    return rows


def test_shingles_equal_those_of_plain_code():
    texts = ["A b\tC d e f", "a B c D E", "a b", "a b c d e f a b c d e f", "", " \n", "é É a b c d e", "x y z"]
    for t in texts:
        assert len(shingle_set(t)) == len(plain_set(t))
    assert set(shingle_set("a b\nc  d e f")) == set(shingle_set("A B C D E F"))
    assert not set(shingle_set("a b c d")) & set(shingle_set("a b c d e"))
    assert len(shingle_set(None)) == 0


def test_edge_rows(docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A\tB"), (6, "a b c"), (7, "x " * 30_000), (8, "X " * 9)]
    got = run(docs, rows)
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 7)}


def test_ids_repeated_null_and_empty_table(docs):
    assert run(docs, []) == {}
    out = jaccard_components(docs([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(1, 1), (1, 1), (2, 1)]


def test_border_of_the_threshold(docs):
    base = [f"w{i}" for i in range(25)]               # 21 shingles
    links = base[:-3] + ["x", "y", "z"]               # 18 common, 24 in all: 0.75
    apart = base[:-4] + ["x", "y", "z", "q"]          # 17 common, 25 in all
    got = run(docs, [(1, " ".join(base)), (2, " ".join(links)), (3, " ".join(apart))])
    assert [got[i][1] for i in (1, 2, 3)] == [1, 1, 3]


def test_equals_brute_force(docs):
    for seed in range(2):
        rows = corpus(seed)
        assert run(docs, rows) == brute(rows)


def test_large_regions_are_joined_recursively(docs, monkeypatch):
    """Regions of more than two members go through pivots and rings."""
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "SHARED_BY", 3)
    rows = corpus(7, groups=10, copies=12)
    assert run(docs, rows) == brute(rows)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "LEAF", 7)
    monkeypatch.setattr(jaccard_join, "DENSE", 3)
    assert run(docs, rows) == brute(rows)


def test_sets_are_moved_in_slices(docs, monkeypatch):
    """Pairs bring at most as many numbers along at once as all kept sets have, and the late shingles stay bounded."""
    kept, real = [], jaccard_join.Workspace.save

    def save(self, df, name, *more):
        kept.append(name)
        return real(self, df, name, *more)

    monkeypatch.setattr(jaccard_join.Workspace, "save", save)
    for name, value in (("SMALL", 2), ("LATE_AT_MOST", 2), ("SHARED_BY", 3), ("MOVED", 1), ("ROUNDS", 1), ("LEAF", 7), ("DENSE", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus(7, groups=10, copies=12)
    assert run(docs, rows) == brute(rows)
    assert {"round0_verified1", "leaf_members1", "leaf_verified1"} <= set(kept)


def test_guests_of_different_rounds_meet(docs, monkeypatch):
    """Pairs whose only meeting place is a ring where both came as guests, in different rounds.

    The texts name their shingles by number. All sets of a seed share their
    first nine, hence every region, and the linked pairs are far from all others.
    """

    def numbered(text):
        return np.array(sorted({int(w) for w in (text or "").split()}), np.int64)

    monkeypatch.setattr(jaccard_join, "shingle_set", numbered)
    monkeypatch.setattr(jaccard_join, "SHARED_BY", 10**9)
    rows, sets = [], []
    for seed in range(6):
        rng, base = np.random.default_rng(seed), 1000 * seed
        for _ in range(150):
            pool = base + 100 + rng.permutation(50)
            for picked in (pool[:25], np.r_[pool[4:25], pool[25:29]]):
                sets.append({*range(base, base + 9), *picked.tolist()})
                rows.append((len(rows), " ".join(map(str, sorted(sets[-1])))))
    x = np.zeros((len(sets), 6000), np.float32)
    for i, s in enumerate(sets):
        x[i, list(s)] = 1
    common = x @ x.T
    links = np.argwhere(np.triu(100 * common >= 75 * (68 - common), 1))
    assert len(links) >= 900
    label = np.arange(len(sets))
    for _ in range(20):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert run(docs, rows) == {i: (34, int(c)) for i, c in enumerate(label)}


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK_EDGES", block)
    rnd = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rnd.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (None, 3)]
    label = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_never_rule_out_a_link():
    rng = np.random.default_rng(5)
    for n in (3, 40, 300, 2000):
        sets = []
        for _ in range(30):
            base = rng.integers(-2 ** 62, 2 ** 62, n)
            for share in (1.0, 0.9, 0.87, 0.8, 0.5):
                kept = base[: max(1, int(share * n))]
                sets.append(np.unique(np.concatenate([kept, rng.integers(-2 ** 62, 2 ** 62, int(rng.integers(0, max(2, n // 8))))])))
        frame = pd.DataFrame({"n": [len(x) for x in sets], "bits": [jaccard_join.signature(x) for x in sets]})
        i, j = np.triu_indices(len(sets), 1)
        can = jaccard_join._can_share(frame, i, j)
        common = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
        total = frame["n"].to_numpy()[i] + frame["n"].to_numpy()[j]
        linked = 100 * common >= 75 * (total - common)
        assert linked.sum() > (0 if n < 40 else 20) and can[linked].all()
        assert n < 40 or can[common == 0].mean() < 0.01
