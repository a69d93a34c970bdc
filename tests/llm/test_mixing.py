from __future__ import annotations

from collections import defaultdict

from tracemill.llm import mixing


def rows_of(df):
    return [(r["doc_id"], r["source"], r["size"], r["source_size"], r["target"], r["copies"]) for r in df.collect()]


def expected_targets(sizes):
    """The rule as words say it: share by weight, stop at twice the size, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * per > 2 * sizes[s]]
        if not full:
            out.update({s: weight[s] * per for s in open_})
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_targets_and_taken_words(docs):
    rows = [(i, "w " * (1 + i * 7 % 40), s) for i, s in enumerate(["b", "a", None, "é", "big", "big", "big", "B"] * 150)]
    got = rows_of(mixing.mix(docs(rows)))
    assert len(got) == len(rows)
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, size, *_, copies in got:
        sizes[s] += size
        taken[s] += copies * size
        most[s] = max(most[s], size)
        assert 0 <= copies <= 2
    goal = expected_targets(sizes)
    for _, s, _, source_size, target, _ in got:
        assert source_size == sizes[s] and abs(target - goal[s]) < 1e-6 * max(goal[s], 1)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= most[s]


def test_reruns_agree_whatever_the_partitions(docs):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}") for i in range(700)]
    one, two = mixing.mix(docs(rows)), mixing.mix(docs(rows[::-1]).repartition(7))
    assert sorted(rows_of(one)) == sorted(rows_of(two))


def test_every_copy_has_its_chance(docs):
    """Over many seeds a document is taken as often as its target says."""
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(60)]
    counts, goals = defaultdict(int), {}
    for seed in range(12):
        for i, s, size, source_size, target, copies in rows_of(mixing.mix(docs(rows), seed=seed)):
            counts[i] += copies
            goals[i] = target / source_size
    assert abs(sum(counts.values()) / 12 - sum(goals.values())) < 2.5
    assert len(set(counts.values())) > 1


def test_edge_rows(docs):
    assert rows_of(mixing.mix(docs([]))) == []
    got = rows_of(mixing.mix(docs([(1, None, "a"), (2, "", None), (3, " \t", "b")])))
    assert {g[2] for g in got} == {0} and {g[5] for g in got} == {0}
    same = rows_of(mixing.mix(docs([(1, "a b", "x")] * 4 + [(None, "c d e", "x"), (2, "a b", "y")])))
    assert len(same) == 6 and len({g[5] for g in same if g[0] == 1}) == 1
