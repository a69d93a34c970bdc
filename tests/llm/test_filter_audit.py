from __future__ import annotations

import re
from itertools import permutations

import numpy as np

from tracemill.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, source string, text string"


def plain(rows, labels):
    """By walking every document through every order."""
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        docs.append((source or "", i, fails))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [(i, f) for p, i, f in docs if p == part]
        by_step = {}
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                failing = [f for _, f in mine if f[letter]]
                by_step[order, step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(sum(f.values()) == 1 for f in failing),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
        shares = {x: sum(v[1] for (o, s), v in by_step.items() if o[s - 1] == x) for x in "ABCDE"}
        out |= {(part, o, s, *v, shares[o[s - 1]]) for (o, s), v in by_step.items()}
    return out


def random_rows(seed, n=150):
    rng = np.random.default_rng(seed)
    pool = []
    for _ in range(40):
        length = int(rng.choice([0, 1, 150, 199, 200, 201, 400]))
        words = [f"w{x}" for x in rng.integers(0, rng.choice([3, 90, 5000]), length)]
        if rng.random() < 0.4:
            words = [w.upper() if rng.random() < 0.1 else w for w in words]
        if rng.random() < 0.3:
            words.append(rng.choice(["a|b", "#", "50%", "é&ü"]))
        pool.append(rng.choice([" ", "\n", " \t\x0b", "  "]).join(words))
    pool += [None, " ", "A", "\x1f"]
    ids = [*range(n), None, None, 5, 5]
    return [(i, pool[int(rng.integers(len(pool)))], rng.choice(["s", "t", "u", None], p=[.6, .2, .1, .1])) for i in ids]


def made(spark, rows):
    return spark.createDataFrame([(*r, 3, "clash", 1) for r in rows], "doc_id long, text string, source string, n int, part string, pattern int")


def test_equals_a_walk_through_every_order(spark):
    for seed in range(3):
        rows = random_rows(seed)
        rows.append(rows[7])  # a repeated row
        rng = np.random.default_rng(seed)
        labels = [(int(i), int(rng.integers(2)) if rng.random() < .8 else None, int(rng.integers(2))) for i in rng.integers(0, 160, 80)]
        labels += [(None, 1, 1), (5, 1, 0), (5, 0, 1)]
        marks = spark.createDataFrame([(*x, "s", "t") for x in labels], LABELS)
        found = [tuple(r) for r in filter_audit.audit(made(spark, rows), marks).collect()]
        assert len(found) == len(set(found)) == 600 * len({r[2] or "" for r in rows})
        assert set(found) == plain(rows, labels)


def test_a_large_group_of_copies_and_a_long_text(spark):
    rows = [(i, "same text", "hot") for i in range(3000)] + [(9000, "Long word " * 200_000, "x")]
    labels = spark.createDataFrame([(i, 1, 0, "", "") for i in range(10)], LABELS)
    found = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(made(spark, rows), labels).collect()}
    first = found["hot", "EABCD", 1]
    assert (first["kept"], first["removed"], first["unique_fails"], first["good_lost"]) == (1, 2999, 0, 9)
    assert found["hot", "AEBCD", 1]["removed"] == 3000 and found["hot", "AEBCD", 2]["redundant"] == 2999
    assert found["x", "ABCDE", 2]["removed"] == 1 and found["x", "CABDE", 1]["removed"] == 1


def test_no_documents_or_no_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(made(spark, []), none).count() == 0
    found = filter_audit.audit(made(spark, [(1, None, None)]), none).collect()
    assert len(found) == 600 and {r["part"] for r in found} == {""} and sum(r["good_lost"] for r in found) == 0


def test_contraction_sums_what_it_selects():
    tensors = np.random.default_rng(0).integers(0, 9, (2, 2, 2, 2, 2, 2))
    orders, _ = filter_audit.plan()
    counts = filter_audit.contract(tensors)
    o = orders.index("CADEB")
    assert (counts[:, o, 2, 0] == tensors[:, 0, :, 0, 0].sum(axis=(1, 2))).all()
    assert (counts[:, o, 2, 1] == tensors[:, 0, :, 0, 1].sum(axis=(1, 2))).all()
    assert (counts[:, o, 2, 3] == tensors[:, 0, 0, 0, 1, 0]).all()
