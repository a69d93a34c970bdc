from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracemill.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<double>, label int, score long, dims string"


def plain(rows, divisor, k=5):
    """Every pair in whole numbers, as Python has them."""
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (label, v)), (label, v))
    rows = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    hold = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    out = set()
    for a, (label, v) in rows.items():
        if a % divisor:
            continue
        scores = [(-hold(sum(x * y for x, y in zip(v, w))), i, other) for i, (other, w) in rows.items() if i != a and len(w) == len(v)]
        for p, i, _ in sorted(s for s in scores if s[2] == label)[:k]:
            found = sorted(s for s in scores if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out |= {(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(found, 1)}
    return out


def mined(spark, rows, divisor):
    frame = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], ROWS)
    found = [tuple(r) for r in hn.mine(frame, F.pmod("vec_id", F.lit(divisor)) == 0).collect()]
    assert len(found) == len(set(found))
    return set(found)


def clustered(rng, n, dims, labels, spread=0.4):
    centres = rng.standard_normal((labels, dims))
    out = []
    for i in range(n):
        c = int(rng.integers(labels))
        v = centres[c] + spread * rng.standard_normal(dims)
        out.append((i, (v / np.linalg.norm(v)).tolist(), int(c if rng.random() < .8 else rng.integers(labels))))
    return out


@pytest.mark.parametrize("dims", [64, 7, 100])
def test_equals_every_pair_scored(spark, monkeypatch, dims):
    monkeypatch.setattr(hn, "ROW_BLOCK", 120)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 20)
    rows = clustered(np.random.default_rng(dims), 400, dims, 4)
    found = mined(spark, rows, 9)
    assert found == plain(rows, 9) and len(found) > 100


def test_ties_nulls_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist(), int(rng.integers(3))) for i in range(60)]
    rows += [rows[3], (4, [0.5, 0.5, 0.5], 0), (None, [1.0, 1.0, 1.0], 1), (100, None, 1), (101, [1.0, 1.0, 1.0], None),
             (102, [1.0, None, 1.0], 1), (103, [math.nan, 1.0, 1.0], 1), (104, [math.inf, 1.0, 1.0], 1), (-10, [2.0, 2.0, 2.0], 1),
             (200, [], 1), (210, [], 1), (220, [], 2), (300, [1.0] * 5, 1), (301, [1.0] * 5, 1), (302, [0.9] * 5, 2)]
    found = mined(spark, rows, 10)
    assert found == plain(rows, 10)
    assert (300, 301, 1, 302, 327680, 294400) in found and any(r[0] == -10 for r in found) and (200, 210, 1, 220, 0, 0) in found


def test_large_numbers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(1, 9, 4) * 10.0 ** (6 + i % 2)).tolist(), i % 2) for i in range(40)]
    rows += [(1000 + i, (rng.integers(1, 9, 6) * 1e14).tolist(), i % 2) for i in range(20)]
    rows += [(2000 + i, (rng.integers(1, 9, 5) * 1e5).tolist(), i % 2) for i in range(40)]
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_no_rows_no_anchors_and_one_label(spark):
    assert mined(spark, [], 10) == set()
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)], 10) == set()
    assert mined(spark, [(0, [1.0], 1), (2, [1.0], 1)], 10) == set()


def test_many_copies_of_one_vector(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(900)]
    assert mined(spark, rows, 300) == plain(rows, 300)


def test_intervals_hold_the_scores_and_shrink():
    rng = np.random.default_rng(3)
    for dims in (1, 5, 64, 130):
        vectors = np.floor(256 * rng.standard_normal((200, dims)))
        words, numbers = hn.codes_of(vectors)
        block = object.__new__(hn.Block)
        block.dims, block.codes, block.vectors = dims, words, vectors
        block.norms, block.aligned, block.residual = numbers[:, 0], numbers[:, 1::2], numbers[:, 2::2]
        block.ones = np.bitwise_count(words).sum(axis=2, dtype=np.int64)
        asked = hn.Asked(vectors[:30])
        a, r = (x.ravel() for x in np.indices((30, 200)))
        true, estimate, slip, widths = vectors[a] * vectors[r], 0.0, 0.0, []
        true = true.sum(axis=1)
        for level in range(hn.LEVELS):
            shared = hn._shared(block.codes[r, level], asked.planes[level][a])
            estimate, slip, lower, upper = hn._interval(asked, block, a, r, level, shared, estimate, slip)
            assert ((lower <= true) & (true <= upper)).all()
            widths.append((upper - lower).mean())
        assert dims < 5 or widths[-1] < widths[0] / 3


def test_few_pairs_are_scored(monkeypatch):
    """The intervals leave a small part of the pairs."""
    table = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").rename(columns={"embedding": "vector"})
    frame = pd.concat(hn._coded([table.assign(anchor=table["vec_id"] % 100 == 0)]))
    labels = frame["label"].to_numpy()
    same = (frame["label"][frame["anchor"]].to_numpy()[:, None] == labels).sum()
    scored = []
    plain_score = hn._score
    monkeypatch.setattr(hn, "_score", lambda *x: scored.append(len(x[2])) or plain_score(*x))
    own = hn._positives(5)(frame, frame[frame["anchor"]])
    assert len(own) == 5 * frame["anchor"].sum() and sum(scored) < 0.2 * same
    scored.clear()
    asked = frame[frame["anchor"]].merge(own.groupby("anchor_id")["score"].unique().map(list).rename("scores"), left_on="vec_id", right_index=True)
    assert len(hn._negatives(5, 80, 100)(frame, asked)) and sum(scored) < 0.2 * (frame["anchor"].sum() * len(frame) - same)
