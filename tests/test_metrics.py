"""Ranks, quantiles and metrics against brute force and published confusion matrices."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracemill.operators import metrics as m
from tracemill.operators import profiling as p
from tracemill.operators.ranking import ladder, number_bucket, quantile_points


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(map(int, y), map(float, s))), "y long, score double")


def test_number_bucket_keeps_order(spark):
    rng = random.Random(3)
    values = sorted({0.0, 1.0, 2.0, 8.0, 2.0**29, 1e-9, -1.0, -3.5, 3.0000001}
                    | {rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-8, 8) for _ in range(3000)}
                    | {2.0**k for k in range(-40, 40)})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [r["b"] for r in df.orderBy("v").select(number_bucket(F.col("v")).alias("b")).collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) > 1000


def test_quantiles_match_numpy(spark):
    rng = random.Random(5)
    groups = {
        "ints": [rng.randint(0, 50) for _ in range(501)], "one": [7], "same": [3] * 40,
        "wide": [rng.randint(0, 10**9) for _ in range(300)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v long")
    probs = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = quantile_points(ladder(df, "v", by=("g",)), "v", probs, by=("g",)).collect()
    assert len(got) == len(groups) * len(probs)
    for row in got:
        assert row["quantile"] == pytest.approx(np.quantile(groups[row["g"]], row["q"])), row


def brute(y, s, t):
    y, s = np.asarray(y), np.asarray(s, dtype=np.float32).astype(float)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, before = 0.0, 0.0
    for cut in sorted(set(s), reverse=True):
        hit = s >= cut
        recall = (hit & (y == 1)).sum() / len(pos)
        ap += (recall - before) * (hit & (y == 1)).sum() / hit.sum()
        before = recall
    return auc, ap, np.mean((s - y) ** 2), macro(y, s >= t)


def macro(y, hit):
    out = []
    for c in (0, 1):
        tp = ((y == c) & (hit == c)).sum()
        wrong = ((y == c) != (hit == c)).sum()
        out.append(2 * tp / (2 * tp + wrong) if tp + wrong else 0.0)
    return sum(out) / 2


@pytest.mark.parametrize("seed", range(3))
def test_metrics_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.2, 2 if seed else 6)
    got = m.binary_metrics(scored(spark, y, s), F.lit(0.4)).first()
    auc, ap, brier, f1 = brute(y, s, 0.4)
    assert got["roc_auc"] == pytest.approx(auc) and got["average_precision"] == pytest.approx(ap)
    assert got["brier"] == pytest.approx(brier) and got["macro_f1"] == pytest.approx(f1)

    s32 = s.astype(np.float32).astype(float)
    best, top = 0.5, -1.0
    for cut in np.unique(np.quantile(s32, np.linspace(0.01, 0.99, 99))):
        value = macro(y, s32 >= cut)
        if value > top + 1e-12:
            best, top = cut, value
    found = m.best_threshold(scored(spark, y, s)).first()["threshold"]
    assert macro(y, s32 >= found) == pytest.approx(top) and found == pytest.approx(best, abs=1e-6)


def test_small_known_case(spark):
    got = m.binary_metrics(scored(spark, [0, 0, 1, 1], [.1, .4, .35, .8]), F.lit(0.5)).first()
    assert got["roc_auc"] == pytest.approx(0.75) and got["average_precision"] == pytest.approx(0.8333, abs=1e-4)


def test_constant_score(spark):
    df = scored(spark, [0, 1, 1], [1.0] * 3)
    got = m.binary_metrics(df, F.lit(0.5)).first()
    assert got["roc_auc"] == 0.5 and m.best_threshold(df).first()["threshold"] == 0.5


# Published confusion matrices (tn, fp, fn, tp) with their macro-F1 and balanced accuracy.
@pytest.mark.parametrize("matrix,f1,balanced", [
    ((4, 36, 30, 911), 0.536575240494732, 0.5340595111583422),
    ((4, 35, 35, 880), 0.532156368221942, 0.532156368221942),
    ((4, 35, 54, 861), 0.5166650537665014, 0.5217738545607398),
    ((0, 39, 0, 915), 0.4895666131621188, 0.5),
])
def test_published_matrices(spark, matrix, f1, balanced):
    df = spark.createDataFrame([matrix], "tn long, fp long, fn long, tp long")
    row = df.select(*m.threshold_metrics()).first()
    assert row["macro_f1"] == pytest.approx(f1) and row["balanced_accuracy"] == pytest.approx(balanced)


def test_report_and_leaderboard(spark):
    df = spark.createDataFrame([(4, 36, 30, 911)], "tn long, fp long, fn long, tp long")
    rows = {r["label"]: r for r in m.classification_report(df).collect()}
    assert rows["1"]["recall"] == pytest.approx(911 / 941) and rows["0"]["support"] == 40
    assert rows["accuracy"]["precision"] == pytest.approx(915 / 981)
    val = spark.createDataFrame([("a", 0.6, 0.5), ("b", 0.7, 0.4)], "model string, val_roc_auc double, val_macro_f1 double")
    test = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "model string, test_roc_auc double")
    board = m.model_leaderboard(val, test).collect()
    assert [(r["model"], r["test_roc_auc"]) for r in board] == [("b", 0.2), ("a", None)]


def test_export_has_no_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,), (None,)], "v double")
    assert [r["v"] for r in m.finite_or_null(df).collect()] == [None, None, 1.5, None]


def test_describe_and_histogram_match_pandas(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.integers(0, 1000, 700), "b": np.full(700, 5)}
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(*data.values())], "a long, b long")
    rows = {r["metric"]: r for r in p.numeric_describe(df, ["a", "b"]).collect()}
    for name, v in data.items():
        assert rows[name]["mean"] == pytest.approx(v.mean()) and rows[name]["std"] == pytest.approx(v.std(ddof=1))
        assert rows[name]["p99"] == pytest.approx(np.quantile(v, 0.99))
    bins = p.clipped_histogram(df, ["a", "b"]).collect()
    clipped = np.minimum(data["a"], np.quantile(data["a"], 0.99))
    want, _ = np.histogram(clipped, bins=35)
    got = {r["bin"]: r["n_rows"] for r in bins if r["metric"] == "a"}
    assert [got.get(i, 0) for i in range(35)] == want.tolist()
    assert [r["n_rows"] for r in bins if r["metric"] == "b"] == [700]
