from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tracemill.llm import quality

GOOD = "The house stands near the river. Nobody lives there now, but the garden is kept well.\nAnother line follows here."
BAD = "The%%% house*** stands$$$ near### the&&& river%%% nobody*** LIVES!! THERE!!"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, id long, host string, own double")


def test_classifier_with_shrunk_sites(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        host = f"h{i % 6}" if i % 50 else f"rare{i}"
        bad = rng.random() < (0.6 if host == "h0" else 0.1)
        rows.append((i, (BAD if bad else GOOD) + f" w{i}" * (i % 7), host, "ab"[i % 2], 1, "clash", 0.0))
        if i % 2:
            labels.append((i, 0 if bad else 1))
    out = {r["doc_id"]: r for r in quality.score(
        frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), F.col("source"), F.col("lang")).collect()}
    assert len(out) == 600
    for i, text, *_ in rows:
        assert out[i]["keep"] == (not text.startswith(BAD)), i
    global_rate = np.mean([out[i]["host_rate"] for i in out if out[i]["host"] != "h0"])
    h0 = np.mean([out[i]["host_rate"] for i in out if out[i]["host"] == "h0"])
    assert h0 < global_rate - 0.2
    rare = [out[i]["host_rate"] for i in out if out[i]["host"].startswith("rare")]
    # A site with one document, which is left out, has just its prior.
    assert np.ptp(rare) < 1e-9 and abs(np.mean(rare) - np.mean([out[i]["host_rate"] for i in out])) < 0.15
    for r in out.values():
        p = min(max(r["path_rate"], 1e-6), 1 - 1e-6)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-(math.log(p / (1 - p)) + r["evidence"]))), rel_tol=1e-9)


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = [(1, GOOD, "a", None, 1, "", 0.0), (2, BAD, None, "x", 1, "", 0.0), (3, None, None, None, 1, "", 0.0),
            (None, "", "a", "b", 1, "", 0.0), (1, GOOD, "a", None, 1, "", 0.0), (4, "w " * 50_000, "a", "b", 1, "", 0.0)]
    out = quality.score(frame(spark, rows), labels, F.col("source"), F.col("lang")).collect()
    assert len(out) == 6 and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 1}) == 1
    assert quality.score(frame(spark, []), labels, F.col("source"), F.col("lang")).count() == 0


def test_without_labels_of_both_kinds_all_stay(spark):
    rows = [(1, BAD, "a", "b", 1, "", 0.0)]
    for labels in ([], [(1, 1)], [(1, 0)]):
        out = quality.score(
            frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), F.col("source"), F.col("lang")).collect()
        assert [r["keep"] for r in out] == [True]
