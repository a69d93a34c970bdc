"""Sketches of landings against exact numbers, and distances between releases."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tracemill.operators import drift, sketches


def sketched(spark, values, hours):
    frame = spark.createDataFrame([(int(h), float(v), f"r{int(v * 10) % 3000}") for h, v in zip(hours, values)], "hour long, v double, repo string")
    return frame, sketches.batch_sketches(frame, F.col("hour"), {"v": F.col("v")}, {"repo": F.col("repo")})


def test_merged_hours_give_the_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.lognormal(3, 2, 6000), -rng.lognormal(1, 1, 500), np.zeros(300)])
    frame, found = sketched(spark, values, rng.integers(0, 24, len(values)))
    assert found.groupBy("measure").count().filter("count = 24").count() == 2
    ordered, got = np.sort(values), {r["step"]: r["quantile"] for r in sketches.merged_quantiles(found).collect()}
    assert sorted(got) == list(range(21))
    for step, quantile in got.items():
        exact = ordered[max(math.ceil(len(values) * step / 20), 1) - 1]
        assert abs(quantile - exact) <= abs(exact) / sketches.STEPS + 1e-12
    totals = {r["measure"]: r for r in sketches.merged_totals(found).collect()}
    assert totals["v"]["n"] == len(values) and abs(totals["v"]["total"] - values.sum()) < 1e-6 * abs(values).sum()
    assert (totals["v"]["least"], totals["v"]["most"]) == (values.min(), values.max())
    exact = frame.select("repo").distinct().count()
    assert abs(totals["repo"]["distinct_values"] - exact) < 0.06 * exact


def test_order_and_split_of_landings_change_nothing(spark):
    values = np.random.default_rng(1).integers(0, 10**6, 2000).astype(float)
    one = sketched(spark, values, np.zeros(2000))[1]
    many = sketched(spark, values[::-1], np.arange(2000) % 17)[1]
    rows = lambda s: sorted(map(tuple, sketches.merged_quantiles(s).collect()))
    assert rows(one) == rows(many)


def releases(spark, rows):
    frame = spark.createDataFrame(rows, "release string, language string, size long")
    return frame, drift.histograms(frame, F.col("release"), {"language": F.col("language"), "size": drift.size_bucket(F.col("size"))})


def test_a_planted_shift_is_flagged_and_a_reordered_table_is_not(spark):
    rng = np.random.default_rng(2)
    mix = lambda shares, n: rng.choice(["py", "go", None], n, p=shares).tolist()
    sizes = rng.integers(0, 500, 3000).tolist()
    rows = [("2021", x, s) for x, s in zip(mix([.7, .2, .1], 3000), sizes)]
    rows += [("2022", x, s) for (_, x, s) in rows[::-1]]
    rows += [("2023", x, s) for x, s in zip(mix([.2, .7, .1], 3000), sizes)]
    _, counts = releases(spark, rows)
    got = {(r["release"], r["measure"]): r for r in drift.distances(counts).collect()}
    assert set(got) == {(y, m) for y in ("2022", "2023") for m in ("language", "size")}
    for m in ("language", "size"):
        assert got["2022", m]["alarm"] == "none" and abs(got["2022", m]["psi"]) < 1e-9 and got["2022", m]["js_distance"] < 1e-6
    assert got["2023", "language"]["alarm"] == "strong" and got["2023", "size"]["alarm"] == "none"
    share = lambda r: np.array([sum(a == r and b == x for a, b, _ in rows) for x in ("py", "go", None)])
    n1, n0 = share("2023"), share("2022")
    p, q = (n1 + .5) / (n1.sum() + 1.5), (n0 + .5) / (n0.sum() + 1.5)
    assert abs(got["2023", "language"]["psi"] - ((p - q) * np.log(p / q)).sum()) < 1e-9


def test_disjoint_and_missing_measures(spark):
    _, counts = releases(spark, [("a", "x", 1)] * 5 + [("b", "y", 1)] * 5 + [(None, "z", 1)])
    got = {r["measure"]: r for r in drift.distances(counts, counts.limit(0)).collect()}
    assert abs(got["language"]["js_distance"] - 1) < 1e-12 and got["size"]["js_distance"] == 0
    assert drift.distances(counts.filter("release = 'a'")).count() == 0


def test_histograms_are_made_once_for_both_sides_of_a_comparison(spark):
    frame, counts = releases(spark, [("a", "x", 1), ("b", "x", 2), ("c", None, 9)])
    found = drift.distances(counts)
    assert "Generate" in counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 4
    weighted = drift.histograms(frame, F.col("release"), {"language": F.col("language")}, weight=F.col("size"))
    assert {tuple(r) for r in weighted.collect()} == {("a", "language", "x", 1), ("b", "language", "x", 2), ("c", "language", "(none)", 9)}


def test_release_distances_reads_the_files_of_requests_once(spark, monkeypatch):
    from tracemill.plans import analogs, profile_queries

    read, table = [], analogs.table
    monkeypatch.setattr(analogs, "table", lambda spark, sf_dir, name: read.append(name) or table(spark, sf_dir, name))
    assert profile_queries.release_distances(spark, "/root/testdata/sf0.001").count() > 0
    assert read.count("lineitem") == 1
