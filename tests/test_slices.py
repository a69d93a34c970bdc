"""Nested rows: wide child rows move once at most, and large tables go slice by slice."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tracemill.operators import enrichment
from tracemill.plans import analogs as a

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["build_trace", "sft_review", "sink_trace_parquet"])
def test_slices_give_the_rows_of_the_whole(spark, monkeypatch, name):
    query = __spark_entry__.queries()[name]
    whole = sorted(map(repr, query(spark, SF).collect()))
    monkeypatch.setattr(a, "REQUESTS_AT_ONCE", -(-a.table(spark, SF, "orders").count() // 3))
    assert len(a.slices(spark, SF)) == 3
    assert sorted(map(repr, query(spark, SF).collect())) == whole


def test_slices_hold_every_request_once(spark):
    rows = spark.createDataFrame(
        [(f"r{i % 7}", i) for i in range(500)] + [(None, 1), ("r", None), (None, None)], "repo_name string, pr_number long")
    parts = [a.Slice(4, k)(rows).collect() for k in range(4)]
    assert sorted(map(repr, sum(parts, []))) == sorted(map(repr, rows.collect())) and all(len(p) > 50 for p in parts)
    assert a.ALL(rows) is rows


@pytest.mark.parametrize("sent_whole", [1 << 30, 0])
def test_wide_child_rows_move_once_at_most(spark, monkeypatch, sent_whole):
    """Without the size check of the optimizer: small texts go to the keys, others are dealt out once, after the join."""
    monkeypatch.setattr(a, "SENT_WHOLE", sent_whole)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nested = enrichment.nest(enrichment.Child("c", a.review_comments(spark, SF), ["turn"], [F.col("body")]))
        plan = nested._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, _, below = plan.partition("Join")
    assert above.count("Exchange hashpartitioning") == (0 if sent_whole else 1)
    assert below.count("Exchange hashpartitioning(repo_name") == (1 if sent_whole else 0)


def test_a_link_joins_by_request_and_keeps_repeated_rows(spark):
    prs = spark.createDataFrame(
        [("o/r", 1, 7), ("o/r", 1, 8), ("o/r", 1, 7), ("o/r", 2, 7), ("o/r", 3, 9), ("o/r", 4, None), (None, 5, 7), ("o/r", None, 8)],
        "repo_name string, pr_number long, linked_issue_number long")
    issues = spark.createDataFrame(
        [("o/r", 7, False, "seven"), ("o/r", 7, None, "again"), ("o/r", 8, False, "eight"), ("o/r", 9, True, "nine"), (None, 7, False, "x")],
        "repo_name string, number long, is_pull_request boolean, title string")
    joined = enrichment.linked_issue_join(prs, issues, ["title"], 3)
    got = sorted(((r["repo_name"], r["pr_number"], r["linked_issue_number"], r["linked_issue"] and r["linked_issue"]["title"])
                  for r in joined.collect()), key=repr)
    both = lambda n: [("o/r", n, 7, "seven"), ("o/r", n, 7, "again")]
    assert got == sorted([*both(1), *both(1), ("o/r", 1, 8, "eight"), *both(2), ("o/r", 3, None, None), ("o/r", 4, None, None),
                          (None, 5, None, None), ("o/r", None, None, None)], key=repr)
    assert "hashpartitioning(repo_name" in joined._jdf.queryExecution().executedPlan().toString()
