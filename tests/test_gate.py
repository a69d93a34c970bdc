"""The quality gate on hand-made requests, from nested rows and from child tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tracemill import schemas
from tracemill.operators import files as fj, gate
from tracemill.plans.finalize import judge_nested
from tracemill.settings import GateRules

LONG = "this comment is long enough to count"


def base():
    user = {"login": "dev", "type": "User"}
    return {
        "repo_name": "o/r", "pr_number": 1,
        "pr": {"merged": True, "user": user, "changed_files": 3, "additions": 60, "deletions": 20, "title": "t"},
        "files": [{"filename": f"src/a{i}.py", "patch": "@@"} for i in range(3)],
        "reviews": [{"state": "APPROVED"}],
        "review_comments": [{"body": LONG} for _ in range(3)],
        "pr_comments": [{"body": LONG} for _ in range(3)],
        "full_diff": "diff", "linked_issue_comments": [], "api_errors": [],
    }


def change(**kw):
    row = base()
    for key, value in kw.items():
        if key in ("merged", "changed_files", "additions", "deletions", "login"):
            target = row["pr"]["user"] if key == "login" else row["pr"]
            target[key] = value
        else:
            row[key] = value
    return row


def named(*names):
    return [{"filename": n, "patch": "@@"} for n in names]


CASES = [
    (change(), "", 80),
    (change(reviews=[{"state": "COMMENTED"}]), "", 85),
    (change(reviews=[{"state": "CHANGES_REQUESTED"}, {"state": "COMMENTED"}]), "", 90),
    (change(reviews=[{"state": "changes_requested"}]), "", 80),
    (change(merged=False), "not_merged", 60),
    (change(merged=None), "not_merged", 60),
    (change(login="renovate-x"), "bot_author", 60),
    (change(files=named("docs/a.py", "docs/b.py")), "docs_only", 60),
    (change(files=named("README.md")), "docs_only,no_source_files,no_source_patches", 40),
    (change(files=named("go.sum", "yarn.lock")), "lockfile_only,no_source_files,no_source_patches", 40),
    (change(files=named("vendor/a.go")), "generated_or_vendor_only", 60),
    (change(files=[], changed_files=None), "bad_changed_files_count,no_files,no_source_files,no_source_patches", 60),
    (change(files=[{"filename": "a.py", "patch": ""}, {"filename": "b.py"}]), "no_source_patches", 70),
    (change(review_comments=[{"body": LONG}, {"body": "x" * 29}]), "not_enough_meaningful_review_comments", 60),
    (change(review_comments=[{"body": "x" * 30}]),
     "not_enough_review_comments,not_enough_meaningful_review_comments", 60),
    (change(pr_comments=[{"body": LONG}]), "not_enough_discussion", 70),
    (change(full_diff=""), "missing_full_diff", 80),
    (change(additions=29), "bad_diff_size", 70),
    (change(additions=1981), "bad_diff_size", 70),
    (change(additions=30), "", 80),
    (change(changed_files=0), "", 80),
    (change(changed_files=31), "bad_changed_files_count", 80),
]


@pytest.fixture(scope="module")
def nested(spark):
    rows = [json.dumps({**row, "pr_number": i}) for i, (row, _, _) in enumerate(CASES)]
    return spark.createDataFrame([(r,) for r in rows], "v string").select(
        F.from_json("v", schemas.ENRICHED).alias("r")).select("r.*")


def verdicts(judged):
    q = judged.select("pr_number", F.array_join("quality.reject_reasons", ",").alias("r"), "quality.*")
    return {r["pr_number"]: r for r in q.collect()}


def test_nested_gate(nested):
    got = verdicts(gate.quality_gate(gate.nested_facts(nested)))
    for i, (_, reasons, score) in enumerate(CASES):
        assert (got[i]["r"], got[i]["score"]) == (reasons, score), CASES[i][0]
        assert got[i]["accepted"] == (reasons == "" and score >= 70)
        assert got[i]["tier"] == ("mvp_silver" if got[i]["accepted"] else "rejected")


def test_child_tables_give_the_same_facts(nested):
    child = lambda c: nested.select(*gate.KEY, F.explode(c).alias("x")).select(*gate.KEY, "x.*")
    counts = gate.child_counts(child("files"), child("reviews"), child("review_comments"), child("pr_comments"))
    flat = nested.select(*gate.KEY, *gate.gate_inputs("pr."), "full_diff")
    left = verdicts(gate.quality_gate(gate.attach_counts(flat, counts)))
    right = verdicts(gate.quality_gate(gate.nested_facts(nested)))
    assert left == right


def test_toggles(nested):
    off = GateRules(
        require_source_patch=False, store_full_diff=False, exclude_bots=False, exclude_docs_only=False,
        exclude_lockfile_only=False, exclude_generated_vendor_only=False, exclude_trivial_review_comments=False,
    )
    got = verdicts(gate.quality_gate(gate.nested_facts(nested), off))
    assert got[6]["r"] == "" and got[6]["score"] == 80
    assert got[12]["r"] == "" and got[13]["meaningful_review_comment_count"] == 2
    assert got[16]["r"] == ""


def test_label(spark):
    rows = [(0, 0, 0, 0), (1, 0, 0, 0), (1, 1, 0, 0), (0, 0, 2, 2), (0, 0, 2, 1)]
    df = spark.createDataFrame(
        rows, "review_count long, changes_requested_count long, review_comment_count long, meaningful_count long")
    assert [r[0] for r in df.select(gate.review_concern_label()).collect()] == [None, 0, 1, 1, 0]
    eda = df.select(gate.review_concern_label(exclude_inactive=False)).collect()
    assert [r[0] for r in eda] == [0, 0, 1, 1, 0]


def test_top_language_tie_goes_to_the_first_file(spark):
    rows = [("o/r", 1, 0, "a.go"), ("o/r", 1, 1, "b.py"), ("o/r", 1, 2, "c.py"), ("o/r", 1, 3, "d.go"), ("o/r", 2, 0, "x.md")]
    df = spark.createDataFrame(rows, "repo_name string, pr_number long, pos int, filename string")
    got = {r["pr_number"]: r["top_language"] for r in fj.top_language(df, F.col("pos")).collect()}
    assert got == {1: "go", 2: "unknown"}


def test_trace_blocks(nested):
    trace = judge_nested(nested)
    assert trace.columns == [
        "example_id", "repo", "pr_number", "pr_url", "linked_issue_number", "linked_issue_url", "issue", "discussion",
        "pr", "review", "code_diff", "quality", "provenance"]
    row = trace.filter("pr_number = 0").first()
    assert row["example_id"] == "o__r__pull_0" and row["issue"]["author"] is None and row["issue"]["comments"] == []
    assert len(row["code_diff"]["files"]) == 3 and row["pr"]["author"]["login"] == "dev"


def test_child_rows_move_as_flags_and_languages_are_counted(spark):
    key = "repo_name string, pr_number long, "
    files = [("r", 1, "a.py", "+"), ("r", 1, "a.py", "+"), ("r", 1, "b.PY", None), ("r", 1, "c.h", ""), ("r", 1, None, "+"),
             ("r", 2, "docs/x.md", "+"), ("r", 2, "", "+"), ("r", None, "a.go", "+"), (None, 2, "a.go", "+"), (None, 2, "a.cs", "+")]
    long = "x" * 30
    counts = gate.child_counts(
        spark.createDataFrame(files, key + "filename string, patch string"),
        spark.createDataFrame([("r", 1, "approved"), ("r", 3, None), ("r", 3, "COMMENTED")], key + "state string"),
        spark.createDataFrame([("r", 1, long), ("r", 1, long), ("r", 2, None)], key + "body string"),
        spark.createDataFrame([("r", 1), ("r", 4)], key.rstrip(", ")), parts=5, languages=True)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and counts.rdd.getNumPartitions() == 5
    dealt = counts._jdf.queryExecution().optimizedPlan().children().head()
    assert dealt.output().size() == len(gate.KEY) + 1
    got = {(r["repo_name"], r["pr_number"]): {c: n for c, n in r.asDict().items() if c not in gate.KEY and n} for r in counts.collect()}
    named = {"file_count": 5, "named_count": 4, "source_file_count": 4, "source_patch_count": 2, "python_files": 3, "c/c++_files": 1}
    assert got["r", 1] == {**named, "review_count": 1, "approved_count": 1, "review_comment_count": 2, "meaningful_count": 2, "discussion_count": 1}
    assert got["r", 2] == {"file_count": 2, "named_count": 1, "doc_count": 1, "review_comment_count": 1}
    assert got["r", 3] == {"review_count": 2, "commented_exact": 1, "commented_count": 1} and got["r", 4] == {"discussion_count": 1}
    one = {"file_count": 1, "named_count": 1, "source_file_count": 1, "source_patch_count": 1, "go_files": 1}
    assert got["r", None] == one and len(got) == 6
    assert got[None, 2] == {**{c: 2 * n for c, n in one.items() if c != "go_files"}, "go_files": 1, "c#_files": 1}
