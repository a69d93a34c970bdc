"""Splits, samples, assembly, features, models and the final run on small tables."""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracemill import schemas
from tracemill.operators import enrichment, features, modeling, splits
from tracemill.plans import analogs
from tracemill.plans.finalize import finalize, judge_nested
from tracemill.settings import AuditRules, ModelRules

SF = "/root/testdata/sf0.001"


def frame(spark, n_repos, rows_per_repo=3):
    rows = [(f"r{i}", f"r{i}__{j}", i % 2 if j else None) for i in range(n_repos) for j in range(rows_per_repo)]
    return spark.createDataFrame(rows, "repo string, example_id string, label long")


@pytest.mark.parametrize("n,expected", [(10, (8, 1, 1)), (5, (4, 0, 1)), (1, (0, 0, 1)), (101, (80, 10, 11))])
def test_split_sizes(spark, n, expected):
    rows = splits.split_by_repo(frame(spark, n).union(spark.createDataFrame([(None, "x", 1)], "a string, b string, c long")))
    found = {s: set() for s in ("train", "val", "test")}
    for r in rows.collect():
        found[r["split"]].add(r["repo"])
    assert tuple(len(v) for v in found.values()) == expected
    assert sum(len(v) for v in found.values()) == len(set.union(*found.values()))


def test_split_labeled(spark):
    rows = frame(spark, 10).union(spark.createDataFrame([("u", "u__1", None), (None, "n", 1)], "a string, b string, c long"))
    got = splits.split_labeled(rows, "label").collect()
    assert {r["split"] for r in got if r["repo"] in ("u", None)} == {"excluded"}
    assert all(r["in_matrix"] == (r["label"] is not None and r["split"] != "excluded") for r in got)
    assert len(got) == 32


def test_audit_sample(spark):
    rows = [(f"e{i}", (i % 3 > 0, 50 + i % 40)) for i in range(2000)] + [(None, (True, 80))]
    df = spark.createDataFrame(rows, "example_id string, quality struct<accepted:boolean,score:long>")
    got = splits.audit_sample(df, AuditRules(20, 10, 10)).collect()
    ids = [r["example_id"] for r in got]
    assert len(ids) == len(set(ids)) and 30 <= len(ids) <= 40
    assert sum(r["stratum"] == 1 for r in got) == 20 and sum(r["stratum"] == 2 for r in got) == 10


def test_a_long_listing_is_one_row(spark):
    spine = spark.createDataFrame([("o/r", 1), ("o/r", 2), ("o/r", 3)], "repo_name string, pr_number long")
    long_ = spark.range(25_000).select(F.lit("o/r").alias("repo_name"), F.lit(1).cast("long").alias("pr_number"), F.col("id").alias("pos"))
    short = spark.createDataFrame([("o/r", 2, i) for i in range(3)], "repo_name string, pr_number long, pos long")
    child = enrichment.Child("files", long_.unionByName(short).repartition(5), ["pos"], [F.col("pos").alias("p")])
    got = {r["pr_number"]: [x["p"] for x in r["files"]] for r in enrichment.assemble_enriched(spine, [child]).collect()}
    assert got == {1: list(range(25_000)), 2: [0, 1, 2], 3: []}


def test_link_join_keeps_requests_without_a_link_apart(spark):
    prs = spark.createDataFrame([("o/r", i, i if i % 3 == 0 else None, "x") for i in range(30)],
                                "repo_name string, pr_number long, linked_issue_number long, body string")
    issues = spark.createDataFrame([("o/r", i, i == 9) for i in range(0, 20, 3)], "repo_name string, number long, is_pull_request boolean")
    issues = issues.withColumn("title", F.col("number").cast("string"))
    got = {r["pr_number"]: (r["linked_issue_number"], r["linked_issue"]) for r in
           enrichment.linked_issue_join(prs, issues, ["title"]).collect()}
    assert len(got) == 30 and {k for k, v in got.items() if v[0] is not None} == {0, 3, 6, 12, 15, 18}
    assert all(v[0] is not None and v[1]["title"] == str(k) for k, v in got.items() if v[1] is not None)


def test_patch_sizes_equal_the_text(spark):
    from tracemill.operators.traces import source_patch_text

    rows = analogs.enriched(spark, SF).withColumn("text", source_patch_text(F.col("files")))
    whole = rows.filter("text <> ''").select(
        *enrichment.KEY, F.length("text").cast("long").alias("c"), features.token_count(F.col("text")).alias("t"))
    summed = features.patch_sizes(analogs.changed_files(spark, SF))
    joined = whole.join(summed, enrichment.KEY)
    bad = joined.filter("c <> source_patch_char_count or t <> source_patch_token_count_raw")
    assert joined.count() == whole.count() > 500 and bad.count() == 0


def test_embedding_and_encoder(spark):
    rows = spark.createDataFrame([("a", "x y x"), ("b", ""), ("c", None)], "example_id string, text string")
    got = {r["example_id"]: np.array(r["diff_emb"]) for r in features.hashed_embedding(rows, "text", width=16).collect()}
    assert got["a"].size == 16 and np.linalg.norm(got["a"]) == pytest.approx(1) and not got["b"].any()
    encoder = lambda texts: np.array([[len(t), 1.0] for t in texts])
    out = features.encode_batches(rows, "text", encoder, batch_size=2).collect()
    assert {r["example_id"]: list(r["diff_emb"]) for r in out} == {"a": [5, 1], "b": [0, 1], "c": [0, 1]}


def test_many_categories_get_a_bounded_number_of_columns(spark):
    rows = spark.createDataFrame([(f"e{i}", "python", f"A{i % 30 if i > 40 else 0}") for i in range(200)] + [("n", None, None)],
                                 "example_id string, top_language string, author_association string")
    assert len(features.observed_associations(rows)) == 31
    few = features.observed_associations(rows, 3)
    assert list(few)[-1] is None and few[None] == "other" and "A0" in few and len(few) == 4
    flagged, columns = features.one_hot(rows, few)
    authors = [c for c in columns if c.startswith("author_")]
    assert authors[-1] == "author_other" and len(authors) == 4
    assert all(sum(r[c] for c in authors) == 1 for r in flagged.collect())


def test_leakage_is_refused():
    features.leakage_check(features.NUMERIC_COLUMNS)
    with pytest.raises(ValueError):
        features.leakage_check([*features.NUMERIC_COLUMNS, "num_reviews"])


def test_models_learn_and_score(spark):
    rng = np.random.default_rng(0)
    data = [(f"e{i}", "train" if i % 4 else "val", float(x), int(x + rng.normal() > 1)) for i, x in enumerate(rng.normal(size=400))]
    rows = spark.createDataFrame(data, "example_id string, split string, x double, review_concern long")
    rows = rows.withColumn("diff_emb", F.array(F.col("x").cast("float"), F.lit(0.5).cast("float")))
    matrix = modeling.load_matrices(rows.withColumn("k", F.lit(1.0)), ["x", "k"])
    train = modeling.balanced_weights(matrix.filter("split = 'train'"))
    sums = {r["y"]: r["w"] for r in train.groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0.0] == pytest.approx(sums[1.0])
    rules = ModelRules(trees=25)  # every tree counts with its step, the first one too
    for name in (modeling.LOGISTIC_TABULAR, modeling.LOGISTIC_ALL, modeling.BOOSTED_TABULAR, modeling.BOOSTED_ALL):
        model, _ = modeling.fit_model(name, train, rules)
        got = modeling.score_rows(model, matrix.filter("split = 'val'"), threshold=0.5)
        means = {r["y"]: r["s"] for r in got.groupBy("y").agg(F.avg("score").alias("s")).collect()}
        assert means[1.0] > means[0.0] + 0.1, name
        assert got.filter("(score >= 0.5) <> (pred = 1)").count() == 0
    top = modeling.feature_importance(model, ["x", "k", "e0", "e1"]).collect()
    assert top[0]["feature"] in ("x", "e0")


def test_finalize_from_json_lines(spark, tmp_path):
    """Nested rows from a JSON lines file through the whole run."""
    body = "this comment is long enough to count"
    rows = []
    for i in range(60):
        rows.append({
            "repo_name": f"o/r{i % 12}", "pr_number": i,
            "pr": {"merged": i % 5 > 0, "user": {"login": "dev"}, "changed_files": 2, "additions": 60, "deletions": 1, "title": f"t{i}"},
            "files": [{"filename": "a.py", "patch": "@@", "additions": 1, "deletions": 0}, {"filename": "b.md"}],
            "reviews": [{"state": "COMMENTED"}], "review_comments": [{"path": "a.py", "body": body}] * 2,
            "pr_comments": [{"body": body}] * 2, "full_diff": "d" if i % 7 else "", "linked_issue_comments": [], "api_errors": [],
        })
    path = tmp_path / "raw.jsonl"
    path.write_text("\n\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    from tracemill.sources.readers import scan_jsonl

    nested = scan_jsonl(spark, str(path), schemas.ENRICHED)
    failures = scan_jsonl(spark, str(tmp_path / "none"), schemas.FAILURE)
    out = str(tmp_path / "out")
    steps = {(r["step"], r["metric"]): r["value"] for r in finalize(judge_nested(nested), failures, out).collect()}
    good = sum(1 for i in range(60) if i % 5 and i % 7)
    assert steps["process", "processed"] == 60 and steps["process", "accepted"] == good
    assert steps["sft", "review_sft_rows"] == good == steps["sft", "issue_to_patch_sft_rows"]
    assert steps["report", "failed_api_fetch"] == 0 and steps["card", "unique_repos"] == 12
    assert sum(v for (s, k), v in steps.items() if s == "features") == 60
    chat = [json.loads(line) for p in (tmp_path / "out" / "review_sft").glob("*.json") for line in p.read_text().splitlines()]
    assert len(chat) == good and chat[0]["messages"][1]["content"].startswith("PR title:\nt")
    assert "PR description:\nNone" in chat[0]["messages"][1]["content"]
    assert chat[0]["messages"][2]["content"].startswith("File: a.py\nComment: this")


def test_rows_of_a_large_repository_are_dealt_out(spark, monkeypatch):
    """Same splits as without; no task gets the rows of the large repository together."""
    rows = spark.createDataFrame([("big" if i % 2 else f"r{i % 40}", i, 1) for i in range(2000)] + [(None, -1, 1)], "repo string, n long, label int")
    plain = {(r["repo"], r["n"], r["split"]) for r in splits.split_labeled(rows, "label").collect()}
    monkeypatch.setattr(splits, "LARGE_REPO", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = splits.split_labeled(rows, "label")
        places = Counter(r["p"] for r in found.withColumn("p", F.spark_partition_id()).collect() if r["repo"] == "big")
        assert {(r["repo"], r["n"], r["split"]) for r in found.collect()} == plain and found.columns == splits.split_labeled(rows, "label").columns
        assert len(places) > 1 and max(places.values()) < 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nested_rows_come_in_partitions_of_few_requests(spark, monkeypatch):
    from tracemill.plans import analogs as a

    sf_dir = "/root/testdata/sf0.001"
    monkeypatch.setattr(a, "REQUESTS_TOGETHER", 100)
    parts = a.request_parts(spark, sf_dir)
    assert parts == -(-a.table(spark, sf_dir, "orders").count() // 100)
    for child in a.children(spark, sf_dir):
        assert child.rows.rdd.getNumPartitions() == parts
    assert a.counts(spark, sf_dir).rdd.getNumPartitions() == parts
