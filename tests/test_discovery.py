"""Candidate discovery and selection on hand-made rows."""

from __future__ import annotations

import gzip
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tracemill.operators import discovery as d
from tracemill.operators import selection as s
from tracemill.operators.ranking import digest_rank, take_by_digest
from tracemill.sources import readers as r
from tracemill.streaming.landing import land_events


def close(number, merged=True, created="2025-01-01T00:00:00Z", action="closed", **fields):
    pr = {"number": number, "merged": merged, "title": "T", "additions": 40, "deletions": 20, "changed_files": 3, **fields}
    return {"type": "PullRequestEvent", "repo": {"name": "o/r"}, "created_at": created,
            "payload": {"action": action, "pull_request": pr}}


def note(kind, payload, created="2025-01-02T00:00:00Z"):
    return {"type": kind, "repo": {"name": "o/r"}, "created_at": created, "payload": payload}


def talk(number, comments=2, reviews=1, review_comments=2):
    own = {"pull_request": {"number": number}}
    return (
        [note(d.COMMENT_EVENT, {"issue": {"number": number}})] * comments + [note(d.REVIEW_EVENT, own)] * reviews
        + [note(d.REVIEW_COMMENT_EVENT, own)] * review_comments
    )


def activity(spark, events):
    lines = [(json.dumps(e), i) for i, e in enumerate(events)]
    parsed = r.parse_event_lines(spark.createDataFrame(lines, "value string, seq int"))
    return d.parse_activity(parsed.filter(~F.col("is_bad_json")))


def run(spark, events, **kw):
    rows = d.candidates(activity(spark, events), F.col("seq"), **kw).collect()
    return {row["pr_number"]: row for row in rows}


def test_merged_flags(spark):
    events = [close(1), close(2, merged="True"), close(3, merged=False), close(4, action="opened"), close(5, merged=None)]
    for n in range(1, 6):
        events += talk(n)
    assert sorted(run(spark, events)) == [1, 2]
    assert sorted(run(spark, events, variant="distinct")) == [1]


def test_last_known_metadata(spark):
    events = [close(1, additions=60), close(1, title="", additions=0, deletions=70, created="2025-01-03T00:00:00Z"), *talk(1)]
    row = run(spark, events)[1]
    assert (row["pr_title"], row["additions"], row["deletions"]) == ("T", 0, 70)
    assert row["first_seen_at"] == row["last_seen_at"] == "2025-01-02T00:00:00Z"
    assert len(d.candidates(activity(spark, events), F.col("seq"), variant="distinct").collect()) == 2


def test_number_resolution(spark):
    events = [
        note(d.REVIEW_EVENT, {"pull_request": {"number": 1}}),
        note(d.COMMENT_EVENT, {"issue": {"number": 2}}),
        note(d.COMMENT_EVENT, {"pull_request": {"number": 3}, "issue": {"number": 9}}),
        note(d.COMMENT_EVENT, {}),
        note(d.COMMENT_EVENT, {"pull_request": {"number": "12"}}),
        note(d.COMMENT_EVENT, {"pull_request": {"number": "x"}, "issue": {"number": 5}}),
    ]
    got = [x["pr_number"] for x in d.pr_number_resolve(activity(spark, events)).orderBy("seq").collect()]
    assert got == [1, 2, 3, 12, 5]


def test_invalid_events(spark):
    bad = [{**close(1), "repo": None}, {**close(1), "created_at": ""}, {**close(1), "payload": [1]}, {**close(1), "payload": "x"}]
    assert activity(spark, bad).count() == 0


@pytest.mark.parametrize("fields,counts,kept", [
    ({"changed_files": 2}, {}, True), ({"changed_files": 30}, {}, True), ({"changed_files": 1}, {}, False),
    ({"changed_files": 31}, {}, False), ({"changed_files": None}, {}, False),
    ({"additions": 30}, {}, True), ({"additions": 29}, {}, False), ({"additions": 1980}, {}, True),
    ({"additions": 1981}, {}, False), ({"additions": None, "deletions": 60}, {}, True),
    ({}, {"comments": 1}, False), ({}, {"reviews": 0}, False), ({}, {"review_comments": 1}, False),
])
def test_thresholds(spark, fields, counts, kept):
    assert (7 in run(spark, [close(7, **fields), *talk(7, **counts)])) is kept


def test_null_sizes_differ_by_variant(spark):
    events = [close(7, additions=None, deletions=60), *talk(7)]
    assert not run(spark, events, variant="distinct")


def test_event_log_scan(spark, tmp_path):
    for hour in range(3):
        with gzip.open(tmp_path / f"2025-01-01-{hour}.json.gz", "wt") as handle:
            handle.write(json.dumps(close(hour)) + "\n\n{broken\n   \n")
    events = r.scan_event_log(spark, f"{tmp_path}/*.json.gz")
    stats = d.event_log_stats(events).first()
    assert (stats["input_files"], stats["parsed_events"], stats["json_errors"]) == (3, 3, 3)
    limited = d.event_log_stats(r.scan_event_log(spark, f"{tmp_path}/*.json.gz", limit_files=2)).first()
    assert limited["input_files"] == 2
    missing = r.hourly_coverage(
        r.expected_dumps(spark, "2025-01-01", "2025-01-02"), events.select("file_name"))
    assert missing.count() == 45
    with pytest.raises(ValueError):
        r.expected_dumps(spark, "2025-01-02", "2025-01-01")


def test_landing_takes_each_dump_once(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    for hour in range(2):
        with gzip.open(source / f"2025-01-01-{hour}.json.gz", "wt") as handle:
            handle.write(json.dumps(close(hour)) + "\n")
        land_events(spark, str(source), out, mark)
    land_events(spark, str(source), out, mark)
    assert spark.read.parquet(out).count() == 2


def test_candidate_directory(spark, tmp_path):
    header = "repo_name,pr_number,pr_body\n"
    (tmp_path / "candidate_prs_a.csv").write_text("﻿" + header + 'o/r,1,"a ""q""\nb"\n', encoding="utf-8")
    (tmp_path / "candidate_prs_b.csv").write_text(header + "o/r,2,é\n", encoding="utf-8")
    schema = r.schemas.struct(repo_name=r.schemas.TEXT, pr_number=r.schemas.LONG, pr_body=r.schemas.TEXT)
    rows = r.scan_candidates_dir(spark, str(tmp_path), schema=schema).orderBy("pr_number").collect()
    assert [(x["pr_body"], x["file_name"]) for x in rows] == [
        ('a "q"\nb', "candidate_prs_a.csv"), ("é", "candidate_prs_b.csv")]
    with pytest.raises(FileNotFoundError):
        r.scan_candidates_dir(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        r.scan_candidates_dir(spark, str(tmp_path), pattern="x*.csv")


@pytest.mark.parametrize("counts,total,expected", [
    ({"a": 5, "b": 1, "c": 9}, 9, [4, 1, 4]), ({"a": 5, "b": 1, "c": 9}, 20, [5, 1, 9]),
    ({"a": 3, "b": 3, "c": 3}, 4, [2, 1, 1]), ({"a": 3, "b": 3}, 0, [0, 0]),
    # The remainder of the first round and the surplus of the second both go to the first strata.
    ({"a": 100, "b": 100, "c": 100, "d": 2}, 14, [5, 4, 3, 2]),
])
def test_quotas(spark, counts, total, expected):
    df = spark.createDataFrame(list(counts.items()), "f string, n long")
    got = s.quota_rebalance(df, "f", "n", total).orderBy("f").collect()
    assert [x["quota"] for x in got] == expected


def test_balanced_sample_with_one_hot_file(spark):
    rows = [("hot", f"k{i}") for i in range(3000)] + [("a", f"a{i}") for i in range(5)] + [("b", f"b{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "f string, key string")
    got = s.balanced_sample(df, "f", "key", 105, 42).collect()
    by_file = {f: len(list(g)) for f, g in itertools.groupby(sorted(x["f"] for x in got))}
    assert by_file == {"a": 5, "b": 50, "hot": 50} and len({x["key"] for x in got}) == 105
    again = s.balanced_sample(df.repartition(7), "f", "key", 105, 42).collect()
    assert {x["key"] for x in again} == {x["key"] for x in got}
    assert s.balanced_sample(df, "f", "key", 10**6, 42).count() == len(rows)
    assert s.shuffled(s.balanced_sample(df, "f", "key", None, 42), "key").count() == len(rows)


def test_digest_rank_is_a_permutation(spark):
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("h"))
    for digits in (1, 4):
        ranked = digest_rank(df, "h", digits=digits).collect()
        assert [x["h"] for x in sorted(ranked, key=lambda x: x["rank"])] == sorted(x["h"] for x in ranked)
        assert {x["total"] for x in ranked} == {2000}


def test_take_by_digest_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), f"{rng.getrandbits(12):03x}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, h string, i int")
    quotas = {"a": 0, "b": 17, "c": 5000}
    got = take_by_digest(df, spark.createDataFrame(list(quotas.items()), "g string, quota int"), "h", ("g",), ("i",), 1)
    want = []
    for g, q in quotas.items():
        want += sorted((r for r in rows if r[0] == g), key=lambda x: (x[1], x[2]))[:q]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_keep_first_and_seen(spark):
    rows = [("o/a", "1", 0, "x"), ("o/a", "01", 1, "y"), ("o/b", "2", 2, "z"), ("o/a", "1", 3, "w")]
    df = s.with_key(spark.createDataFrame(rows, "repo_name string, pr_number string, seq int, v string"))
    got = {x["key"]: (x["v"], x["copies"]) for x in s.dedup_keep_first(df, "key", F.col("seq")).collect()}
    assert got == {"o/a#1": ("x", 3), "o/b#2": ("z", 1)}
    assert s.dedup_keep_first(df, "key", F.col("seq"), limit=1).first()["v"] == "x"
    assert s.dedup_keep_first(df, "key", F.col("seq"), offset=1, limit=1).first()["v"] == "y"
    seen = s.seen_keys(
        spark.createDataFrame([("", "o/a", 1)], "repo_name string, repo string, pr_number long"),
        spark.createDataFrame([("o/b", None)], "repo_name string, pr_number long"))
    assert [x["key"] for x in seen.collect()] == ["o/a#1"]
    assert {x["key"] for x in s.anti_join_seen(df, seen).collect()} == {"o/b#2"}
