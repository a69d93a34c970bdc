"""Batches that are there as a whole or not at all, the view of dumps built on them, and distributed places."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracemill.operators import discovery as d, selection as s
from tracemill.operators.ranking import kth_in_order
from tracemill.schemas import LONG, TEXT, struct
from tracemill.sources import writers as w
from tracemill.sources.batches import BatchTable
from tracemill.sources.readers import scan_event_log
from tracemill.streaming import landing

ROWS = struct(key=TEXT, run=LONG)


def rows(spark, keys, run):
    return spark.createDataFrame([(k, run) for k in keys], "key string, run long")


def test_a_run_that_dies_leaves_nothing(spark, tmp_path, monkeypatch):
    table = BatchTable(spark, str(tmp_path / "t"))
    assert w.incremental_append(table, "one", rows(spark, ["a", "b"], 1), rows(spark, ["c"], 1))
    plain, calls = w.sink_jsonl, []

    def dying(df, path, mode="overwrite"):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        plain(df, path, mode)

    monkeypatch.setattr(w, "sink_jsonl", dying)
    with pytest.raises(OSError):
        w.incremental_append(table, "two", rows(spark, ["d"], 2), rows(spark, ["e"], 2))
    monkeypatch.undo()
    seen = lambda part: sorted(tuple(r) for r in table.read(part, ROWS, "json").collect())
    assert seen("outcomes") == [("a", 1), ("b", 1)] and seen("failures") == [("c", 1)]
    assert w.incremental_append(table, "two", rows(spark, ["d"], 2), rows(spark, ["e"], 2))
    assert not w.incremental_append(table, "two", rows(spark, ["x"], 3), rows(spark, ["y"], 3))
    assert seen("outcomes") == [("a", 1), ("b", 1), ("d", 2)] and seen("failures") == [("c", 1), ("e", 2)]
    left = w.not_appended(table, rows(spark, ["a", "c", "e", "f", None], 9))
    assert {r["key"] for r in left.collect()} == {"f", None}


def test_later_runs_read_only_folders_of_their_keys(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"))
    for run in range(2):
        w.incremental_append(table, f"r{run}", rows(spark, [f"{run}-{i}" for i in range(400)], run), rows(spark, [], run))
    left = w.not_appended(table, rows(spark, ["0-7", "1-9", "new"], 5))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan, plan
    found = {r["key"] for r in left.collect()}
    assert found == {"new"}
    folders = table.read("keys", w.KEYS).filter("key in ('0-7', '1-9')").select("bucket").distinct().count()
    assert folders <= 2


def event(kind, repo, at, number=None, **pull):
    payload = {"pull_request": {"number": number, **pull}} if kind != d.COMMENT_EVENT else {"issue": {"number": number}}
    return json.dumps({"type": kind, "repo": {"name": repo}, "created_at": at, "payload": json.dumps({"action": "closed", **payload})})


def dumps(seed, n=24):
    rng = random.Random(seed)
    out = []
    for hour in range(n):
        lines = []
        for _ in range(120):
            repo, number = f"o/r{rng.randrange(3)}", rng.randrange(6)
            at = f"2025-01-01T{hour:02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}Z"
            kind = rng.choice([d.CLOSE_EVENT, d.COMMENT_EVENT, d.REVIEW_EVENT, d.REVIEW_COMMENT_EVENT])
            more = {"merged": rng.choice(["true", True, "false"]), "title": rng.choice(["", f"t{rng.random():.4f}"]),
                    "additions": rng.choice([None, 30, 60]), "deletions": rng.choice([None, 5]), "changed_files": rng.choice([None, 3, 9])}
            lines.append(event(kind, repo, at, number, **(more if kind == d.CLOSE_EVENT else {})))
        out.append([*lines, "{broken", " "])
    return out


def test_dumps_one_by_one_equal_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MERGE_AT", 7)
    folder = tmp_path / "dumps"
    folder.mkdir()
    for hour, lines in enumerate(dumps(1)):
        (folder / f"2025-01-01-{hour}.json").write_text("\n".join(lines))
    # Times can tie inside a dump and across rows of one second, so the order ends in the row itself.
    order = F.struct("created_at", "file_name", F.coalesce("title_key", F.lit("")))
    tag = lambda e: e.withColumn("title_key", F.md5(F.coalesce("payload", F.lit(""))))
    whole = tag(scan_event_log(spark, str(folder))).filter("not is_bad_json")
    wanted = sorted(map(tuple, d.candidates(d.parse_activity(whole), order).collect()), key=repr)
    hours, view = list(range(24)), str(tmp_path / "view")
    random.Random(2).shuffle(hours)
    for step, hour in enumerate([*hours[:9], hours[3], *hours[9:], hours[0], hours[23]]):
        new = landing.absorb(tag(scan_event_log(spark, str(folder / f"2025-01-01-{hour}.json"))), view, order)
        assert bool(new) == (step not in (9, 25, 26))
    found = sorted(map(tuple, landing.view_candidates(spark, view).collect()), key=repr)
    assert found == wanted and len(wanted) >= 3
    assert len(BatchTable(spark, view).batches()) < 7


def test_a_stream_of_dumps(spark, tmp_path):
    folder, view, checkpoint = tmp_path / "in", str(tmp_path / "view"), str(tmp_path / "cp")
    folder.mkdir()
    texts = dumps(5, 6)
    for round_ in (range(0, 4), range(4, 6), range(0)):
        for hour in round_:
            (folder / f"h{hour}.json").write_text("\n".join(texts[hour]))
        landing.follow_dumps(spark, str(folder), view, checkpoint, files_per_batch=3)
    partials = spark.read.parquet(*BatchTable(spark, view).folders("partials"))
    events = scan_event_log(spark, str(folder)).filter("not is_bad_json")
    counts = d.activity_counts(d.parse_activity(events)).collect()
    merged = {(r["repo_name"], r["pr_number"]): r for r in d.merge_partials(partials).collect()}
    assert len(counts) > 10
    for r in counts:
        got = merged[r["repo_name"], r["pr_number"]]
        assert all(got[c] == r[c] for c in ("issue_comment_events", "review_events", "review_comment_events", "first_seen_at", "last_seen_at"))


def plain_quota(available, total):
    room, left = available.copy(), total
    while left > 0 and (room > 0).any():
        open_ = np.flatnonzero(room)
        share, rest = divmod(left, open_.size)
        offer = np.full(open_.size, share)
        offer[:rest] += 1
        taken = np.minimum(offer, room[open_])
        room[open_] -= taken
        left -= int(taken.sum())
    return available - room


@pytest.mark.parametrize("seed,strata,total", [(0, 7, 40), (1, 300, 5000), (2, 300, 299), (3, 1, 5), (4, 100_000, 777_777), (5, 50, 10**6), (6, 20, 0)])
def test_quotas_equal_the_rounds(spark, seed, strata, total):
    rng = np.random.default_rng(seed)
    available = (rng.pareto(0.7, strata) * 3).astype(np.int64).clip(0, 10**5)
    names = sorted(f"f{i:06d}" for i in range(strata))
    table = spark.createDataFrame(list(zip(names, available.tolist())), "f string, n long").repartition(5)
    found = {r["f"]: r["quota"] for r in s.quota_rebalance(table, "f", "n", total).collect()}
    assert [found[f] for f in names] == plain_quota(available, total).tolist()


def test_quotas_of_a_null_stratum_and_of_none(spark):
    table = spark.createDataFrame([("a", 5), (None, 5), ("b", 5)], "f string, n long")
    assert {r["f"]: r["quota"] for r in s.quota_rebalance(table, "f", "n", 8).collect()} == {"a": 3, "b": 3, None: 2}
    assert s.quota_rebalance(table.limit(0), "f", "n", 8).count() == 0


def test_the_kth_place(spark):
    values = np.random.default_rng(0).integers(0, 50, 2000)
    frame = spark.createDataFrame([(int(v),) for v in values], "v long")
    for k in (1, 2, 700, 1999, 2000, 5000):
        assert kth_in_order(frame, F.col("v"), k).first()["o"] == np.sort(values)[min(k, 2000) - 1]
    assert kth_in_order(frame.limit(0), F.col("v"), 3).first()["o"] is None
