"""Candidate discovery and selection on the activity log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.text import repo_owner, repo_short_name, seeded_digest
from tracemill.operators import discovery as d
from tracemill.operators import selection as s
from tracemill.plans.analogs import ACTIVITY_SQL, event_log, table
from tracemill.plans.registry import query
from tracemill.settings import DEFAULTS
from tracemill.storage import materialize, scratch_path
from tracemill.streaming import landing



def _seq():
    return F.col("seq")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.parse_activity(event_log(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.candidates(_activity(spark, sf_dir), _seq())


@query("valid_events", ACTIVITY_SQL + "SELECT seq, type, repo_name, created_at FROM valid")
def valid_events(spark, sf_dir):
    return d.valid_events(event_log(spark, sf_dir)).select(
        "seq", "type", F.col("repo.name").alias("repo_name"), "created_at"
    )


@query("merged_closes", ACTIVITY_SQL + """
SELECT seq, repo_name, num AS pr_number, created_at, lower(merged) AS merged FROM closes""")
def merged_closes(spark, sf_dir):
    return d.merged_closes(_activity(spark, sf_dir)).select(
        "seq", "repo_name", F.col("own_number").alias("pr_number"), "created_at", F.lower("merged").alias("merged")
    )


@query("pr_number_resolve", ACTIVITY_SQL + "SELECT seq, repo_name, num AS pr_number, type FROM act WHERE active")
def pr_number_resolve(spark, sf_dir):
    return d.pr_number_resolve(_activity(spark, sf_dir)).select("seq", "repo_name", "pr_number", "type")


@query("merged_pr_metadata", ACTIVITY_SQL + "SELECT * FROM meta")
def merged_pr_metadata(spark, sf_dir):
    return d.merged_pr_metadata(_activity(spark, sf_dir), _seq())


@query("merged_pr_metadata_distinct", ACTIVITY_SQL + """
SELECT repo_name, num AS pr_number, pr_url, coalesce(pr_title, '') AS pr_title, pr_body, merge_commit_sha, additions,
  deletions, changed_files, min(created_at) AS pr_closed_at
FROM closes WHERE merged = 'true' GROUP BY ALL""")
def merged_pr_metadata_distinct(spark, sf_dir):
    return d.merged_pr_metadata(_activity(spark, sf_dir), _seq(), variant="distinct")


@query("activity_counts", ACTIVITY_SQL + "SELECT * FROM counts")
def activity_counts(spark, sf_dir):
    return d.activity_counts(_activity(spark, sf_dir))


@query("candidate_join", ACTIVITY_SQL + "SELECT * FROM joined")
def candidate_join(spark, sf_dir):
    activity = _activity(spark, sf_dir)
    return d.candidate_join(d.merged_pr_metadata(activity, _seq()), d.activity_counts(activity))


@query("candidate_filter", ACTIVITY_SQL + """
SELECT repo_name, pr_number, additions, deletions, changed_files, merged_close_events FROM joined
WHERE changed_files BETWEEN 2 AND 30 AND coalesce(additions, 0) + coalesce(deletions, 0) BETWEEN 50 AND 2000
  AND issue_comment_events >= 2 AND review_events >= 1 AND review_comment_events >= 2""")
def candidate_filter(spark, sf_dir):
    activity = _activity(spark, sf_dir)
    joined = d.candidate_join(d.merged_pr_metadata(activity, _seq()), d.activity_counts(activity))
    return d.candidate_filter(joined).select(
        "repo_name", "pr_number", "additions", "deletions", "changed_files", "merged_close_events"
    )


@query("candidates", ACTIVITY_SQL + "SELECT * FROM cand")
def candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


DUMPS = 6


@query("candidates_incremental", ACTIVITY_SQL + "SELECT * FROM cand")
def candidates_incremental(spark, sf_dir):
    """The log as dumps that land one by one, not in order and one of them twice; each landing reads its dump alone."""
    path, view = scratch_path(spark, "dumps"), scratch_path(spark, "view")
    log = event_log(spark, sf_dir).withColumn("is_bad_json", F.lit(False)).withColumn(
        "file_name", F.concat(F.lit("dump-"), F.pmod("seq", F.lit(DUMPS)).cast("string")))
    log.write.partitionBy("file_name").parquet(path)
    for n in (3, 0, 5, 3, 1, 4, 2):
        dump = spark.read.parquet(f"{path}/file_name=dump-{n}").withColumn("file_name", F.lit(f"dump-{n}"))
        landing.absorb(dump, view, _seq())
    return landing.view_candidates(spark, view)


@query("candidates_distinct", ACTIVITY_SQL + """,
m AS (SELECT repo_name, num AS pr_number, pr_url, coalesce(pr_title, '') AS pr_title, pr_body, merge_commit_sha,
  additions, deletions, changed_files FROM closes WHERE merged = 'true' GROUP BY ALL)
SELECT repo_name, pr_number, pr_url, pr_title, pr_body, merge_commit_sha, additions, deletions, changed_files,
  issue_comment_events, review_events, review_comment_events, first_seen_at, last_seen_at
FROM m JOIN counts USING (repo_name, pr_number)
WHERE changed_files BETWEEN 2 AND 30 AND additions + deletions BETWEEN 50 AND 2000
  AND issue_comment_events >= 2 AND review_events >= 1 AND review_comment_events >= 2""")
def candidates_distinct(spark, sf_dir):
    return d.candidates(_activity(spark, sf_dir), _seq(), variant="distinct")


def _series(name: str, values: str) -> str:
    probs = ", ".join(f"{i / 20}" for i in range(21))
    return f"""SELECT '{name}' AS metric, CAST(idx - 1 AS BIGINT) AS step, CAST(qs[idx] AS BIGINT) AS quantile
FROM (SELECT quantile_disc({values}, [{probs}]) AS qs FROM cand), range(1, 22) t(idx)"""


@query("candidate_stats", ACTIVITY_SQL + f"""
SELECT 'candidates' AS metric, CAST(0 AS BIGINT) AS step, count(*) AS quantile FROM cand
UNION ALL {_series("diff_size_quantiles", "additions + deletions")}
UNION ALL {_series("changed_files_quantiles", "changed_files")}
UNION ALL {_series("review_comment_quantiles", "review_comment_events")}""")
def candidate_stats(spark, sf_dir):
    stats = d.candidate_stats(_candidates(spark, sf_dir))
    entry = lambda name, values: F.transform(
        values, lambda v, i: F.struct(F.lit(name).alias("metric"), i.cast("long").alias("step"), v.alias("quantile"))
    )
    sketches = ["diff_size_quantiles", "changed_files_quantiles", "review_comment_quantiles"]
    return stats.select(F.explode(F.concat(
        entry("candidates", F.array("candidates")), *[entry(c, F.col(c)) for c in sketches]
    )).alias("r")).select("r.*")


@query("candidate_random_peek", ACTIVITY_SQL + """
SELECT repo_name, pr_number, pr_url, pr_title, additions, deletions, changed_files, issue_comment_events,
  review_events, review_comment_events
FROM cand ORDER BY md5('42:' || repo_name || '#' || CAST(pr_number AS VARCHAR)), repo_name, pr_number LIMIT 50""")
def candidate_random_peek(spark, sf_dir):
    rows = s.with_key(_candidates(spark, sf_dir))
    return d.candidate_random_peek(rows, seeded_digest(42, F.col("key")))


# --- selection: each event is a candidate row in the file of its type -------

_ROWS_SQL = """
WITH cr AS (
  SELECT event_type || '.csv' AS file_name, event_id AS seq,
    'org' || CAST(user_id % 15 AS VARCHAR) || '/app' || CAST(user_id % 15 AS VARCHAR) AS repo_name,
    user_id * 20 + event_id % 20 AS pr_number,
    'org' || CAST(user_id % 15 AS VARCHAR) || '/app' || CAST(user_id % 15 AS VARCHAR) || '#'
      || CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS key, value
  FROM events),
seen AS (
  SELECT DISTINCT key FROM cr WHERE file_name = 'signup.csv'),
"""
_FLAG_SQL = _ROWS_SQL + """
flagged AS (
  SELECT file_name, key, count(*) AS copies, min(seq) AS first_order, key IN (SELECT key FROM seen) AS already_seen
  FROM cr WHERE file_name <> 'signup.csv' GROUP BY ALL),
pend AS (SELECT *, NOT already_seen AND file_name = min(file_name) OVER (PARTITION BY key) AS pending FROM flagged),
"""


def _candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit(".csv")).alias("file_name"),
        F.col("event_id").alias("seq"),
        F.expr("concat('org', user_id % 15, '/app', user_id % 15)").alias("repo_name"),
        F.expr("user_id * 20 + event_id % 20").alias("pr_number"),
        "value",
    )
    return s.with_key(rows)


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of earlier runs: the rows of one file stand for their outputs."""
    done = _candidate_rows(spark, sf_dir).filter(F.col("file_name") == "signup.csv")
    return s.seen_keys(done.select("repo_name", "pr_number"))


def _pending_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidate_rows(spark, sf_dir).filter(F.col("file_name") != "signup.csv")


@query("candidate_key", _ROWS_SQL + """
x AS (SELECT 1)
SELECT seq, key, split_part(repo_name, '/', 1) AS owner, split_part(repo_name, '/', 2) AS repo FROM cr""")
def candidate_key(spark, sf_dir):
    return _candidate_rows(spark, sf_dir).select(
        "seq", "key", repo_owner(F.col("repo_name")).alias("owner"), repo_short_name(F.col("repo_name")).alias("repo")
    )


@query("dedup_keep_first", """
SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source, count(*) AS copies
FROM documents GROUP BY text""")
def dedup_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    # Long texts are compared by a 256-bit digest, so only digests are shuffled.
    keyed = docs.select("doc_id", "lang", "source", F.sha2("text", 256).alias("key"))
    return s.dedup_keep_first(keyed, "key", F.col("doc_id")).drop("key")


@query("dedup_offset_limit", _ROWS_SQL + """
p AS (SELECT *, row_number() OVER (ORDER BY seq) AS place FROM cr),
f AS (SELECT key, min(seq) AS seq, count(*) AS copies, arg_min(value, seq) AS value FROM p WHERE place > 10
  GROUP BY key ORDER BY 2 LIMIT 500)
SELECT key, seq, copies, value FROM f""")
def dedup_offset_limit(spark, sf_dir):
    rows = _candidate_rows(spark, sf_dir).select("key", "seq", "value")
    return s.dedup_keep_first(rows, "key", F.col("seq"), offset=10, limit=500)


@query("dedup_across_files", _ROWS_SQL + """
f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY file_name, seq) AS rn,
  count(*) OVER (PARTITION BY key) AS copies FROM cr)
SELECT key, file_name, seq, value, copies FROM f WHERE rn = 1""")
def dedup_across_files(spark, sf_dir):
    rows = _candidate_rows(spark, sf_dir).select("key", "file_name", "seq", "value")
    return s.dedup_across_files(rows, "key", "file_name", F.col("seq"))


@query("seen_keys", _ROWS_SQL + """
x AS (SELECT 1)
SELECT DISTINCT key FROM cr WHERE file_name IN ('signup.csv', 'error.csv')""")
def seen_keys(spark, sf_dir):
    rows = _candidate_rows(spark, sf_dir)
    success = rows.filter(F.col("file_name") == "signup.csv").select("repo_name", "pr_number")
    failed = rows.filter(F.col("file_name") == "error.csv").select(F.col("repo_name").alias("repo"), "pr_number")
    return s.seen_keys(success, failed)


@query("anti_join_seen", _ROWS_SQL + """
x AS (SELECT 1)
SELECT file_name, seq, key FROM cr WHERE file_name <> 'signup.csv' AND key NOT IN (SELECT key FROM seen)""")
def anti_join_seen(spark, sf_dir):
    pending = s.anti_join_seen(_pending_input(spark, sf_dir), _seen(spark, sf_dir))
    return pending.select("file_name", "seq", "key")


# Rounds of the even split, as a recursive query over one row per file.
def _quota_sql(total: str) -> str:
    return f"""
avail AS (SELECT file_name, count(*) AS available FROM pend WHERE pending GROUP BY ALL),
goal AS (SELECT {total} AS total),
rounds(file_name, available, quota, remaining, round) AS (
  SELECT file_name, available, CAST(0 AS BIGINT), CAST((SELECT total FROM goal) AS BIGINT), 0 FROM avail
  UNION ALL
  SELECT file_name, available, quota + take, remaining - CAST(sum(take) OVER () AS BIGINT), round + 1 FROM (
    SELECT *, CASE WHEN quota < available THEN least(
      remaining // greatest(n_open, 1) + CASE WHEN place < remaining % greatest(n_open, 1) THEN 1 ELSE 0 END,
      available - quota) ELSE 0 END AS take
    FROM (SELECT *,
        CAST(count(*) FILTER (WHERE quota < available) OVER () AS BIGINT) AS n_open,
        CAST(count(*) FILTER (WHERE quota < available) OVER (ORDER BY file_name) AS BIGINT) - 1 AS place
      FROM rounds WHERE remaining > 0 AND round < 60))),
quotas AS (SELECT file_name, max(available) AS available, max(quota) AS quota FROM rounds GROUP BY ALL)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.pending_by_file(
        _pending_input(spark, sf_dir), "file_name", "key", F.col("seq"), _seen(spark, sf_dir)
    )


_TOTAL = 700
_RECURSIVE = _FLAG_SQL.replace("WITH cr", "WITH RECURSIVE cr", 1)
_SAMPLE_SQL = _RECURSIVE + _quota_sql(str(_TOTAL)) + """,
ranked AS (
  SELECT p.*, q.quota, row_number() OVER (PARTITION BY p.file_name ORDER BY md5('42:' || key), key) AS rn
  FROM pend p JOIN quotas q USING (file_name) WHERE pending),
picked AS (SELECT * FROM ranked WHERE rn <= quota)
"""


@query("quota_rebalance", _RECURSIVE + _quota_sql(str(_TOTAL)) + "SELECT file_name, available, quota FROM quotas")
def quota_rebalance(spark, sf_dir):
    counts = (
        _flagged(spark, sf_dir).filter("pending").groupBy("file_name").agg(F.count(F.lit(1)).alias("available"))
    )
    return s.quota_rebalance(counts, "file_name", "available", _TOTAL)


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read three times by the sampler, so the narrow pending keys are written once.
    pending = materialize(
        _flagged(spark, sf_dir).filter("pending").select("file_name", "key", "first_order"), "pending"
    )
    return s.balanced_sample(pending, "file_name", "key", _TOTAL, DEFAULTS.split.seed)


@query("balanced_sample", _SAMPLE_SQL + """
SELECT file_name, key, first_order, md5('43:' || key) AS position_digest FROM picked""")
def balanced_sample(spark, sf_dir):
    return _sample(spark, sf_dir)


@query("selection_stats", _SAMPLE_SQL + f""",
per AS (
  SELECT file_name AS file, sum(copies) AS raw_rows, count(*) AS deduped_rows,
    count(*) FILTER (WHERE already_seen) AS already_seen, count(*) FILTER (WHERE pending) AS pending_rows,
    count(*) FILTER (WHERE pending AND key IN (SELECT key FROM picked)) AS selected_rows,
    count(*) FILTER (WHERE NOT pending AND NOT already_seen) AS global_duplicates_removed
  FROM pend GROUP BY ALL),
both_ AS (
  SELECT * FROM per UNION ALL
  SELECT '[total]', sum(raw_rows), sum(deduped_rows), sum(already_seen), sum(pending_rows), sum(selected_rows),
    sum(global_duplicates_removed) FROM per)
SELECT file, CAST(raw_rows AS BIGINT) AS raw_rows, CAST(deduped_rows AS BIGINT) AS deduped_rows,
  CAST(already_seen AS BIGINT) AS already_seen, CAST(pending_rows AS BIGINT) AS pending_rows,
  CAST(selected_rows AS BIGINT) AS selected_rows,
  CAST(raw_rows - deduped_rows AS BIGINT) AS local_duplicates_removed,
  CAST(global_duplicates_removed AS BIGINT) AS global_duplicates_removed,
  CASE WHEN file = '[total]' THEN CAST(greatest({_TOTAL} - selected_rows, 0) AS BIGINT) END AS shortfall
FROM both_""")
def selection_stats(spark, sf_dir):
    return s.selection_stats(_flagged(spark, sf_dir), _sample(spark, sf_dir), "file_name", "key", _TOTAL)
