"""Round trips through every source and sink, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracemill.operators import discovery, enrichment, gate, splits
from tracemill.operators.features import feature_table_v1
from tracemill.plans import analogs as a
from tracemill.plans.analogs import ACTIVITY_SQL, TRACE_SQL
from tracemill.plans.finalize import finalize
from tracemill.plans.model_queries import _FRAME_SPLIT_SQL, matrix
from tracemill.plans.quality_queries import _ASSEMBLED_SQL
from tracemill.plans.registry import query
from tracemill.plans.view_queries import (
    _AUDIT_SQL, _FEATURE_SQL, _LABELED_SQL, _SFT_SQL, _split_sql, audited, feature_input, labeled_rows, trace_rows,
)
from tracemill.schemas import INT, LONG, TEXT, struct
from tracemill.settings import DEFAULTS
from tracemill.sources import readers as r, writers as w
from tracemill.sources.batches import BatchTable
from tracemill.storage import materialize, scratch_path

K = gate.KEY
TALK = struct(conv_id=LONG, turn=LONG, role=TEXT, text=TEXT)


def _event_lines(spark, sf_dir):
    """The activity log as JSON lines, a broken line and a blank one per signup event."""
    log = a.event_log(spark, sf_dir)
    whole = F.concat(
        F.lit('{"type":"'), F.col("type"), F.lit('","repo":{"name":'),
        F.coalesce(F.concat(F.lit('"'), F.col("repo.name"), F.lit('"')), F.lit("null")),
        F.lit('},"created_at":'), F.coalesce(F.concat(F.lit('"'), F.col("created_at"), F.lit('"')), F.lit("null")),
        F.lit(',"payload":'), F.col("payload"), F.lit("}"),
    )
    lines = F.when(F.col("type") == "WatchEvent", F.array(whole, F.lit('{"type": broken'), F.lit("  "))).otherwise(
        F.array(whole))
    return log.select(F.explode(lines).alias("value"))


@query("scan_event_log", ACTIVITY_SQL + """
SELECT CAST(7 AS BIGINT) AS input_files, count(*) AS parsed_events,
  count(*) FILTER (WHERE type = 'WatchEvent') AS json_errors,
  (SELECT count(*) FROM valid) AS valid_events, (SELECT count(*) FROM act WHERE active) AS active_events FROM log""")
def scan_event_log(spark, sf_dir):
    """Gzip lines written and scanned again; parsed, broken and valid lines counted in one pass."""
    path = scratch_path(spark, "event-log")
    # Every file gets lines, so the report must name all of them.
    _event_lines(spark, sf_dir).repartition(7).write.option("compression", "gzip").text(path)
    events = r.scan_event_log(spark, f"{path}/*.gz", partitions=spark.sparkContext.defaultParallelism)
    active = discovery.pr_number_resolve(discovery.parse_activity(events.filter(~F.col("is_bad_json"))))
    return discovery.event_log_stats(events).select(
        "input_files", "parsed_events", "json_errors", "valid_events",
    ).withColumn("active_events", active.agg(F.count(F.lit(1)).alias("n")).scalar())


@query("hourly_coverage", """
WITH b AS (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour FROM b)
SELECT strftime(hour, '%Y-%m-%d-') || CAST(hour(hour) AS VARCHAR) || '.json.gz' AS file_name FROM h
WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error')""")
def hourly_coverage(spark, sf_dir):
    """Hours of the log's date range without any error event: the dumps still missing."""
    events = a.table(spark, sf_dir, "events")
    bounds = events.agg(
        F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")
    )
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    landed = events.filter(F.col("event_type") == "error").select(r.dump_name(hour).alias("file_name"))
    return r.hourly_coverage(r.dump_calendar(bounds), landed).select("file_name")


@query("scan_candidates_csv", "SELECT conv_id, turn, role, text FROM conversations")
def scan_candidates_csv(spark, sf_dir):
    """Quoted line breaks, quotes and non-ASCII text survive a CSV round trip."""
    path = scratch_path(spark, "talk-csv")
    w.sink_csv(a.table(spark, sf_dir, "conversations").select(*TALK.fieldNames()), path)
    return r.scan_candidates_csv(spark, path, TALK)


@query("scan_candidates_dir", """
SELECT role || '.csv' AS file_name, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM conversations GROUP BY ALL""")
def scan_candidates_dir(spark, sf_dir):
    """One folder per role, scanned by pattern with each row's folder as its origin."""
    path = scratch_path(spark, "talk-dir")
    talk = a.table(spark, sf_dir, "conversations").select(*TALK.fieldNames())
    w.sink_csv(talk.withColumn("origin", F.col("role")), path, partition_by=("origin",))
    rows = r.scan_candidates_dir(spark, path, "origin=*/*.csv", TALK).withColumn("path", F.col("_metadata.file_path"))
    origin = F.concat(F.regexp_extract("path", "origin=([a-z]+)", 1), F.lit(".csv"))
    return rows.groupBy(origin.alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text").cast("long")).alias("n_chars")
    )


@query("scan_jsonl", """
SELECT conv_id, turn, role, text FROM conversations""")
def scan_jsonl(spark, sf_dir):
    """JSON lines with blank lines between them; an absent second path adds nothing."""
    path = scratch_path(spark, "talk-jsonl")
    talk = a.table(spark, sf_dir, "conversations").select(*TALK.fieldNames())
    lines = talk.select(F.explode(F.array(F.to_json(F.struct(*TALK.fieldNames())), F.lit(""))).alias("value"))
    lines.write.text(path)
    return r.scan_jsonl(spark, path, TALK).unionByName(r.scan_jsonl(spark, path + "-absent", TALK))


@query("sink_jsonl", """
SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT doc_id, 'second' AS lang, quality FROM labels""")
def sink_jsonl(spark, sf_dir):
    """Overwrite, then append; nulls are kept as fields."""
    path = scratch_path(spark, "docs-jsonl")
    docs, labels = a.table(spark, sf_dir, "documents"), a.table(spark, sf_dir, "labels")
    first = docs.join(labels, "doc_id", "left").select("doc_id", "lang", "quality")
    w.sink_jsonl(first, path)
    w.sink_jsonl(labels.select("doc_id", F.lit("second").alias("lang"), "quality"), path, mode="append")
    return r.scan_jsonl(spark, path, struct(doc_id=LONG, lang=TEXT, quality=INT))


_CANDIDATE_SQL = ACTIVITY_SQL + """
SELECT repo_name, pr_number, coalesce(pr_title, '') AS pr_title, additions, deletions, changed_files,
  issue_comment_events, first_seen_at FROM cand"""


@query("sink_candidates_table", _CANDIDATE_SQL)
def sink_candidates_table(spark, sf_dir):
    """The table branch: buckets of (repo, number), read back by name."""
    name = f"candidates_{uuid.uuid4().hex}"
    rows = discovery.candidates(discovery.parse_activity(a.event_log(spark, sf_dir)), F.col("seq"))
    w.sink_candidates(rows, table=name, table_path=scratch_path(spark, "candidates"))
    return spark.table(name).select(
        "repo_name", "pr_number", F.coalesce("pr_title", F.lit("")).alias("pr_title"), "additions", "deletions",
        "changed_files", "issue_comment_events", "first_seen_at",
    )


@query("bucketed_join", _LABELED_SQL + """
SELECT repo, pr_number, review_concern, split, CAST(in_matrix AS BIGINT) AS in_matrix FROM labeled""")
def bucketed_join(spark, sf_dir):
    """Labels and splits as tables in equal buckets; joining them moves no row."""
    labelled = materialize(labeled_rows(spark, sf_dir), "labelled")
    keys, name = ["repo", "pr_number"], uuid.uuid4().hex
    labels = w.sink_bucketed(labelled.select(*keys, "review_concern"), f"labels_{name}", scratch_path(spark, "labels"), keys, 16)
    split = w.sink_bucketed(
        labelled.select(*keys, "split", F.col("in_matrix").cast("long").alias("in_matrix")), f"splits_{name}", scratch_path(spark, "splits"), keys, 16)
    return labels.hint("merge").join(split, keys)


@query("sink_candidates", _CANDIDATE_SQL)
def sink_candidates(spark, sf_dir):
    path = scratch_path(spark, "candidates")
    rows = discovery.candidates(discovery.parse_activity(a.event_log(spark, sf_dir)), F.col("seq"))
    w.sink_candidates(rows, path)
    return r.scan_candidates_csv(spark, path).select(
        "repo_name", "pr_number", F.coalesce("pr_title", F.lit("")).alias("pr_title"), "additions", "deletions",
        "changed_files", "issue_comment_events", "first_seen_at",
    )


@query("sink_trace_parquet", TRACE_SQL + """
SELECT CAST(accepted AS BIGINT) AS accepted, count(*) AS n_rows, CAST(sum(file_count) AS BIGINT) AS n_files,
  CAST(sum(review_comment_count) AS BIGINT) AS n_review_comments
FROM judged WHERE NOT bad_pr AND NOT bad_files GROUP BY ALL""")
def sink_trace_parquet(spark, sf_dir):
    path = scratch_path(spark, "traces")
    w.sink_trace_parquet(path, *map(trace_rows(spark, sf_dir), a.slices(spark, sf_dir)))
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("accepted").cast("boolean").cast("long").alias("accepted")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size("code_diff.files").cast("long")).alias("n_files"),
        F.sum(F.size("review.review_comments").cast("long")).alias("n_review_comments"),
    )


_FEATURES_SPLIT_SQL = TRACE_SQL + ", ft AS (" + _FEATURE_SQL + ")" + _split_sql("ft", "true")


@query("sink_features", _FEATURES_SPLIT_SQL + """
SELECT split, count(*) AS n_rows, CAST(sum(score) AS BIGINT) AS score_sum FROM ft JOIN smap USING (repo) GROUP BY ALL""")
def sink_features(spark, sf_dir):
    """Feature rows per split as CSV and Parquet; the CSV is read back."""
    rows = splits.split_by_repo(materialize(feature_table_v1(feature_input(spark, sf_dir)), "features"))
    csv_path, parquet_path = scratch_path(spark, "features-csv"), scratch_path(spark, "features-parquet")
    counts = w.sink_features(rows, csv_path, parquet_path)
    schema = StructType([f for f in rows.schema.fields if f.name != "split"] + [rows.schema["split"]])
    text = spark.read.schema(schema).option("header", True).option("escape", '"').csv(csv_path)
    sums = text.groupBy("split").agg(F.sum("score").alias("score_sum"))
    return counts.join(sums, "split")


@query("sink_matrix", _FRAME_SPLIT_SQL + """
SELECT split, count(*) AS n_rows, CAST(sum(review_concern) AS BIGINT) AS positives FROM sp GROUP BY ALL""")
def sink_matrix(spark, sf_dir):
    path = scratch_path(spark, "matrix")
    rows = matrix(spark, sf_dir).select("example_id", "repo", "pr_number", F.col("y").cast("byte").alias("y"),
                                        "tabular", "all", "split")
    w.sink_matrix(rows, path, {"target_column": "review_concern", "widths": [7, 775]})
    saved = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    return saved.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("y").cast("long")).alias("positives")
    )


@query("sink_audit", _AUDIT_SQL + """
SELECT j.example_id, j.score, j.reasons AS reject_reasons, coalesce(j.title, '') AS pr_title
FROM judged j JOIN sample USING (example_id) WHERE NOT bad_pr AND NOT bad_files""")
def sink_audit(spark, sf_dir):
    path = scratch_path(spark, "audit")
    rows = audited(spark, sf_dir)
    w.sink_csv(rows, path)
    saved = r.scan_candidates_csv(spark, path, rows.schema)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return saved.select("example_id", "score", text("reject_reasons"), text("pr_title"))


@query("incremental_append", TRACE_SQL + """
SELECT repo_name, pr_number, CASE WHEN bad_pr OR bad_files THEN 'failed' ELSE 'enriched' END AS outcome,
  CAST(CASE WHEN merged THEN 1 ELSE 2 END AS BIGINT) AS run FROM prs""")
def incremental_append(spark, sf_dir):
    """Two runs: merged requests first, then all of them; the second skips what the first wrote."""
    from tracemill.operators import selection

    outcomes = BatchTable(spark, scratch_path(spark, "runs"))
    good_schema = struct(repo_name=TEXT, pr_number=LONG, run=LONG)
    everything = selection.with_key(
        a.requests(spark, sf_dir).withColumn("candidate", F.struct(*K))
    )
    for run, wanted in ((1, everything.filter("merged")), (2, everything)):
        pending = w.not_appended(outcomes, wanted)
        good, bad = enrichment.failure_split(
            pending, {"pr": "err_pr", "files": "err_files"}, {"full_diff": "err_full_diff"}
        )
        number = F.lit(run).cast("long").alias("run")
        w.incremental_append(
            outcomes, f"run-{run}", good.select("key", *K, number), selection.with_key(bad).select("key", *K, number, "error_type"))
    read = lambda part, outcome: outcomes.read(part, good_schema, "json").withColumn("outcome", F.lit(outcome))
    return read("outcomes", "enriched").unionByName(read("failures", "failed"))


@query("finalize", _SFT_SQL.replace(_ASSEMBLED_SQL, _AUDIT_SQL) + ", ft AS (SELECT repo_name AS repo, accepted, file_count "
       "FROM judged WHERE NOT bad_pr AND NOT bad_files)" + _split_sql("ft", "true") + """,
strata2 AS (
  SELECT example_id, 1 AS stratum FROM judged WHERE accepted AND NOT bad_pr AND NOT bad_files UNION ALL
  SELECT example_id, 2 FROM judged WHERE NOT accepted AND NOT bad_pr AND NOT bad_files UNION ALL
  SELECT example_id, 3 FROM judged WHERE score BETWEEN 60 AND 80 AND NOT bad_pr AND NOT bad_files),
drawn2 AS (SELECT example_id, stratum, row_number() OVER (PARTITION BY stratum
    ORDER BY md5('42:' || CAST(stratum AS VARCHAR) || ':' || example_id), example_id) AS rn FROM strata2),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE accepted) AS acc, count(DISTINCT repo) AS repos FROM ft)
SELECT 'process' AS step, 'processed' AS metric, n AS value FROM t
UNION ALL SELECT 'process', 'accepted', acc FROM t UNION ALL SELECT 'process', 'rejected', n - acc FROM t
UNION ALL SELECT 'split', split || '_examples', count(*) FROM ft JOIN smap USING (repo) GROUP BY split
UNION ALL SELECT 'split', split || '_repos', count(*) FROM smap GROUP BY split
UNION ALL SELECT 'features', split || '_rows', count(*) FROM ft JOIN smap USING (repo) GROUP BY split
UNION ALL SELECT 'parquet', 'accepted_rows', acc FROM t UNION ALL SELECT 'parquet', 'rejected_rows', n - acc FROM t
UNION ALL SELECT 'sft', 'accepted_loaded', acc FROM t
UNION ALL SELECT 'sft', 'review_sft_rows', count(*) FROM s1
UNION ALL SELECT 'sft', 'issue_to_patch_sft_rows', count(*) FROM s2
UNION ALL SELECT 'audit', 'accepted_loaded', acc FROM t UNION ALL SELECT 'audit', 'rejected_loaded', n - acc FROM t
UNION ALL SELECT 'audit', 'borderline_pool', count(*) FROM strata2 WHERE stratum = 3
UNION ALL SELECT 'audit', 'sample_size', count(DISTINCT example_id) FROM drawn2
  WHERE rn <= CASE stratum WHEN 1 THEN 150 ELSE 50 END
UNION ALL SELECT 'report', 'failed_api_fetch', count(*) FROM prs WHERE bad_pr OR bad_files
UNION ALL SELECT 'card', 'unique_repos', repos FROM t""")
def finalize_all(spark, sf_dir):
    """All eight steps written to the shared folder; returns each step's counts."""
    return finalize(
        [*map(trace_rows(spark, sf_dir), a.slices(spark, sf_dir))], a.failures(spark, sf_dir), scratch_path(spark, "release"), DEFAULTS
    )
