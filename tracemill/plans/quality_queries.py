"""File classification, review text, enrichment joins and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.functions import paths, text
from tracemill.operators import enrichment, files as fj, gate, traces
from tracemill.plans import analogs as a
from tracemill.plans.analogs import TRACE_SQL
from tracemill.plans.registry import query

K = gate.KEY
FILE_ID = ["pr_number", *a.FILE_ORDER]
_FILE_ID_SQL = "pr_number, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def _flag(column: str):
    return F.col(column).cast("long").alias(column)


@query("file_ext", TRACE_SQL + f"SELECT {_FILE_ID_SQL}, filename, ext FROM files")
def file_ext(spark, sf_dir):
    return a.changed_files(spark, sf_dir).select(*FILE_ID, "filename", paths.file_ext(F.col("filename")).alias("ext"))


@query("is_doc_file", TRACE_SQL + f"SELECT {_FILE_ID_SQL}, CAST(is_doc AS BIGINT) AS is_doc FROM files")
def is_doc_file(spark, sf_dir):
    doc = F.coalesce(paths.is_doc_file(F.col("filename")), F.lit(False)).cast("long")
    return a.changed_files(spark, sf_dir).select(*FILE_ID, doc.alias("is_doc"))


@query("is_lockfile", TRACE_SQL + f"SELECT {_FILE_ID_SQL}, CAST(is_lock AS BIGINT) AS is_lock FROM files")
def is_lockfile(spark, sf_dir):
    lock = F.coalesce(paths.is_lockfile(F.col("filename")), F.lit(False)).cast("long")
    return a.changed_files(spark, sf_dir).select(*FILE_ID, lock.alias("is_lock"))


@query("is_generated_or_vendor", TRACE_SQL + f"SELECT {_FILE_ID_SQL}, CAST(is_generated AS BIGINT) AS is_generated FROM files")
def is_generated_or_vendor(spark, sf_dir):
    made = F.coalesce(paths.is_generated_or_vendor(F.col("filename")), F.lit(False)).cast("long")
    return a.changed_files(spark, sf_dir).select(*FILE_ID, made.alias("is_generated"))


@query("source_language", TRACE_SQL + f"""
SELECT {_FILE_ID_SQL}, CAST(language IS NOT NULL AS BIGINT) AS is_source, language FROM files""")
def source_language(spark, sf_dir):
    path = F.col("filename")
    source = F.coalesce(paths.is_source_file(path), F.lit(False)).cast("long")
    return a.changed_files(spark, sf_dir).select(
        *FILE_ID, source.alias("is_source"), paths.source_language(path).alias("language")
    )


@query("classify_files", TRACE_SQL + f"""
SELECT {_FILE_ID_SQL}, repo_name, filename, ext, CAST(is_doc AS BIGINT) AS is_doc, CAST(is_lock AS BIGINT) AS is_lock,
  CAST(is_generated AS BIGINT) AS is_generated, CAST(language IS NOT NULL AS BIGINT) AS is_source, language
FROM files WHERE filename <> ''""")
def classify_files(spark, sf_dir):
    rows = a.changed_files(spark, sf_dir).select("repo_name", *FILE_ID, "filename")
    return fj.classify_files(rows).select(
        "repo_name", *FILE_ID, "filename", "ext",
        *[_flag(c) for c in ("is_doc", "is_lock", "is_generated", "is_source")], "language",
    )


@query("language_counts", TRACE_SQL + """
SELECT language, count(*) AS n_files FROM files WHERE language IS NOT NULL GROUP BY ALL""")
def language_counts(spark, sf_dir):
    return fj.language_counts(a.changed_files(spark, sf_dir))


@query("top_language", TRACE_SQL + """
SELECT DISTINCT f.repo_name, f.pr_number, coalesce(top_language, 'unknown') AS top_language
FROM files f LEFT JOIN toplang USING (repo_name, pr_number)""")
def top_language(spark, sf_dir):
    return fj.top_language(a.changed_files(spark, sf_dir), a.file_order())


@query("bot_authors", TRACE_SQL + """
SELECT is_bot, count(*) AS n_rows, count(DISTINCT login) AS n_logins
FROM (SELECT login, CAST(is_bot AS BIGINT) AS is_bot FROM facts) GROUP BY ALL""")
def bot_authors(spark, sf_dir):
    per_login = (
        a.split_outcomes(spark, sf_dir)[0]
        .groupBy(text.is_bot_login(F.col("login")).cast("long").alias("is_bot"), "login")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_login.groupBy("is_bot").agg(F.sum("n").alias("n_rows"), F.count("login").alias("n_logins"))


@query("meaningful_comments", TRACE_SQL + """
SELECT repo_name, pr_number, count(*) AS n_comments, count(*) FILTER (WHERE meaningful) AS n_meaningful
FROM rcs GROUP BY ALL""")
def meaningful_comments(spark, sf_dir):
    return a.review_comments(spark, sf_dir).groupBy(*K).agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(text.is_meaningful_comment(F.col("body"))).alias("n_meaningful"),
    )


@query("review_concern_label", TRACE_SQL + "SELECT repo_name, pr_number, review_concern FROM judged")
def review_concern_label(spark, sf_dir):
    return a.facts(spark, sf_dir).select(*K, gate.review_concern_label().alias("review_concern"))


@query("review_concern_eda", TRACE_SQL + """
SELECT repo_name, pr_number, CAST(changes_requested_count > 0 OR meaningful_count >= 3 AS BIGINT) AS review_concern
FROM judged""")
def review_concern_eda(spark, sf_dir):
    label = gate.review_concern_label(min_meaningful=3, exclude_inactive=False)
    return a.facts(spark, sf_dir).select(*K, label.alias("review_concern"))


@query("review_state_counts", TRACE_SQL + """
SELECT coalesce(upper(state), 'UNKNOWN') AS state, count(*) AS n_reviews FROM reviews GROUP BY ALL""")
def review_state_counts(spark, sf_dir):
    return gate.review_state_counts(a.reviews(spark, sf_dir))


@query("review_state_counts_per_request", TRACE_SQL + """
SELECT repo_name, pr_number, upper(state) AS state, count(*) AS n_reviews FROM reviews
WHERE state IS NOT NULL GROUP BY ALL""")
def review_state_counts_per_request(spark, sf_dir):
    return gate.review_state_counts(a.reviews(spark, sf_dir), by=tuple(K), missing=None)


# --- enrichment --------------------------------------------------------------

@query("linked_issue_extract", TRACE_SQL + "SELECT repo_name, pr_number, stated_issue AS linked_issue_number FROM prs")
def linked_issue_extract(spark, sf_dir):
    return enrichment.linked_issue_extract(a.requests(spark, sf_dir)).select(*K, "linked_issue_number")


@query("linked_issue_join", TRACE_SQL + """
SELECT linked.repo_name, linked.pr_number, linked_issue_number, issue_title, issue_login, count(turn) AS n_comments
FROM linked LEFT JOIN pcs ON pcs.repo_name = linked.repo_name AND pcs.pr_number = linked_issue_number
GROUP BY ALL""")
def linked_issue_join(spark, sf_dir):
    rows = a.linked(spark, sf_dir)
    talk = a.comments(spark, sf_dir).groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    counts = talk.select("repo_name", F.col("pr_number").alias("linked_issue_number"), "n")
    # Requests without a link stay out of the join by issue.
    narrow = rows.filter(F.col("linked_issue_number").isNotNull()).select(*K, "linked_issue_number")
    known = narrow.join(counts, ["repo_name", "linked_issue_number"]).select(*K, "n")
    return rows.join(known, K, "left").select(
        *K, "linked_issue_number", F.col("linked_issue.title").alias("issue_title"),
        F.col("linked_issue.user.login").alias("issue_login"), F.coalesce("n", F.lit(0).cast("long")).alias("n_comments"),
    )


@query("failure_split", TRACE_SQL + """
SELECT repo_name, pr_number, 'failed' AS outcome,
  CASE WHEN bad_pr THEN 'HTTPError' ELSE 'ReadTimeout' END AS error_type,
  CASE WHEN bad_pr THEN 'not found' ELSE 'files slow' END AS detail FROM prs WHERE bad_pr OR bad_files
UNION ALL
SELECT repo_name, pr_number, 'enriched', NULL, concat_ws(',', CASE WHEN bad_diff THEN 'full_diff' END,
  CASE WHEN bad_issue THEN 'linked_issue' END) FROM good""")
def failure_split(spark, sf_dir):
    good, bad = a.split_outcomes(spark, sf_dir)
    failed = bad.select(*K, F.lit("failed").alias("outcome"), "error_type", F.col("error_message").alias("detail"))
    kept = good.select(
        *K, F.lit("enriched").alias("outcome"), F.lit(None).cast("string").alias("error_type"),
        F.array_join(F.transform("api_errors", lambda e: e["stage"]), ",").alias("detail"),
    )
    return failed.unionByName(kept)


_ASSEMBLED_SQL = TRACE_SQL + """,
fa AS (SELECT repo_name, pr_number, string_agg(coalesce(filename, '-'), ';' ORDER BY l_linenumber, l_partkey,
  l_suppkey, l_quantity, l_extendedprice) AS files FROM files GROUP BY ALL),
ra AS (SELECT repo_name, pr_number, string_agg(coalesce(state, '-'), ';' ORDER BY event_id) AS states
  FROM reviews GROUP BY ALL),
ca AS (SELECT repo_name, pr_number, string_agg(coalesce(md5(body), '-'), ';' ORDER BY turn) AS rc_bodies
  FROM rcs GROUP BY ALL),
pa AS (SELECT repo_name, pr_number, string_agg(coalesce(md5(body), '-'), ';' ORDER BY turn) AS pc_bodies
  FROM pcs GROUP BY ALL),
asm AS (
  SELECT g.repo_name, g.pr_number, g.linked_issue_number, g.login, g.cand_additions, g.full_diff,
    coalesce(files, '') AS files, coalesce(states, '') AS states, coalesce(rc_bodies, '') AS rc_bodies,
    coalesce(pa.pc_bodies, '') AS pc_bodies, coalesce(pi.pc_bodies, '') AS issue_bodies,
    concat_ws(',', CASE WHEN bad_diff THEN 'full_diff' END, CASE WHEN bad_issue THEN 'linked_issue' END) AS stages
  FROM (SELECT * FROM linked WHERE NOT bad_pr AND NOT bad_files) g
    LEFT JOIN fa USING (repo_name, pr_number) LEFT JOIN ra USING (repo_name, pr_number)
    LEFT JOIN ca USING (repo_name, pr_number) LEFT JOIN pa USING (repo_name, pr_number)
    LEFT JOIN pa pi ON pi.repo_name = g.repo_name AND pi.pr_number = g.linked_issue_number)
"""


def _joined(array: str, field: str, digest: bool = False):
    pick = (lambda x: F.coalesce(F.md5(x[field]), F.lit("-"))) if digest else (
        lambda x: F.coalesce(x[field], F.lit("-")))
    return F.array_join(F.transform(F.col(array), pick), ";")


@query("assemble_enriched", _ASSEMBLED_SQL + "SELECT * FROM asm")
def assemble_enriched(spark, sf_dir):
    return a.slice_by_slice(spark, sf_dir, "assembled", lambda kept: a.enriched(spark, sf_dir, kept).select(
        *K, "linked_issue_number", F.col("pr.user.login").alias("login"),
        F.col("candidate.additions").alias("cand_additions"), "full_diff",
        _joined("files", "filename").alias("files"), _joined("reviews", "state").alias("states"),
        _joined("review_comments", "body", True).alias("rc_bodies"),
        _joined("pr_comments", "body", True).alias("pc_bodies"),
        _joined("linked_issue_comments", "body", True).alias("issue_bodies"),
        F.array_join(F.transform("api_errors", lambda e: e["stage"]), ",").alias("stages"),
    ))


# --- gate --------------------------------------------------------------------

@query("reject_reasons", TRACE_SQL + "SELECT repo_name, pr_number, reasons FROM judged")
def reject_reasons(spark, sf_dir):
    return gate.reject_reasons(a.facts(spark, sf_dir)).select(
        *K, F.array_join("reject_reasons", ",").alias("reasons")
    )


@query("all_files_are", TRACE_SQL + """
SELECT repo_name, pr_number, CAST(coalesce(count(filename) > 0 AND bool_and(is_doc) FILTER (WHERE filename <> ''), false)
    AS BIGINT) AS all_doc,
  CAST(coalesce(bool_and(is_lock) FILTER (WHERE filename <> ''), false) AS BIGINT) AS all_lock,
  CAST(coalesce(bool_and(is_generated) FILTER (WHERE filename <> ''), false) AS BIGINT) AS all_generated
FROM files GROUP BY ALL""")
def all_files_are(spark, sf_dir):
    kinds = fj.classify_files(a.changed_files(spark, sf_dir).withColumn("named", text.nonempty(F.col("filename")))
                              .withColumn("filename", F.coalesce("filename", F.lit("[unnamed]"))))
    one = lambda c: F.sum((F.col("named") & F.col(c)).cast("long"))
    counts = kinds.groupBy(*K).agg(
        F.count_if("named").alias("named_count"), one("is_doc").alias("doc_count"),
        one("is_lock").alias("lock_count"), one("is_generated").alias("generated_count"),
    )
    return counts.select(*K, *[
        gate.all_files_are(f"{kind}_count").cast("long").alias(f"all_{kind}") for kind in ("doc", "lock", "generated")
    ])


@query("quality_score", TRACE_SQL + "SELECT repo_name, pr_number, score FROM judged")
def quality_score(spark, sf_dir):
    return a.judged(spark, sf_dir).select(*K, "quality.score")


_QUALITY_SQL = """repo_name, pr_number, CAST(accepted AS BIGINT) AS accepted, score,
  CASE WHEN accepted THEN 'mvp_silver' ELSE 'rejected' END AS tier, reasons, discussion_count, review_comment_count,
  meaningful_count AS meaningful_review_comment_count, source_file_count, source_patch_count, diff_lines"""


def _quality_columns():
    q = "quality."
    return [
        F.col(q + "accepted").cast("long").alias("accepted"), q + "score", q + "tier",
        F.array_join(q + "reject_reasons", ",").alias("reasons"), q + "discussion_count", q + "review_comment_count",
        q + "meaningful_review_comment_count", q + "source_file_count", q + "source_patch_count", q + "diff_lines",
    ]


@query("quality_gate", TRACE_SQL + f"SELECT {_QUALITY_SQL} FROM judged")
def quality_gate(spark, sf_dir):
    return a.judged(spark, sf_dir).select(*K, *_quality_columns())


@query("quality_gate_nested", TRACE_SQL + f"SELECT {_QUALITY_SQL} FROM judged WHERE NOT bad_pr AND NOT bad_files")
def quality_gate_nested(spark, sf_dir):
    """The gate on nested rows, as when traces arrive already assembled."""
    return a.slice_by_slice(spark, sf_dir, "judged_nested", lambda kept: gate.quality_gate(
        gate.nested_facts(a.enriched(spark, sf_dir, kept))).select(*K, *_quality_columns()))


@query("accept_reject_split", TRACE_SQL + """
SELECT example_id, CASE WHEN accepted THEN 'accepted' ELSE 'rejected' END AS output, score FROM judged
WHERE NOT bad_pr AND NOT bad_files""")
def accept_reject_split(spark, sf_dir):
    """Routing reads the written verdicts; the wide rows follow by key (``sink_trace_parquet``)."""
    rows = a.judged_table(spark, sf_dir).select(
        text.example_id(F.col("repo_name"), F.col("pr_number")).alias("example_id"), "quality"
    )
    accepted, rejected = traces.accept_reject_split(rows)
    show = lambda d, name: d.select("example_id", F.lit(name).alias("output"), "quality.score")
    return show(accepted, "accepted").unionByName(show(rejected, "rejected"))
