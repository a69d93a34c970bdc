"""Traces, chat rows, features, splits and samples."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tracemill.operators import encoder, features as ft, files as fj, gate, splits, traces
from tracemill.plans import analogs as a
from tracemill.plans.analogs import TRACE_SQL
from tracemill.plans.quality_queries import _ASSEMBLED_SQL, _joined
from tracemill.plans.registry import query
from tracemill.settings import DEFAULTS
from tracemill.storage import materialize, scratch_path

K = gate.KEY


def trace_rows(spark, sf_dir):
    """Slice -> its traces; the verdict comes from child counts, so no array is read for it."""
    judged = a.judged_table(spark, sf_dir)
    return lambda kept: traces.build_trace(a.enrich(spark, sf_dir, kept(judged), kept=kept))


def accepted_traces(spark, sf_dir):
    """Slice -> traces of its accepted requests only; child rows of all others are left out early."""
    rows = a.judged_table(spark, sf_dir).filter("quality.accepted")
    return lambda kept: traces.build_trace(a.enrich(spark, sf_dir, kept(rows), only_these=True, kept=kept))


@query("compact_children", _ASSEMBLED_SQL + """
SELECT repo_name, pr_number, files, states, rc_bodies, pc_bodies FROM asm""")
def compact_children(spark, sf_dir):
    rows = lambda kept: a.enriched(spark, sf_dir, kept).select(
        *K,
        traces.compact_children("files", traces.FILE_FIELDS).alias("files"),
        traces.compact_children("reviews", traces.REVIEW_FIELDS).alias("reviews"),
        traces.compact_children("review_comments", traces.REVIEW_COMMENT_FIELDS).alias("review_comments"),
        traces.compact_children("pr_comments", traces.COMMENT_FIELDS).alias("pr_comments"),
    )
    return a.slice_by_slice(spark, sf_dir, "compacted", lambda kept: rows(kept).select(
        *K, _joined("files", "filename").alias("files"), _joined("reviews", "state").alias("states"),
        _joined("review_comments", "body", True).alias("rc_bodies"),
        _joined("pr_comments", "body", True).alias("pc_bodies"),
    ))


@query("build_trace", _ASSEMBLED_SQL + """
SELECT example_id, j.repo_name AS repo, j.pr_number, html_url AS pr_url, l.linked_issue_number,
  issue_url AS linked_issue_url, issue_title, issue_login AS issue_author, j.title AS pr_title, j.login AS pr_author,
  j.merged_at, 'base' || CAST(j.pr_number AS VARCHAR) AS base_sha, j.commits, asm.files, asm.states, asm.rc_bodies,
  asm.pc_bodies, asm.issue_bodies, j.full_diff, score, CAST(accepted AS BIGINT) AS accepted,
  'gharchive_bigquery_plus_github_rest_api' AS source, j.retrieved_at, asm.stages
FROM judged j JOIN asm USING (repo_name, pr_number)
  JOIN (SELECT repo_name, pr_number, linked_issue_number, issue_url, issue_title, issue_login FROM linked) l
    USING (repo_name, pr_number)""")
def build_trace(spark, sf_dir):
    rows = trace_rows(spark, sf_dir)
    return a.slice_by_slice(spark, sf_dir, "traces", lambda kept: rows(kept).select(
        "example_id", "repo", "pr_number", "pr_url", "linked_issue_number", "linked_issue_url",
        F.col("issue.title").alias("issue_title"), F.col("issue.author.login").alias("issue_author"),
        F.col("pr.title").alias("pr_title"), F.col("pr.author.login").alias("pr_author"),
        "pr.merged_at", "pr.base_sha", "pr.commits",
        _joined("code_diff.files", "filename").alias("files"), _joined("review.reviews", "state").alias("states"),
        _joined("review.review_comments", "body", True).alias("rc_bodies"),
        _joined("discussion.pr_comments", "body", True).alias("pc_bodies"),
        _joined("issue.comments", "body", True).alias("issue_bodies"),
        "code_diff.full_diff", "quality.score", F.col("quality.accepted").cast("long").alias("accepted"),
        "provenance.source", "provenance.retrieved_at",
        F.array_join(F.transform("provenance.api_errors", lambda e: e["stage"]), ",").alias("stages"),
    ))


@query("source_patch_text", TRACE_SQL + """
SELECT repo_name, pr_number, md5(coalesce(patch_text, '')) AS digest, coalesce(length(patch_text), 0) AS n_chars
FROM good LEFT JOIN sizes USING (repo_name, pr_number)""")
def source_patch_text(spark, sf_dir):
    rows = lambda kept: a.enriched(spark, sf_dir, kept).withColumn("text", traces.source_patch_text(F.col("files")))
    return a.slice_by_slice(spark, sf_dir, "patch_texts", lambda kept: rows(kept).select(
        *K, F.md5("text").alias("digest"), F.length("text").cast("long").alias("n_chars")))


_SFT_SQL = _ASSEMBLED_SQL + """,
fd AS (SELECT repo_name, pr_number, string_agg('File: ' || coalesce(filename, 'None') || chr(10) || patch,
  chr(10) || chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS diff
  FROM files WHERE patch <> '' GROUP BY ALL),
tg AS (SELECT repo_name, pr_number, string_agg('File: ' || path || chr(10) || 'Comment: ' || body,
  chr(10) || chr(10) ORDER BY turn) AS target FROM rcs WHERE body <> '' GROUP BY ALL),
tk AS (SELECT repo_name, pr_number, string_agg(body, chr(10) || chr(10) ORDER BY turn) AS talk
  FROM pcs WHERE body <> '' GROUP BY ALL),
acc AS (SELECT * FROM judged WHERE accepted AND NOT bad_pr AND NOT bad_files),
s1 AS (
  SELECT example_id, 'code_review_generation' AS task_type,
    'PR title:' || chr(10) || coalesce(title, 'None') || chr(10) || chr(10) || 'PR description:' || chr(10)
      || coalesce(body, 'None') || chr(10) || chr(10) || 'Diff:' || chr(10) || coalesce(diff, '') AS prompt,
    coalesce(target, '') AS answer, repo_name AS repo, score
  FROM acc LEFT JOIN fd USING (repo_name, pr_number) LEFT JOIN tg USING (repo_name, pr_number)
  WHERE trim(coalesce(target, '')) <> ''),
s2 AS (
  SELECT example_id, 'issue_to_patch' AS task_type,
    'Issue title:' || chr(10) || coalesce(l.issue_title, 'None') || chr(10) || chr(10)
      || 'Issue body:' || chr(10) || coalesce(l.issue_body, 'None') || chr(10) || chr(10)
      || 'Issue discussion:' || chr(10) || coalesce(ti.talk, '') || chr(10) || chr(10)
      || 'PR description:' || chr(10) || coalesce(acc.body, 'None') || chr(10) || chr(10)
      || 'PR discussion:' || chr(10) || coalesce(tp.talk, '') AS prompt,
    acc.full_diff AS answer, acc.repo_name AS repo, score, issue_url AS linked_issue_url
  FROM acc JOIN (SELECT repo_name, pr_number, linked_issue_number, issue_url, issue_title, issue_body FROM linked) l
      USING (repo_name, pr_number)
    LEFT JOIN tk tp ON tp.repo_name = acc.repo_name AND tp.pr_number = acc.pr_number
    LEFT JOIN tk ti ON ti.repo_name = acc.repo_name AND ti.pr_number = l.linked_issue_number
  WHERE trim(coalesce(acc.full_diff, '')) <> '')
"""


def _chat(rows):
    return rows.select(
        "example_id", "task_type",
        F.md5(F.col("messages")[1]["content"]).alias("prompt"), F.md5(F.col("messages")[2]["content"]).alias("answer"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        "metadata.repo", "metadata.score",
        *(["metadata.linked_issue_url"] if "linked_issue_url" in rows.schema["metadata"].dataType.names else []),
    )


@query("sft_review", _SFT_SQL + """
SELECT example_id, task_type, md5(prompt) AS prompt, md5(answer) AS answer, 'system,user,assistant' AS roles, repo, score
FROM s1""")
def sft_review(spark, sf_dir):
    rows = accepted_traces(spark, sf_dir)
    return a.slice_by_slice(spark, sf_dir, "review_chats", lambda kept: _chat(traces.sft_review(rows(kept))))


@query("sft_issue_to_patch", _SFT_SQL + """
SELECT example_id, task_type, md5(prompt) AS prompt, md5(answer) AS answer, 'system,user,assistant' AS roles, repo, score,
  linked_issue_url FROM s2""")
def sft_issue_to_patch(spark, sf_dir):
    rows = accepted_traces(spark, sf_dir)
    return a.slice_by_slice(spark, sf_dir, "patch_chats", lambda kept: _chat(traces.sft_issue_to_patch(rows(kept))))


@query("sft_stats", _SFT_SQL + """
SELECT (SELECT count(*) FROM acc) AS accepted_loaded, (SELECT count(*) FROM s1) AS review_sft_rows,
  (SELECT count(*) FROM s2) AS issue_to_patch_sft_rows""")
def sft_stats(spark, sf_dir):
    return traces.sft_stats(accepted_traces(spark, sf_dir)(a.ALL))


# --- features ----------------------------------------------------------------

def feature_input(spark, sf_dir):
    """Judged facts with the linked issue and the top language, no nested rows."""
    judged = gate.quality_gate(gate.attach_counts(a.linked(spark, sf_dir, a.split_outcomes(spark, sf_dir)[0]), a.counts(spark, sf_dir)))
    lang = fj.top_language(a.changed_files(spark, sf_dir), a.file_order())
    return judged.withColumn("issue_body", F.col("linked_issue.body")).join(lang, K, "left")


_FEATURE_SQL = """
SELECT example_id, j.repo_name AS repo, j.pr_number, CAST(accepted AS BIGINT) AS accepted, score,
  coalesce(j.changed_files, 0) AS changed_files, coalesce(j.additions, 0) AS additions,
  coalesce(j.deletions, 0) AS deletions, diff_lines, review_count AS num_reviews,
  review_comment_count AS num_review_comments, meaningful_count AS num_meaningful_review_comments, discussion_count,
  CAST(l.linked_issue_number IS NOT NULL AS BIGINT) AS has_linked_issue, coalesce(length(j.body), 0) AS pr_body_length,
  coalesce(length(l.issue_body), 0) AS issue_body_length, source_file_count, source_patch_count,
  CASE WHEN coalesce(j.changed_files, 0) <> 0 THEN source_file_count::DOUBLE / j.changed_files ELSE 0 END
    AS source_file_ratio,
  CAST(changes_requested_count > 0 AS BIGINT) AS has_changes_requested,
  approved_count AS review_states_count_approved, commented_count AS review_states_count_commented,
  changes_requested_count AS review_states_count_changes_requested,
  coalesce(top_language, 'unknown') AS top_language, coalesce(j.author_association, 'UNKNOWN') AS author_association
FROM judged j LEFT JOIN toplang USING (repo_name, pr_number)
  JOIN (SELECT repo_name, pr_number, linked_issue_number, issue_body FROM linked) l USING (repo_name, pr_number)"""


@query("feature_table_v1", TRACE_SQL + _FEATURE_SQL)
def feature_table_v1(spark, sf_dir):
    return ft.feature_table_v1(feature_input(spark, sf_dir))


_MODEL_COLUMNS = """example_id, repo, pr_number, '' AS split, review_concern, accepted_quality, changed_files, additions,
  deletions, diff_lines, commits, pr_title_length, pr_body_length, has_pr_body, source_file_count, source_patch_count,
  source_file_ratio, source_patch_char_count, source_patch_token_count_raw,
  least(source_patch_token_count_raw, {cap}) AS source_patch_token_count_capped, top_language, author_association"""


@query("modeling_base", TRACE_SQL + f"SELECT {_MODEL_COLUMNS.format(cap=1000)} FROM mrows")
def modeling_base(spark, sf_dir):
    return a.modeling_rows(spark, sf_dir)


@query("token_counts", TRACE_SQL + """
SELECT repo_name, pr_number, length(patch_text) AS source_patch_char_count,
  len(regexp_extract_all(patch_text, '\\w+')) AS source_patch_token_count_raw,
  least(len(regexp_extract_all(patch_text, '\\w+')), 40) AS source_patch_token_count_capped FROM sizes""")
def token_counts(spark, sf_dir):
    return ft.token_counts(ft.patch_sizes(a.changed_files(spark, sf_dir)), cap=40)


@query("diff_embedding")
def diff_embedding(spark, sf_dir):
    docs = a.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = ft.hashed_embedding(docs, "text", DEFAULTS.model.token_cap, DEFAULTS.model.embedding_width)
    return rows.select("doc_id", "diff_emb")


_ENCODER = encoder.EncoderRules()

# Tokens by place, pairs of the most frequent ones near each other, and their information.
_PAIRS_SQL = f"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[^\\pL\\pM\\p{{Nd}}\\p{{Pc}}]+'), lambda x: x <> '')[1:{_ENCODER.cap}] AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS at FROM t),
k AS (SELECT w FROM p GROUP BY w ORDER BY count(*) DESC, w LIMIT {_ENCODER.words}),
u AS (SELECT p.* FROM p JOIN k USING (w)),
c AS (SELECT a.w AS i, b.w AS j, count(*) AS n FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.at <> a.at AND b.at BETWEEN a.at - {_ENCODER.window} AND a.at + {_ENCODER.window} GROUP BY ALL),
s AS (SELECT i, sum(n) AS s FROM c GROUP BY i),
v AS (SELECT c.i, c.n, ln(c.n * (SELECT sum(n)::DOUBLE FROM c) / (x.s::DOUBLE * y.s)) AS v FROM c JOIN s x ON x.i = c.i JOIN s y ON y.i = c.j)
SELECT i AS token, CAST(sum(n) AS BIGINT) AS n_near, count(*) FILTER (WHERE v > 1e-9) AS n_informative,
  round(coalesce(sum(v) FILTER (WHERE v > 1e-9), 0), 5) AS information
FROM v GROUP BY i"""


@query("token_information", _PAIRS_SQL)
def token_information(spark, sf_dir):
    """What the encoder learns from: near pairs of the frequent tokens and their information, summed up by token."""
    docs = a.table(spark, sf_dir, "documents")
    tokens = materialize(docs.select(encoder.first_tokens(F.col("text"), _ENCODER.cap).alias("tokens")), "tokens")
    units = encoder.find_units(tokens, replace(_ENCODER, trigrams=0))
    pairs = materialize(encoder.pair_table(tokens, units, _ENCODER.window), "pairs")
    names = spark.createDataFrame(list(enumerate(units)), "i int, token string")
    found = encoder.informative(pairs, _ENCODER.shift).filter("v > 1e-9").groupBy("i").agg(
        F.count(F.lit(1)).alias("n_informative"), F.round(F.sum("v"), 5).alias("information"))
    near = pairs.groupBy("i").agg(F.sum("n").alias("n_near"))
    return near.join(found, "i", "left").join(names, "i").select(
        "token", "n_near", F.coalesce("n_informative", F.lit(0).cast("long")).alias("n_informative"), F.coalesce("information", F.lit(0.0)).alias("information"))


@query("learned_embedding")
def learned_embedding(spark, sf_dir):
    """An encoder learned from the documents, saved and loaded, and every document's vector."""
    docs = a.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "encoder")
    encoder.save_encoder(spark, encoder.fit(docs, "text", _ENCODER), path)
    return encoder.encode(docs, "text", encoder.load_encoder(spark, path, _ENCODER), ("doc_id",))


@query("diff_embedding_norms", """
SELECT doc_id, CAST(768 AS BIGINT) AS width, CASE WHEN regexp_matches(text, '[\\pL\\pN]') THEN 1.0 ELSE 0.0 END AS norm
FROM documents""")
def diff_embedding_norms(spark, sf_dir):
    """Every embedding has the full width and unit length (zero without any token)."""
    emb = diff_embedding(spark, sf_dir)
    square = F.aggregate("diff_emb", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return emb.select(
        "doc_id", F.size("diff_emb").cast("long").alias("width"), F.round(F.sqrt(square), 4).alias("norm")
    )


def _one_hot_sql() -> str:
    langs = [f"CAST(top_language = '{v}' AS BIGINT) AS lang_{name}" for v, name in ft.LANGUAGE_NAMES.items()]
    # The priorities that stand for author associations.
    seen = {
        "1-URGENT": "1_urgent", "2-HIGH": "2_high", "3-MEDIUM": "3_medium", "4-NOT SPECIFIED": "4_not_specified",
        "5-LOW": "5_low", "UNKNOWN": "unknown",
    }
    authors = [f"CAST(author_association = '{v}' AS BIGINT) AS author_{name}" for v, name in seen.items()]
    return "SELECT example_id, " + ", ".join(langs + authors) + " FROM mrows"


@query("one_hot", TRACE_SQL + _one_hot_sql())
def one_hot(spark, sf_dir):
    # Both categories without the rest of the modeling table.
    lang = fj.top_language(a.changed_files(spark, sf_dir), a.file_order())
    association = F.upper(F.coalesce("author_association", F.lit("UNKNOWN"))).alias("author_association")
    people = _with_id(a.split_outcomes(spark, sf_dir)[0]).select(*K, "example_id", association)
    seen = ft.observed_associations(people)
    base = people.join(lang, K, "left").withColumn("top_language", F.coalesce("top_language", F.lit("unknown")))
    rows, columns = ft.one_hot(base, seen)
    return rows.select("example_id", *[F.col(c).cast("long").alias(c) for c in columns])


@query("fill_features", TRACE_SQL + """
SELECT repo_name, pr_number, coalesce(changed_files, 0) AS changed_files, coalesce(additions, 0) AS additions,
  coalesce(deletions, 0) AS deletions, commits FROM prs""")
def fill_features(spark, sf_dir):
    columns = ["changed_files", "additions", "deletions", "commits"]
    return ft.fill_features(a.requests(spark, sf_dir).select(*K, *columns), columns)


def _manifest_sql() -> str:
    groups = {
        "numeric": ft.NUMERIC_COLUMNS,
        "language": [f"lang_{name}" for name in ft.LANGUAGE_NAMES.values()],
        "metadata": ft.METADATA_COLUMNS,
    }
    fixed = " UNION ALL ".join(
        f"SELECT '{g}' AS column_group, CAST({i} AS BIGINT) AS position, '{c}' AS column_name"
        for g, cols in groups.items() for i, c in enumerate(cols)
    )
    return TRACE_SQL + f""",
assoc AS (SELECT DISTINCT upper(coalesce(author_association, 'UNKNOWN')) AS v FROM prs)
SELECT *, CAST(column_name IN ('accepted_quality') AS BIGINT) AS leaks FROM ({fixed}
  UNION ALL SELECT 'author', row_number() OVER (ORDER BY v) - 1,
    'author_' || trim(regexp_replace(lower(v), '[^a-z0-9]+', '_', 'g'), '_') FROM assoc)"""


@query("feature_manifest", _manifest_sql())
def feature_manifest(spark, sf_dir):
    """Column groups in order; the categories are observed in the whole table."""
    from tracemill.functions.text import safe_name

    groups = {
        "numeric": ft.NUMERIC_COLUMNS,
        "language": [f"lang_{name}" for name in ft.LANGUAGE_NAMES.values()],
        "metadata": ft.METADATA_COLUMNS,
    }
    assoc = a.requests(spark, sf_dir).select(
        F.upper(F.coalesce("author_association", F.lit("UNKNOWN"))).alias("v")
    ).agg(F.array_sort(F.collect_set("v")).alias("vs"))
    entry = lambda g, i, c: F.struct(
        F.lit(g).alias("column_group"), i.cast("long").alias("position"), c.alias("column_name"))
    fixed = F.array(*[entry(g, F.lit(i), F.lit(c)) for g, cols in groups.items() for i, c in enumerate(cols)])
    seen = F.transform("vs", lambda v, i: entry("author", i, F.concat(F.lit("author_"), safe_name(v))))
    return ft.manifest_table(assoc.select(F.explode(F.concat(fixed, seen)).alias("r")).select("r.*"))


@query("prep_summary", TRACE_SQL + """
SELECT count(*) AS raw_rows, CAST(sum(accepted_quality) AS BIGINT) AS accepted_quality_rows,
  count(*) FILTER (WHERE source_patch_char_count = 0) AS empty_source_patch_rows,
  count(*) FILTER (WHERE review_concern IS NULL) AS label_excluded,
  count(*) FILTER (WHERE review_concern = 0) AS label_0, count(*) FILTER (WHERE review_concern = 1) AS label_1,
  CAST(sum(source_patch_token_count_raw) AS BIGINT) AS tokens_raw_total,
  CAST(sum(least(source_patch_token_count_raw, 40)) AS BIGINT) AS tokens_capped_total,
  count(*) FILTER (WHERE source_patch_token_count_raw > 40) AS rows_over_token_cap FROM mrows""")
def prep_summary(spark, sf_dir):
    return ft.prep_summary(a.modeling_rows(spark, sf_dir, cap=40), cap=40)


@query("prep_top_reject_reasons", TRACE_SQL + """
SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM judged
WHERE reasons <> '') GROUP BY ALL ORDER BY n_rows DESC, reason LIMIT 10""")
def prep_top_reject_reasons(spark, sf_dir):
    from tracemill.operators.profiling import reject_reason_counts

    return reject_reason_counts(a.judged(spark, sf_dir)).orderBy(F.desc("n_rows"), "reason").limit(10)


# --- splits and samples ------------------------------------------------------

def _split_sql(rows: str, labelled: str) -> str:
    return f""",
repos AS (SELECT repo, row_number() OVER (ORDER BY md5('42:' || repo), repo) AS rk, count(*) OVER () AS n
  FROM (SELECT DISTINCT repo FROM {rows} WHERE {labelled} AND repo <> '')),
smap AS (SELECT repo, CASE WHEN rk <= floor(n * 0.8::DOUBLE) THEN 'train'
  WHEN rk <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM repos)"""


@query("split_by_repo", TRACE_SQL + ", r AS (SELECT *, repo_name AS repo FROM judged)" + _split_sql("r", "true") + """
SELECT repo, example_id, split FROM r JOIN smap USING (repo)""")
def split_by_repo(spark, sf_dir):
    from tracemill.functions.text import example_id

    rows = a.split_outcomes(spark, sf_dir)[0].select(
        F.col("repo_name").alias("repo"), example_id(F.col("repo_name"), F.col("pr_number")).alias("example_id")
    )
    return splits.split_by_repo(rows)


_LABELED_SQL = TRACE_SQL + _split_sql("mrows", "review_concern IS NOT NULL") + """,
labeled AS (SELECT mrows.*, coalesce(split, 'excluded') AS split,
  split IS NOT NULL AND review_concern IS NOT NULL AS in_matrix FROM mrows LEFT JOIN smap USING (repo))
"""


def labeled_rows(spark, sf_dir):
    rows = a.judged(spark, sf_dir).select(
        F.col("repo_name").alias("repo"), "pr_number", gate.review_concern_label().alias("review_concern"),
        F.col("quality.accepted").alias("accepted"),
    )
    return splits.split_labeled(rows, "review_concern")


@query("split_labeled", _LABELED_SQL + """
SELECT repo, pr_number, review_concern, split, CAST(in_matrix AS BIGINT) AS in_matrix FROM labeled""")
def splitlabeled_rows(spark, sf_dir):
    return labeled_rows(spark, sf_dir).select(
        "repo", "pr_number", "review_concern", "split", F.col("in_matrix").cast("long").alias("in_matrix")
    )


@query("split_summary", _LABELED_SQL + """
SELECT coalesce(split, 'all') AS split, count(*) AS n_rows, count(DISTINCT repo) AS repos,
  count(*) FILTER (WHERE review_concern = 0) AS label_0, count(*) FILTER (WHERE review_concern = 1) AS label_1,
  CAST(sum(accepted_quality) AS BIGINT) AS accepted_rows
FROM labeled GROUP BY ROLLUP (split)""")
def split_summary(spark, sf_dir):
    # Written once: the summary reads it for rows, labels and repositories.
    return splits.split_summary(materialize(labeled_rows(spark, sf_dir), "labeled"), "review_concern", "accepted")


_AUDIT_SQL = _ASSEMBLED_SQL + """,
strata AS (
  SELECT example_id, 1 AS stratum FROM judged WHERE accepted UNION ALL
  SELECT example_id, 2 FROM judged WHERE NOT accepted UNION ALL
  SELECT example_id, 3 FROM judged WHERE score BETWEEN 60 AND 80),
drawn AS (
  SELECT example_id, stratum, row_number() OVER (PARTITION BY stratum
    ORDER BY md5('42:' || CAST(stratum AS VARCHAR) || ':' || example_id), example_id) AS rn FROM strata),
sample AS (
  SELECT example_id, min(stratum) AS stratum FROM drawn
  WHERE rn <= CASE stratum WHEN 1 THEN 150 ELSE 50 END GROUP BY ALL)
"""


def _with_id(rows):
    from tracemill.functions.text import example_id

    return rows.withColumn("example_id", example_id(F.col("repo_name"), F.col("pr_number")))


def _audit_sample(spark, sf_dir):
    # The sampler reads its input three times: ids and verdicts are written once.
    verdicts = _with_id(a.judged(spark, sf_dir)).select("example_id", "quality")
    return splits.audit_sample(materialize(verdicts, "verdicts"))


@query("audit_sample", _AUDIT_SQL + "SELECT example_id, CAST(stratum AS BIGINT) AS stratum FROM sample")
def audit_sample(spark, sf_dir):
    return _audit_sample(spark, sf_dir).select("example_id", F.col("stratum").cast("long").alias("stratum"))


@query("audit_rows", _AUDIT_SQL + """,
fp AS (SELECT repo_name, pr_number, string_agg(coalesce(filename, 'None') || ' +' || CAST(additions AS VARCHAR) || ' -'
    || CAST(deletions AS VARCHAR), chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)
    AS files_preview FROM (SELECT *, row_number() OVER (PARTITION BY repo_name, pr_number
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM files) WHERE rn <= 5 GROUP BY ALL),
rp AS (SELECT repo_name, pr_number, substr(string_agg(coalesce(body, ''), chr(10) || chr(10) ORDER BY turn), 1, 1500)
    AS review_preview FROM (SELECT *, row_number() OVER (PARTITION BY repo_name, pr_number ORDER BY turn) AS rn
      FROM rcs) WHERE rn <= 3 GROUP BY ALL)
SELECT j.example_id, j.repo_name AS repo, j.html_url AS pr_url, l.issue_url AS linked_issue_url, l.issue_title,
  j.title AS pr_title, j.score, CAST(j.accepted AS BIGINT) AS accepted, j.reasons AS reject_reasons, j.discussion_count,
  j.meaningful_count AS meaningful_review_comment_count, j.source_patch_count,
  coalesce(files_preview, '') AS files_preview, coalesce(review_preview, '') AS review_preview,
  'accept_good,reject_trivial,reject_bad_issue_link,reject_weak_review,reject_docs_only,reject_deps_only,reject_bad_diff,reject_no_real_problem,reject_other' AS valid_labels,
  '' AS human_label, '' AS human_notes
FROM judged j JOIN sample USING (example_id)
  JOIN (SELECT repo_name, pr_number, issue_url, issue_title FROM linked WHERE NOT bad_pr AND NOT bad_files) l
    USING (repo_name, pr_number)
  LEFT JOIN fp USING (repo_name, pr_number) LEFT JOIN rp USING (repo_name, pr_number)""")
def audit_rows(spark, sf_dir):
    return audited(spark, sf_dir).withColumn("accepted", F.col("accepted").cast("long"))


def audited(spark, sf_dir):
    """Only the sampled requests, a few hundred, are assembled."""
    verdicts = _with_id(a.judged_table(spark, sf_dir))
    sample = materialize(splits.audit_sample(verdicts.select("example_id", "quality")), "audit-ids")
    # Written: its size then tells that child rows are kept by a lookup, ahead of any exchange.
    rows = materialize(verdicts.join(F.broadcast(sample), "example_id", "left_semi"), "audit-rows")
    return splits.audit_rows(traces.build_trace(a.enrich(spark, sf_dir, rows, only_these=True)), sample)
