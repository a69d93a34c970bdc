"""Reports, data card and exploratory profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.functions import paths
from tracemill.operators import drift, gate, profiling as p, sketches
from tracemill.plans import analogs as a
from tracemill.plans.analogs import TRACE_SQL
from tracemill.plans.registry import query
from tracemill.sources.batches import BatchTable
from tracemill.storage import materialize, scratch_path

K = gate.KEY

_ACCEPTED_FILES_SQL = """,
af AS (SELECT files.* FROM files JOIN (SELECT repo_name, pr_number FROM judged WHERE accepted) USING (repo_name, pr_number)),
fails AS (SELECT * FROM prs WHERE bad_pr OR bad_files)
"""


@query("quality_report", TRACE_SQL + _ACCEPTED_FILES_SQL + """
SELECT count(*) AS total_examples, count(*) FILTER (WHERE accepted) AS accepted,
  count(*) FILTER (WHERE NOT accepted) AS rejected, (SELECT count(*) FROM fails) AS failed_api_fetch,
  count(*) FILTER (WHERE accepted) / count(*)::DOUBLE AS acceptance_rate,
  coalesce(avg(score) FILTER (WHERE accepted), 0) AS avg_score_accepted,
  coalesce(avg(coalesce(changed_files, 0)) FILTER (WHERE accepted), 0) AS avg_changed_files_accepted,
  coalesce(avg(diff_lines) FILTER (WHERE accepted), 0) AS avg_diff_lines_accepted,
  coalesce(avg(meaningful_count) FILTER (WHERE accepted), 0) AS avg_meaningful_review_comments,
  coalesce(avg(discussion_count) FILTER (WHERE accepted), 0) AS avg_discussion_count
FROM judged""")
def quality_report(spark, sf_dir):
    return p.quality_report(a.judged(spark, sf_dir), a.failures(spark, sf_dir))


@query("reject_reason_counts", TRACE_SQL + """
SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM judged
WHERE reasons <> '') GROUP BY ALL""")
def reject_reason_counts(spark, sf_dir):
    return p.reject_reason_counts(a.judged(spark, sf_dir))


@query("top_extensions", TRACE_SQL + _ACCEPTED_FILES_SQL + r"""
SELECT regexp_extract(coalesce(filename, ''), '(\.[^.]*)$', 1) AS extension, count(*) AS n_rows FROM af GROUP BY ALL
ORDER BY n_rows DESC, extension LIMIT 20""")
def top_extensions(spark, sf_dir):
    return p.top_extensions(a.accepted_files(spark, sf_dir))


@query("top_repos", TRACE_SQL + """
SELECT repo_name AS repo, count(*) AS n_rows FROM judged WHERE accepted GROUP BY ALL
ORDER BY n_rows DESC, repo LIMIT 20""")
def top_repos(spark, sf_dir):
    return p.top_repos(a.judged(spark, sf_dir).filter("quality.accepted"))


@query("data_card_stats", TRACE_SQL + _ACCEPTED_FILES_SQL + """,
t AS (SELECT count(*) FILTER (WHERE accepted) AS acc, count(*) FILTER (WHERE NOT accepted) AS rej,
  count(DISTINCT repo_name) AS repos FROM judged)
SELECT 'summary' AS section, 'accepted' AS name, acc::DOUBLE AS value FROM t
UNION ALL SELECT 'summary', 'rejected', rej::DOUBLE FROM t
UNION ALL SELECT 'summary', 'failed_api_fetch', (SELECT count(*) FROM fails)::DOUBLE
UNION ALL SELECT 'summary', 'acceptance_rate', acc::DOUBLE / (acc + rej) FROM t
UNION ALL SELECT 'summary', 'unique_repos', repos::DOUBLE FROM t
UNION ALL SELECT 'language', language, n::DOUBLE FROM (SELECT language, count(*) AS n FROM af WHERE language IS NOT NULL
  GROUP BY ALL ORDER BY n DESC, language LIMIT 10)""")
def data_card_stats(spark, sf_dir):
    return p.data_card_stats(a.judged(spark, sf_dir), a.failures(spark, sf_dir), a.accepted_files(spark, sf_dir))


_EDA_SQL = TRACE_SQL + """,
eda AS (
  SELECT repo_name AS repo, pr_number, login AS author, coalesce(author_type, 'UNKNOWN') AS author_type,
    coalesce(author_association, 'UNKNOWN') AS author_association, is_bot AS is_bot_author,
    substr(created_at, 1, 7) AS created_month, substr(coalesce(merged_at, closed_at), 1, 7) AS merged_month,
    substr(retrieved_at, 1, 10) AS retrieved_day, true AS has_pr, file_count > 0 AS has_files,
    review_count > 0 AS has_reviews, review_comment_count > 0 AS has_review_comments,
    discussion_count > 0 AS has_pr_comments, coalesce(full_diff, '') <> '' AS has_full_diff,
    source_file_count > 0 AS has_source_file, api_error_count,
    coalesce(changed_files, 3) AS changed_files, coalesce(additions, cand_additions) AS additions,
    coalesce(deletions, cand_deletions) AS deletions,
    coalesce(additions, cand_additions) + coalesce(deletions, cand_deletions) AS diff_lines, commits, file_count,
    source_file_count, review_count, review_comment_count, meaningful_count AS meaningful_review_comment_count,
    discussion_count AS pr_comment_count, coalesce(length(full_diff), 0) AS full_diff_chars,
    CAST(changes_requested_count > 0 OR meaningful_count >= 2 AS BIGINT) AS review_concern,
    accepted AS accepted_current_filters, score AS quality_score
  FROM judged)
"""
_BOOLEANS = [
    "is_bot_author", "has_pr", "has_files", "has_reviews", "has_review_comments", "has_pr_comments", "has_full_diff",
    "has_source_file", "accepted_current_filters",
]


def _records(spark, sf_dir):
    return p.eda_records(a.judged(spark, sf_dir))


@query("eda_records", _EDA_SQL + "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _BOOLEANS)
       + ") FROM eda")
def eda_records(spark, sf_dir):
    return _records(spark, sf_dir).withColumns({c: F.col(c).cast("long") for c in _BOOLEANS})


@query("date_keys", TRACE_SQL + """
SELECT repo_name, pr_number, substr(created_at, 1, 7) AS created_month, substr(retrieved_at, 1, 10) AS retrieved_day,
  CAST(NULL AS VARCHAR) AS bad_month FROM prs""")
def date_keys(spark, sf_dir):
    from tracemill.functions.text import day_key, month_key

    return a.requests(spark, sf_dir).select(
        *K, month_key(F.col("created_at")).alias("created_month"), day_key(F.col("retrieved_at")).alias("retrieved_day"),
        month_key(F.col("html_url")).alias("bad_month"),
    )


@query("eda_headline", _EDA_SQL + """
SELECT count(*) AS records, CAST(0 AS BIGINT) AS json_errors, count(DISTINCT repo) AS repositories,
  count(DISTINCT author) AS authors, count(*) FILTER (WHERE accepted_current_filters) AS accepted_current_filters,
  round(avg(CAST(accepted_current_filters AS INT)), 4) AS acceptance_rate,
  round(avg(review_concern), 4) AS review_concern_positive_rate,
  count(*) FILTER (WHERE api_error_count > 0) AS api_error_rows FROM eda""")
def eda_headline(spark, sf_dir):
    return p.eda_headline(_records(spark, sf_dir))


def _completeness_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS field, avg(CAST({c} AS INT)) AS rate, 100 * avg(CAST({c} AS INT)) AS percent FROM eda"
        for c, label in p.COMPLETENESS_PARTS.items()
    )


@query("completeness", _EDA_SQL + _completeness_sql())
def completeness(spark, sf_dir):
    return p.completeness(_records(spark, sf_dir))


@query("numeric_describe", _EDA_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, count({c}) AS count, avg({c}) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
      quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.9) AS p90,
      quantile_cont({c}::DOUBLE, 0.99) AS p99, max({c}) AS max FROM eda""" for c in p.DESCRIBED_COLUMNS))
def numeric_describe(spark, sf_dir):
    return p.numeric_describe(_records(spark, sf_dir)).withColumn("std", F.round("std", 6))


@query("extension_language_top", TRACE_SQL + r"""
SELECT 'extension' AS kind, * FROM (SELECT CASE WHEN length(coalesce(ext, '')) > 1 THEN ext ELSE '[none]' END AS name,
  count(*) AS n_rows FROM files GROUP BY ALL ORDER BY n_rows DESC, name LIMIT 20)
UNION ALL SELECT 'language', * FROM (SELECT language AS name, count(*) AS n_rows FROM files WHERE language IS NOT NULL
  GROUP BY ALL ORDER BY n_rows DESC, name LIMIT 20)""")
def extension_language_top(spark, sf_dir):
    return p.extension_language_top(a.changed_files(spark, sf_dir))


@query("api_error_stages", TRACE_SQL + """
SELECT stage, count(*) AS n_errors FROM (SELECT 'full_diff' AS stage FROM good WHERE bad_diff
  UNION ALL SELECT 'linked_issue' FROM good WHERE bad_issue) GROUP BY ALL""")
def api_error_stages(spark, sf_dir):
    good, _ = a.split_outcomes(spark, sf_dir)
    return p.api_error_stages(good)


@query("timeline", _EDA_SQL + """,
c AS (SELECT created_month AS month, count(*) AS created FROM eda GROUP BY ALL),
m AS (SELECT merged_month AS month, count(*) AS merged FROM eda GROUP BY ALL)
SELECT month, coalesce(created, 0) AS created, coalesce(merged, 0) AS merged FROM c FULL JOIN m USING (month)
WHERE month IS NOT NULL""")
def timeline(spark, sf_dir):
    from tracemill.functions.text import month_key, nonempty

    when = F.when(nonempty(F.col("merged_at")), F.col("merged_at")).otherwise(F.col("closed_at"))
    months = a.split_outcomes(spark, sf_dir)[0].select(
        month_key(F.col("created_at")).alias("created_month"), month_key(when).alias("merged_month")
    )
    return p.timeline(months)


def _histogram_sql(c: str) -> str:
    return f"""SELECT '{c}' AS metric, CAST(least(CASE WHEN upper > lower
    THEN floor((least({c}, upper) - lower) / ((upper - lower) / 35)) ELSE 0 END, 34) AS BIGINT) AS bin, lower, upper,
    count(*) AS n_rows
  FROM eda, (SELECT least(min({c})::DOUBLE, quantile_cont({c}::DOUBLE, 0.99)) AS lower,
    quantile_cont({c}::DOUBLE, 0.99) AS upper FROM eda) GROUP BY ALL"""


@query("clipped_histogram", _EDA_SQL + """
SELECT metric, bin, lower + bin * ((upper - lower) / 35) AS bin_start, upper, n_rows FROM (
""" + " UNION ALL ".join(_histogram_sql(c) for c in p.HISTOGRAM_COLUMNS) + ")")
def clipped_histogram(spark, sf_dir):
    return p.clipped_histogram(_records(spark, sf_dir))


@query("acceptance_breakdown", _EDA_SQL + """
SELECT CASE WHEN accepted_current_filters THEN 'Accepted' ELSE 'Rejected' END AS status, count(*) AS n_rows
FROM eda GROUP BY ALL""")
def acceptance_breakdown(spark, sf_dir):
    return p.acceptance_breakdown(_records(spark, sf_dir))


def _totals_sql() -> str:
    cols = {
        "files": "file_count", "reviews": "review_count", "review_comments": "review_comment_count",
        "pr_comments": "discussion_count", "additions": "coalesce(additions, 0)", "deletions": "coalesce(deletions, 0)",
    }
    sums = ", ".join(f"CAST(sum({e}) AS BIGINT) AS total_{n}, avg({e}) AS avg_{n}" for n, e in cols.items())
    spans = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in ("created_at", "merged_at", "retrieved_at"))
    return f"""SELECT count(*) AS n_rows, count(DISTINCT repo_name) AS repositories, count(closed_at) AS closed_rows,
      count(merged_at) AS merged_rows, count(*) FILTER (WHERE full_diff <> '') AS rows_with_diff,
      count(*) FILTER (WHERE api_error_count > 0) AS rows_with_errors, {sums}, {spans} FROM judged"""


@query("dataset_totals", TRACE_SQL + _totals_sql())
def dataset_totals(spark, sf_dir):
    return p.dataset_totals(a.judged(spark, sf_dir))


@query("release_drift", TRACE_SQL + """
SELECT substr(created_at, 1, 4) AS release, count(*) AS n_rows, count(*) FILTER (WHERE accepted) AS accepted_rows,
  avg(CAST(source_patch_count = 0 AS INT)) AS missing_patch_rate, avg(review_concern) AS positive_rate,
  avg(review_concern) - lag(avg(review_concern)) OVER (ORDER BY substr(created_at, 1, 4)) AS positive_rate_change
FROM judged GROUP BY substr(created_at, 1, 4)""")
def release_drift(spark, sf_dir):
    from pyspark.sql import Window

    rows = a.judged(spark, sf_dir).withColumn("release", F.substring("created_at", 1, 4))
    metrics = p.release_metrics(rows, "release")
    # One row per release is left.
    before = F.lag("positive_rate").over(Window.orderBy("release"))
    return metrics.withColumn("positive_rate_change", F.col("positive_rate") - before)


_MEASURES_SQL = """,
y AS (SELECT *, substr(created_at, 1, 4) AS release FROM judged WHERE created_at IS NOT NULL),
cells AS (
  SELECT release, 'accepted' AS measure, CASE WHEN accepted THEN 'true' ELSE 'false' END AS bucket FROM y
  UNION ALL SELECT release, 'review_concern', coalesce(CAST(review_concern AS VARCHAR), '(none)') FROM y
  UNION ALL SELECT release, 'missing_patch', CASE WHEN source_patch_count = 0 THEN 'true' ELSE 'false' END FROM y
  UNION ALL SELECT release, 'diff_size', CAST(CAST(floor(log2(greatest(diff_lines, 0) + 1)) AS BIGINT) AS VARCHAR) FROM y
  UNION ALL SELECT release, 'language', language FROM y JOIN files USING (repo_name, pr_number) WHERE language IS NOT NULL),
h AS (SELECT release, measure, bucket, count(*) AS n FROM cells GROUP BY ALL),
o AS (SELECT release, lag(release) OVER (ORDER BY release) AS previous FROM (SELECT DISTINCT release FROM h)),
al AS (
  SELECT release, previous, measure, bucket, sum(n1) AS n1, sum(n0) AS n0 FROM (
    SELECT o.release, o.previous, measure, bucket, n AS n1, 0 AS n0 FROM o JOIN h USING (release) WHERE o.previous IS NOT NULL
    UNION ALL SELECT o.release, o.previous, measure, bucket, 0, n FROM o JOIN h ON h.release = o.previous) GROUP BY ALL),
sh AS (SELECT *, sum(n1) OVER w AS a1, sum(n0) OVER w AS a0, count(*) OVER w AS k FROM al WINDOW w AS (PARTITION BY release, measure)),
pq AS (SELECT *, n1 / a1::DOUBLE AS p, n0 / a0::DOUBLE AS q, (n1 + 0.5) / (a1 + 0.5 * k)::DOUBLE AS sp, (n0 + 0.5) / (a0 + 0.5 * k)::DOUBLE AS sq
  FROM sh WHERE a1 > 0 AND a0 > 0),
ds AS (SELECT release, previous, measure, sum((sp - sq) * ln(sp / sq)) AS psi,
  sqrt(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END), 0)) AS js FROM pq GROUP BY ALL)
SELECT release, previous, measure, round(psi, 7) AS psi, round(js, 6) AS js_distance,
  CASE WHEN psi >= 0.25 THEN 'strong' WHEN psi >= 0.1 THEN 'moderate' ELSE 'none' END AS alarm FROM ds"""


@query("release_distances", TRACE_SQL + _MEASURES_SQL)
def release_distances(spark, sf_dir):
    """Distances between yearly releases: verdicts, labels, missing patches, sizes and the language mix."""
    per_language = gate.language_facts()
    rows = materialize(a.judged(spark, sf_dir, languages=True).select(
        F.substring("created_at", 1, 4).alias("release"), F.col("quality.accepted").alias("accepted"),
        gate.review_concern_label().alias("review_concern"), (F.col("source_patch_count") == 0).alias("missing_patch"),
        drift.size_bucket(gate.size_of_change()).alias("diff_size"), *per_language.values()), "releases")
    found = drift.histograms(rows, F.col("release"), {c: F.col(c) for c in ("accepted", "review_concern", "missing_patch", "diff_size")})
    # Files were counted with the other facts of their request, so they are neither read nor joined again.
    totals = rows.groupBy("release").agg(*[F.sum(c).alias(c) for c in per_language.values()])
    languages = totals.select("release", F.inline(F.array(*[
        F.struct(F.lit(name).alias("language"), F.col(c).alias("n_files")) for name, c in per_language.items()]))).filter("n_files > 0")
    mix = drift.histograms(languages, F.col("release"), {"language": F.col("language")}, weight=F.col("n_files"))
    return drift.distances(found, mix).withColumns({"psi": F.round("psi", 7), "js_distance": F.round("js_distance", 6)})


_SIZES = {"diff_size": "diff_lines", "files": "file_count", "review_comments": "review_comment_count"}


def _landed_profile(spark, sf_dir):
    """Verdicts as two landings, months of an even number and the late others; each leaves a few rows."""
    table = BatchTable(spark, scratch_path(spark, "profile"))
    rows = materialize(a.judged(spark, sf_dir).select(
        F.substring("created_at", 1, 7).alias("month"), "repo_name", gate.size_of_change().alias("diff_lines"), "file_count", "review_comment_count"), "sizes")
    for name, wanted in (("even", "month is null or substring(month, 7, 1) in ('0', '2', '4', '6', '8')"), ("odd", "substring(month, 7, 1) in ('1', '3', '5', '7', '9')")):
        found = sketches.batch_sketches(
            rows.filter(wanted), F.col("month"), {m: F.col(c) for m, c in _SIZES.items()}, {"repositories": F.col("repo_name")})
        table.commit(name, {"sketches": lambda at, found=found: found.write.parquet(at["sketches"])})
    return table.read("sketches", sketches.SKETCH)


_LADDER_SQL = ",\nv AS (" + " UNION ALL ".join(f"SELECT '{m}' AS measure, CAST({c} AS DOUBLE) AS v FROM judged WHERE {c} IS NOT NULL" for m, c in _SIZES.items()) + """),
b AS (SELECT measure, v, CASE WHEN v > 0 THEN CAST((floor(log2(v)) + 1100) * 64 + least(floor((v / pow(2, floor(log2(v))) - 1) * 64), 63) + 1 AS BIGINT) ELSE 0 END AS bucket FROM v),
n AS (SELECT measure, bucket, count(*) AS n FROM b GROUP BY ALL),
l AS (SELECT *, sum(n) OVER (PARTITION BY measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY measure) AS total FROM n)
SELECT measure, step, CASE WHEN bucket = 0 THEN 0 ELSE pow(2, (bucket - 1) // 64 - 1100) * (1 + ((bucket - 1) % 64) / 64) END::DOUBLE AS quantile
FROM l, (SELECT unnest(range(0, 21)) AS step)
WHERE upto >= greatest(ceil(total * step / 20), 1) AND upto - n < greatest(ceil(total * step / 20), 1)"""


@query("landed_quantiles", TRACE_SQL + _LADDER_SQL)
def landed_quantiles(spark, sf_dir):
    """Quantiles of everything landed, from the sketches of the landings."""
    return sketches.merged_quantiles(_landed_profile(spark, sf_dir))


@query("landed_totals", TRACE_SQL + " UNION ALL ".join(
    f"SELECT '{m}' AS measure, count({c}) AS n, sum({c})::DOUBLE AS total, avg({c})::DOUBLE AS mean, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most FROM judged"
    for m, c in _SIZES.items()))
def landed_totals(spark, sf_dir):
    found = sketches.merged_totals(_landed_profile(spark, sf_dir)).filter("total is not null")
    return found.drop("distinct_values")


@query("success_criteria", TRACE_SQL + _ACCEPTED_FILES_SQL + """,
m AS (SELECT count(*) FILTER (WHERE accepted)::DOUBLE AS accepted_traces, count(DISTINCT repo_name)::DOUBLE AS repositories,
  (SELECT count(DISTINCT language) FROM af)::DOUBLE AS source_languages,
  coalesce(avg(CAST(merged AND review_count > 0 AND source_patch_count > 0 AND coalesce(full_diff, '') <> '' AS INT))
    FILTER (WHERE accepted), 0) AS complete_traces FROM judged),
u AS (SELECT 'accepted_traces' AS criterion, 5000.0::DOUBLE AS target, accepted_traces AS measured FROM m
  UNION ALL SELECT 'repositories', 500.0, repositories FROM m
  UNION ALL SELECT 'source_languages', 3.0, source_languages FROM m
  UNION ALL SELECT 'complete_traces', 0.95, complete_traces FROM m)
SELECT *, CASE WHEN measured >= target THEN 'pass' ELSE 'fail' END AS status FROM u""")
def success_criteria(spark, sf_dir):
    return p.success_criteria(a.judged(spark, sf_dir), a.accepted_files(spark, sf_dir))
