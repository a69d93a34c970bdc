"""Candidate discovery from an activity log: filter, conditional aggregate, threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill import schemas
from tracemill.functions.text import nonempty
from tracemill.settings import CandidateRules

# Event types of the log.
CLOSE_EVENT = "PullRequestEvent"
COMMENT_EVENT = "IssueCommentEvent"
REVIEW_EVENT = "PullRequestReviewEvent"
REVIEW_COMMENT_EVENT = "PullRequestReviewCommentEvent"
ACTIVITY_EVENTS = [COMMENT_EVENT, REVIEW_EVENT, REVIEW_COMMENT_EVENT]

KEY = ["repo_name", "pr_number"]
TEXT_FIELDS = {"pr_url": "html_url", "pr_title": "title", "pr_body": "body", "merge_commit_sha": "merge_commit_sha"}
NUMBER_FIELDS = ["additions", "deletions", "changed_files"]


def is_valid_event() -> Column:
    """A repository, a time and a payload that is an object (or absent)."""
    payload = F.ltrim("payload")
    object_like = payload.isNull() | payload.startswith("{") | payload.isin("", "null", "[]", "0", "false")
    return nonempty(F.col("repo.name")) & nonempty(F.col("created_at")) & object_like


def valid_events(events: DataFrame) -> DataFrame:
    return events.filter(is_valid_event())


def lenient_int(text: Column) -> Column:
    return F.trim(text).try_cast("long")


def parse_activity(events: DataFrame) -> DataFrame:
    """Flatten the valid events: one JSON parse per row, all fields lenient.

    Types that no operator uses are dropped before the payload is parsed.
    """
    used = valid_events(events).filter(F.col("type").isin([CLOSE_EVENT, *ACTIVITY_EVENTS]))
    # The payload struct stays a projection of its own in the plan: one parse per row.
    parsed = used.withColumn("p", F.from_json("payload", schemas.EVENT_PAYLOAD))
    pr = "p.pull_request."
    return parsed.select(
        F.col("repo.name").alias("repo_name"),
        "type",
        "created_at",
        F.col("p.action").alias("action"),
        F.col(pr + "merged").alias("merged"),
        lenient_int(F.col(pr + "number")).alias("own_number"),
        lenient_int(F.col("p.issue.number")).alias("issue_number"),
        *[F.col(pr + src).alias(dst) for dst, src in TEXT_FIELDS.items()],
        *[lenient_int(F.col(pr + c)).alias(c) for c in NUMBER_FIELDS],
        *[c for c in events.columns if c not in ("type", "repo", "created_at", "payload")],
    )


def is_merged_close(any_case: bool = True) -> Column:
    merged = F.lower("merged") if any_case else F.col("merged")
    return F.coalesce(
        (F.col("type") == CLOSE_EVENT) & (F.col("action") == "closed") & (merged == "true"), F.lit(False)
    )


def merged_closes(activity: DataFrame, any_case: bool = True) -> DataFrame:
    return activity.filter(is_merged_close(any_case))


def resolved_number() -> Column:
    """Own number, else the number of the issue the event belongs to."""
    return F.coalesce("own_number", "issue_number")


def pr_number_resolve(activity: DataFrame) -> DataFrame:
    """Activity rows with their number; rows without any number are dropped."""
    return (
        activity.filter(F.col("type").isin(ACTIVITY_EVENTS))
        .withColumn("pr_number", resolved_number())
        .filter(F.col("pr_number").isNotNull())
    )


def _last_present(name: str, keep: Column, when: Column, order: Column) -> Column:
    """Value of the latest row (by ``order``) in which ``keep`` holds."""
    return F.max_by(F.col(name), F.when(when & keep, order)).alias(name)


def _metadata_columns(when: Column, order: Column) -> list[Column]:
    """Per-column last value that is present: empty text never wins, zero does."""
    texts = [_last_present(c, nonempty(F.col(c)), when, order) for c in TEXT_FIELDS]
    numbers = [_last_present(c, F.col(c).isNotNull(), when, order) for c in NUMBER_FIELDS]
    return [*texts, *numbers]


def _activity_columns() -> list[Column]:
    count = lambda t: F.count_if(F.col("type") == t)
    active = F.col("type").isin(ACTIVITY_EVENTS)
    seen = F.when(active, F.col("created_at"))
    return [
        count(COMMENT_EVENT).alias("issue_comment_events"),
        count(REVIEW_EVENT).alias("review_events"),
        count(REVIEW_COMMENT_EVENT).alias("review_comment_events"),
        F.min(seen).alias("first_seen_at"),
        F.max(seen).alias("last_seen_at"),
    ]


def merged_pr_metadata(activity: DataFrame, order: Column, variant: str = "latest") -> DataFrame:
    """One row per merged request with its last known metadata.

    ``variant="distinct"`` keeps one row per distinct metadata instead, as a
    plain GROUP BY over all fields does.
    """
    if variant == "distinct":
        fields = [*TEXT_FIELDS, *NUMBER_FIELDS]
        return (
            merged_closes(activity, any_case=False)
            .withColumn("pr_number", F.col("own_number"))
            .groupBy(*KEY, *fields)
            .agg(F.min("created_at").alias("pr_closed_at"))
        )
    return (
        merged_closes(activity)
        .withColumn("pr_number", F.col("own_number"))
        .filter(F.col("pr_number").isNotNull())
        .groupBy(*KEY)
        .agg(
            *_metadata_columns(F.lit(True), order),
            F.count(F.lit(1)).alias("merged_close_events"),
            F.min("created_at").alias("pr_closed_at"),
        )
    )


def activity_counts(activity: DataFrame) -> DataFrame:
    """Comments, reviews and review comments per request, with first and last time."""
    return pr_number_resolve(activity).groupBy(*KEY).agg(*_activity_columns())


def candidate_join(metadata: DataFrame, counts: DataFrame) -> DataFrame:
    return metadata.join(counts, KEY, "inner")


def candidate_filter(rows: DataFrame, rules: CandidateRules = CandidateRules(), null_is_zero: bool = True) -> DataFrame:
    lines = [F.coalesce(c, F.lit(0)) if null_is_zero else F.col(c) for c in ("additions", "deletions")]
    keep = (
        F.col("changed_files").between(rules.min_changed_files, rules.max_changed_files)
        & (lines[0] + lines[1]).between(rules.min_diff_lines, rules.max_diff_lines)
        & (F.col("issue_comment_events") >= rules.min_issue_comments)
        & (F.col("review_events") >= rules.min_reviews)
        & (F.col("review_comment_events") >= rules.min_review_comments)
    )
    if "merged_close_events" in rows.columns:
        keep = keep & (F.col("merged_close_events") > 0)
    return rows.filter(keep)


def candidates(activity: DataFrame, order: Column, rules: CandidateRules = CandidateRules(),
               variant: str = "latest") -> DataFrame:
    """The whole chain, 14 columns.

    Both sides reduce map-side to one row per request and task before they are
    shuffled by the request, and the join uses that partitioning.
    """
    columns = schemas.CANDIDATE.fieldNames()
    if variant == "distinct":
        joined = candidate_join(
            merged_pr_metadata(activity, order, variant="distinct"), activity_counts(activity)
        )
        return candidate_filter(joined, rules, null_is_zero=False).select(columns)
    # Texts are sorted for few rows only, the merged closes; the many others are counted.
    counts = activity_counts(activity)
    totals = ["issue_comment_events", "review_events", "review_comment_events"]
    grouped = merged_pr_metadata(activity, order).join(counts, KEY, "left").na.fill(0, totals)
    return candidate_filter(grouped, rules).select(columns)


def candidate_partials(activity: DataFrame, order: Column) -> DataFrame:
    """What a part of the log knows about each request, in a form that parts add up in.

    Counts and times as in ``candidates``; each metadata column comes with the
    place (``order``) of the row it is from, so the latest of two parts is known.
    """
    number = F.when(is_merged_close(), F.col("own_number")).when(F.col("type").isin(ACTIVITY_EVENTS), resolved_number())
    rows = activity.withColumn("pr_number", number).filter(F.col("pr_number").isNotNull())
    close = is_merged_close()
    present = {**{c: nonempty(F.col(c)) for c in TEXT_FIELDS}, **{c: F.col(c).isNotNull() for c in NUMBER_FIELDS}}
    places = [F.max(F.when(close & keep, order)).alias(f"{c}_at") for c, keep in present.items()]
    return rows.groupBy(*KEY).agg(
        *_activity_columns(), *_metadata_columns(close, order), *places,
        F.count_if(close).alias("merged_close_events"), F.min(F.when(close, F.col("created_at"))).alias("pr_closed_at"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per request again; merging merged rows gives the same."""
    fields = [*TEXT_FIELDS, *NUMBER_FIELDS]
    total = ["issue_comment_events", "review_events", "review_comment_events", "merged_close_events"]
    return partials.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in total],
        *[F.min(c).alias(c) for c in ("first_seen_at", "pr_closed_at")], F.max("last_seen_at").alias("last_seen_at"),
        *[F.max_by(c, f"{c}_at").alias(c) for c in fields], *[F.max(f"{c}_at").alias(f"{c}_at") for c in fields])


def candidates_of_partials(partials: DataFrame, rules: CandidateRules = CandidateRules()) -> DataFrame:
    """``candidates`` from parts of the log: no event is read again."""
    return candidate_filter(merge_partials(partials), rules).select(schemas.CANDIDATE.fieldNames())


def candidate_stats(rows: DataFrame, steps: int = 20, accuracy: int = 10000) -> DataFrame:
    """Count and quantile sketches of size, files and review comments."""
    probs = [i / steps for i in range(steps + 1)]
    sketch = lambda c: F.percentile_approx(c, probs, accuracy)
    return rows.agg(
        F.count(F.lit(1)).alias("candidates"),
        sketch(F.col("additions") + F.col("deletions")).alias("diff_size_quantiles"),
        sketch(F.col("changed_files")).alias("changed_files_quantiles"),
        sketch(F.col("review_comment_events")).alias("review_comment_quantiles"),
    )


def candidate_random_peek(rows: DataFrame, digest: Column, n: int = 50) -> DataFrame:
    """A repeatable random glance: top-n by digest, one heap per task."""
    fields = [
        "repo_name", "pr_number", "pr_url", "pr_title", "additions", "deletions", "changed_files",
        "issue_comment_events", "review_events", "review_comment_events",
    ]
    return rows.orderBy(digest, *KEY).limit(n).select(fields)


def event_log_stats(events: DataFrame) -> DataFrame:
    """Parsed and broken lines of a scan, and the files they came from."""
    return events.agg(
        F.count_distinct("file_name").alias("input_files"),
        F.count_if(~F.col("is_bad_json")).alias("parsed_events"),
        F.count_if("is_bad_json").alias("json_errors"),
        F.count_if(~F.col("is_bad_json") & is_valid_event()).alias("valid_events"),
    )
