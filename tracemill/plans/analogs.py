"""The given tables reshaped into the schemas the operators take.

Three shapes: an activity log from ``events``; requests with child tables from
``orders``, ``lineitem``, ``conversations`` and ``events``; a labelled frame
from ``documents`` and ``labels``. One repository holds a third of all
requests, so every job runs on skewed keys.

``ACTIVITY_SQL``, ``TRACE_SQL`` and ``FRAME_SQL`` define the same shapes in
plain SQL for the oracle queries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators import enrichment, features, files as file_jobs, gate
from tracemill.settings import GateRules
from tracemill.storage import Workspace

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
REQUESTS_TOGETHER = 25_000  # of a partition, about: their nested rows are sorted in memory
REQUESTS_AT_ONCE = 1_500_000  # of a slice, about: their wide rows are moved, and are on disk, at one time
SENT_WHOLE = 32 << 20  # bytes of text of a table that goes to every executor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


# --- activity log -----------------------------------------------------------

def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """type, repo, created_at, payload (JSON text) and ``seq``."""
    # props is {"k": n}; cut out by position, as filters pushed below this projection repeat it.
    ev = table(spark, sf_dir, "events").withColumn(
        "k", F.substring_index(F.substring_index("props", ": ", -1), "}", 1).cast("long")
    )
    number = "cast(user_id * 3 + event_id % 3 as string)"
    close = f"""concat(
        '{{"action":"', if(k % 10 = 0, 'opened', 'closed'), '","pull_request":{{"number":', {number},
        ',"merged":', case k % 7 when 0 then 'false' when 1 then '"True"' else 'true' end,
        ',"html_url":"https://code.example/', {number},
        '","title":', if(k % 5 = 0, '""', concat('"Change ', k, '"')),
        ',"body":null,"merge_commit_sha":"sha', event_id,
        '","additions":', if(k % 9 = 0, 'null', cast(k * 3 as string)),
        ',"deletions":', cast(cast(floor(value) as bigint) as string),
        ',"changed_files":', if(k % 13 = 0, '"x"', cast(k % 40 as string)), '}}}}')"""
    activity = f"""case
        when k = 83 then '{{}}'
        when k % 4 = 0 then concat('{{"pull_request":{{"number":', {number}, '}}}}')
        when k % 4 = 1 then concat('{{"issue":{{"number":', {number}, '}}}}')
        when k % 4 = 2 then concat('{{"pull_request":{{"number":"x"}},"issue":{{"number":"', {number}, '"}}}}')
        else concat('{{"pull_request":null,"issue":{{"number":', {number}, '}}}}') end"""
    return ev.select(
        F.expr("""case event_type when 'purchase' then 'PullRequestEvent' when 'click' then 'IssueCommentEvent'
            when 'view' then 'PullRequestReviewEvent' when 'error' then 'PullRequestReviewCommentEvent'
            else 'WatchEvent' end""").alias("type"),
        F.struct(
            F.expr("if(k = 97, null, concat('org', user_id % 15, '/app', user_id % 15))").alias("name")
        ).alias("repo"),
        F.when(F.col("k") != 96, iso(F.col("ts"))).alias("created_at"),
        F.expr(f"case when k = 95 then '[1]' when event_type = 'purchase' then {close} else {activity} end")
        .alias("payload"),
        F.col("event_id").alias("seq"),
    )


ACTIVITY_SQL = """
WITH raw AS (
  SELECT event_id AS seq, ts, event_type, value, user_id, user_id * 3 + event_id % 3 AS num,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
log AS (
  SELECT seq, k, num,
    CASE event_type WHEN 'purchase' THEN 'PullRequestEvent' WHEN 'click' THEN 'IssueCommentEvent'
      WHEN 'view' THEN 'PullRequestReviewEvent' WHEN 'error' THEN 'PullRequestReviewCommentEvent'
      ELSE 'WatchEvent' END AS type,
    CASE WHEN k <> 97 THEN 'org' || CAST(user_id % 15 AS VARCHAR) || '/app' || CAST(user_id % 15 AS VARCHAR) END
      AS repo_name,
    CASE WHEN k <> 96 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
    value
  FROM raw),
valid AS (SELECT * FROM log WHERE repo_name IS NOT NULL AND created_at IS NOT NULL AND k <> 95),
act AS (
  SELECT seq, k, type, repo_name, created_at, num,
    CASE WHEN type = 'PullRequestEvent' THEN CASE WHEN k % 10 = 0 THEN 'opened' ELSE 'closed' END END AS action,
    CASE WHEN type = 'PullRequestEvent' THEN CASE k % 7 WHEN 0 THEN 'false' WHEN 1 THEN 'True' ELSE 'true' END END
      AS merged,
    'https://code.example/' || CAST(num AS VARCHAR) AS pr_url,
    CASE WHEN k % 5 <> 0 THEN 'Change ' || CAST(k AS VARCHAR) END AS pr_title,
    CAST(NULL AS VARCHAR) AS pr_body,
    'sha' || CAST(seq AS VARCHAR) AS merge_commit_sha,
    CASE WHEN k % 9 <> 0 THEN k * 3 END AS additions,
    CAST(floor(value) AS BIGINT) AS deletions,
    CASE WHEN k % 13 <> 0 THEN k % 40 END AS changed_files,
    type IN ('IssueCommentEvent', 'PullRequestReviewEvent', 'PullRequestReviewCommentEvent') AND k <> 83 AS active
  FROM valid WHERE type <> 'WatchEvent'),
closes AS (SELECT * FROM act WHERE type = 'PullRequestEvent' AND action = 'closed' AND lower(merged) = 'true'),
meta AS (
  SELECT repo_name, num AS pr_number,
    max_by(pr_url, seq) AS pr_url,
    max_by(pr_title, seq) FILTER (WHERE pr_title IS NOT NULL) AS pr_title,
    max_by(pr_body, seq) FILTER (WHERE pr_body IS NOT NULL) AS pr_body,
    max_by(merge_commit_sha, seq) AS merge_commit_sha,
    max_by(additions, seq) FILTER (WHERE additions IS NOT NULL) AS additions,
    max_by(deletions, seq) AS deletions,
    max_by(changed_files, seq) FILTER (WHERE changed_files IS NOT NULL) AS changed_files,
    count(*) AS merged_close_events, min(created_at) AS pr_closed_at
  FROM closes GROUP BY ALL),
counts AS (
  SELECT repo_name, num AS pr_number,
    count(*) FILTER (WHERE type = 'IssueCommentEvent') AS issue_comment_events,
    count(*) FILTER (WHERE type = 'PullRequestReviewEvent') AS review_events,
    count(*) FILTER (WHERE type = 'PullRequestReviewCommentEvent') AS review_comment_events,
    min(created_at) AS first_seen_at, max(created_at) AS last_seen_at
  FROM act WHERE active GROUP BY ALL),
joined AS (SELECT * FROM meta JOIN counts USING (repo_name, pr_number)),
cand AS (
  SELECT repo_name, pr_number, pr_url, pr_title, pr_body, merge_commit_sha, additions, deletions, changed_files,
    issue_comment_events, review_events, review_comment_events, first_seen_at, last_seen_at
  FROM joined
  WHERE changed_files BETWEEN 2 AND 30
    AND coalesce(additions, 0) + coalesce(deletions, 0) BETWEEN 50 AND 2000
    AND issue_comment_events >= 2 AND review_events >= 1 AND review_comment_events >= 2)
"""


# --- requests and their child tables ----------------------------------------

_REPO = (
    "case when {k} % 3 = 0 then 'org0/mono' "
    "else concat('team', ({k} div 30) % 10, '/proj', {k} div 30) end"
)


def repo_of(key: str) -> Column:
    return F.expr(_REPO.format(k=key))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the flat fields of a request."""
    text = lambda e: F.expr(e)
    closed = F.expr("o_orderdate + make_interval(0, 0, 0, cast(o_orderkey % 45 as int))")
    return table(spark, sf_dir, "orders").select(
        repo_of("o_orderkey").alias("repo_name"),
        F.col("o_orderkey").alias("pr_number"),
        text("concat('https://code.example/pull/', o_orderkey)").alias("html_url"),
        text("if(o_orderkey % 17 = 0, null, concat('Change ', o_orderkey, ' in ', o_orderstatus))").alias("title"),
        text("""case when o_orderkey % 3 = 2 then concat('Work on it. Closes #', o_orderkey - 1)
            when o_orderkey % 6 = 0 then concat('resolved  #', o_orderkey - 3)
            when o_orderkey % 7 = 0 then null
            else concat('No link, prefixes #', o_orderkey) end""").alias("body"),
        text("""case when o_custkey % 20 = 0 then concat('Helper', o_custkey, '[BOT]')
            when o_custkey % 20 = 1 then concat('Renovate-', o_custkey)
            when o_custkey % 50 = 7 then null else concat('dev', o_custkey) end""").alias("login"),
        text("if(o_custkey % 20 = 0, 'Bot', if(o_custkey % 50 = 8, null, 'User'))").alias("author_type"),
        text("if(o_orderkey % 23 = 0, null, o_orderpriority)").alias("author_association"),
        (F.col("o_orderstatus") != "P").alias("merged"),
        iso(F.col("o_orderdate")).alias("created_at"),
        iso(closed).alias("updated_at"),
        iso(closed).alias("closed_at"),
        F.when(F.col("o_orderstatus") != "P", iso(closed)).alias("merged_at"),
        text("concat('base', o_orderkey)").alias("base_sha"),
        text("concat('head', o_orderkey)").alias("head_sha"),
        text("concat('merge', o_orderkey)").alias("merge_commit_sha"),
        text("if(o_orderkey % 4 = 0, null, 1 + o_orderkey % 33)").alias("changed_files"),
        text("cast(floor(o_totalprice / 220) as bigint)").alias("additions"),
        text("if(o_orderkey % 41 = 0, null, o_orderkey % 50)").alias("deletions"),
        text("o_orderkey % 9").alias("commits"),
        text("""case when o_orderkey % 29 = 0 then '' when o_orderkey % 31 = 0 then null
            else concat('diff --git ', o_orderkey, '\\n+', o_orderpriority) end""").alias("full_diff"),
        text("if(o_orderkey % 2 = 0, '2026-05-01T00:00:00Z', '2026-05-02T12:30:00Z')").alias("retrieved_at"),
        text("o_orderkey % 100").alias("cand_additions"),
        text("o_orderkey % 10").alias("cand_deletions"),
        F.lit(3).cast("long").alias("cand_changed_files"),
        text("""if(o_orderkey % 31 = 0, named_struct('error_type', 'HTTPError', 'message', 'diff too large',
            'status_code', 406L), null)""").alias("err_full_diff"),
        text("""if(o_orderkey % 37 = 0, named_struct('error_type', 'ReadTimeout', 'message', 'slow',
            'status_code', cast(null as bigint)), null)""").alias("err_linked_issue"),
        text("""if(o_custkey % 40 = 3, named_struct('error_type', 'HTTPError', 'message', 'not found',
            'status_code', 404L), null)""").alias("err_pr"),
        text("""if(o_custkey % 60 = 7, named_struct('error_type', 'ReadTimeout', 'message', 'files slow',
            'status_code', cast(null as bigint)), null)""").alias("err_files"),
        (F.expr("o_orderkey % 31 = 0").cast("long") + F.expr("o_orderkey % 37 = 0").cast("long"))
        .alias("api_error_count"),
        F.lit(True).alias("has_pr"),
        (~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))).alias("has_activity"),
    )


FILE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: a changed file of the order's request."""
    return table(spark, sf_dir, "lineitem").select(
        repo_of("l_orderkey").alias("repo_name"),
        F.col("l_orderkey").alias("pr_number"),
        *FILE_ORDER,
        F.expr("""if(l_suppkey % 50 = 49, null, concat(
            case l_suppkey % 5 when 0 then 'src/' when 1 then 'lib/' when 2 then 'Docs/' when 3 then 'vendor/'
                else 'tests/v1.2/' end,
            case when l_partkey % 60 = 8 then '.gitignore' when l_partkey % 12 = 7 then 'yarn.lock'
                else concat('p', l_partkey, case l_partkey % 12 when 0 then if(l_partkey % 24 = 0, '.py', '.PY')
                    when 1 then '.js' when 2 then '.ts' when 3 then '.go' when 4 then '.java' when 5 then '.rs'
                    when 6 then '.md' when 8 then '.json' when 9 then '.h' when 10 then '.cpp' else '.txt' end) end))
            """).alias("filename"),
        F.lit("modified").alias("status"),
        F.col("l_quantity").cast("long").alias("additions"),
        F.col("l_linenumber").cast("long").alias("deletions"),
        F.expr("""case when l_returnflag = 'R' then null when l_linenumber = 7 then ''
            else concat('@@ -', l_linenumber, ' +', cast(l_quantity as bigint), ' @@\\n+value ', l_linestatus) end""")
        .alias("patch"),
    )


def _active_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of requests that took part in a review."""
    return (
        table(spark, sf_dir, "orders")
        .filter(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")))
        .select("o_orderkey")
    )


@dataclass(frozen=True)
class Slice:
    """The requests of one of ``of`` equal shares by key, and rows of child tables that belong to them."""

    of: int = 1
    number: int = 0

    def __call__(self, rows: DataFrame) -> DataFrame:
        if self.of == 1:
            return rows
        return rows.filter(F.pmod(F.xxhash64(F.lit("slice"), *gate.KEY), F.lit(self.of)) == self.number)


ALL = Slice()


def slices(spark: SparkSession, sf_dir: str) -> list[Slice]:
    of = max(1, -(-table(spark, sf_dir, "orders").count() // REQUESTS_AT_ONCE))
    return [Slice(of, k) for k in range(of)]


def slice_by_slice(spark: SparkSession, sf_dir: str, name: str, do: Callable[[Slice], DataFrame], written: bool = False) -> DataFrame:
    """``do`` over all requests. Of more than one slice each is written, and what it has moved is gone, before the next
    one; a single slice only if ``written``."""
    each = slices(spark, sf_dir)
    if len(each) == 1 and not written:
        return do(ALL)
    ws = Workspace(spark)
    return reduce(DataFrame.unionByName, [ws.save(do(s), f"{name}{s.number}", compression="zstd") for s in each])


def request_parts(spark: SparkSession, sf_dir: str, kept: Slice = ALL) -> int:
    """Partitions that hold ``REQUESTS_TOGETHER`` requests each.

    Stated as a number: narrow keys that wide rows are joined to would else be
    put together by their own size, and the wide rows would not fit into memory.
    """
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "orders").count() // (kept.of * REQUESTS_TOGETHER)))


def _keyed(keys: DataFrame, residue: Column) -> DataFrame:
    return keys.select(repo_of("o_orderkey").alias("repo_name"), F.col("o_orderkey").alias("pr_number"), residue.alias("__r"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    per = ev.agg(F.floor((F.max("event_id") + 1) / 3).alias("n")).scalar()
    keys = _keyed(_active_keys(spark, sf_dir), F.col("o_orderkey") % per)
    return keys.join(ev.withColumn("__r", F.col("event_id") % per), "__r").select(
        "repo_name",
        "pr_number",
        "event_id",
        F.expr("concat('rev', user_id)").alias("login"),
        F.expr("""case event_type when 'error' then if(event_id % 5 = 0, 'changes_requested', 'CHANGES_REQUESTED')
            when 'click' then 'COMMENTED' when 'purchase' then 'APPROVED' when 'view' then 'DISMISSED' end""")
        .alias("state"),
        F.col("props").alias("body"),
        iso(F.col("ts")).alias("submitted_at"),
    )


def _turns(spark: SparkSession, sf_dir: str, keys: DataFrame, role: str, body: str, nested: bool, kept: Slice) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    per = conv.agg((F.max("conv_id") + 1).alias("n")).scalar()
    talk = conv.filter(F.col("role") == role).withColumnRenamed("conv_id", "__r")
    keyed = kept(_keyed(keys, F.col("o_orderkey") % per))
    if not nested:
        # What is counted moves as flags later: its keys are spread for the join, which else would move them twice, into
        # as many partitions as fit.
        joined = keyed.repartition("__r").join(talk, "__r")
    else:
        # Wide rows move once at most. Small texts go to keys that are dealt out by request, and nothing wide moves at all.
        # Else the rows are dealt out after the join, into the partitions that they are nested in.
        parts = request_parts(spark, sf_dir, kept)
        if (talk.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0) <= SENT_WHOLE:
            joined = keyed.repartition(parts, *gate.KEY).join(F.broadcast(talk), "__r")
        else:
            joined = keyed.join(talk, "__r").repartition(parts, *gate.KEY)
    return joined.select(
        "repo_name",
        "pr_number",
        "turn",
        F.expr("pr_number * 100 + turn").alias("comment_id"),
        F.expr("concat(role, turn)").alias("login"),
        F.expr(body).alias("body"),
        F.expr("concat('src/p', turn, '.py')").alias("path"),
    )


def review_comments(spark: SparkSession, sf_dir: str, nested: bool = True, kept: Slice = ALL) -> DataFrame:
    body = """case when (turn + pr_number) % 9 = 2 then null
        when (turn + pr_number) % 4 = 1 then concat(repeat(' ', 40), 'LGTM\\n') else text end"""
    return _turns(spark, sf_dir, _active_keys(spark, sf_dir), "assistant", body, nested, kept)


def comments(spark: SparkSession, sf_dir: str, nested: bool = True, kept: Slice = ALL) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return _turns(spark, sf_dir, keys, "user", "if((turn + pr_number) % 8 = 3, null, text)", nested, kept)


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        repo_of("o_orderkey").alias("repo_name"),
        F.col("o_orderkey").alias("number"),
        (F.col("o_custkey") % 5 == 0).alias("is_pull_request"),
        F.expr("concat('https://code.example/issues/', o_orderkey)").alias("html_url"),
        F.expr("concat('Issue ', o_orderkey)").alias("title"),
        F.expr("concat('Problem: ', o_orderpriority)").alias("body"),
        F.struct(
            F.expr("concat('rep', o_custkey)").alias("login"),
            F.lit("User").alias("type"),
            F.lit(None).cast("string").alias("html_url"),
        ).alias("user"),
        iso(F.col("o_orderdate")).alias("created_at"),
        iso(F.col("o_orderdate")).alias("updated_at"),
    )


def facts(spark: SparkSession, sf_dir: str, languages: bool = False) -> DataFrame:
    """Requests that arrived whole with all gate inputs, from child-table counts.

    Failed requests are no traces: they are counted as failures and judged nowhere.
    """
    return gate.attach_counts(split_outcomes(spark, sf_dir)[0], counts(spark, sf_dir, languages))


def counts(spark: SparkSession, sf_dir: str, languages: bool = False, kept: Slice = ALL) -> DataFrame:
    return gate.child_counts(
        kept(changed_files(spark, sf_dir)), kept(reviews(spark, sf_dir)), review_comments(spark, sf_dir, False, kept),
        comments(spark, sf_dir, False, kept), request_parts(spark, sf_dir, kept), languages)


def judged(spark: SparkSession, sf_dir: str, rules: GateRules = GateRules(), languages: bool = False) -> DataFrame:
    return gate.quality_gate(facts(spark, sf_dir, languages), rules)


def file_order() -> Column:
    return F.struct(*FILE_ORDER)


def accepted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = judged(spark, sf_dir).filter("quality.accepted").select(*gate.KEY)
    return changed_files(spark, sf_dir).join(keys, gate.KEY, "left_semi")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_outcomes(spark, sf_dir)[1]


def split_outcomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return failures_of(requests(spark, sf_dir))


def failures_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return enrichment.failure_split(
        rows.withColumn("candidate", F.struct(*gate.KEY, "cand_additions")),
        {"pr": "err_pr", "files": "err_files"},
        {"full_diff": "err_full_diff", "linked_issue": "err_linked_issue"},
    )


def linked(spark: SparkSession, sf_dir: str, prs: DataFrame | None = None, kept: Slice = ALL) -> DataFrame:
    """Dealt out by request, as all that is joined to the rows is: they move once."""
    prs = kept(prs if prs is not None else requests(spark, sf_dir))
    extracted = enrichment.linked_issue_extract(prs)
    return enrichment.linked_issue_join(
        extracted, issues(spark, sf_dir), ["html_url", "title", "body", "user", "created_at", "updated_at"],
        request_parts(spark, sf_dir, kept))


def user_struct(login: Column, kind: Column | None = None) -> Column:
    return F.struct(
        login.alias("login"),
        (kind if kind is not None else F.lit("User")).alias("type"),
        F.concat(F.lit("https://code.example/"), login).alias("html_url"),
    )


def _null(kind: str, name: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def children(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None, kept: Slice = ALL) -> list[enrichment.Child]:
    """The four child tables, all of them or only those of the given requests."""
    these = (lambda d: d.join(keys.select(*gate.KEY), gate.KEY, "left_semi")) if keys is not None else (lambda d: d)
    parts = request_parts(spark, sf_dir, kept)
    user = user_struct(F.col("login")).alias("user")
    file_item = [
        "filename", "status", "additions", "deletions", (F.col("additions") + F.col("deletions")).alias("changes"),
        "patch", _null("string", "raw_url"), _null("string", "blob_url"), _null("string", "previous_filename"),
    ]
    review_item = [
        F.col("event_id").alias("id"), user, "state", "body", "submitted_at",
        _null("string", "commit_id"), _null("string", "html_url"),
    ]
    line_item = [
        F.col("comment_id").alias("id"), user, "path", _null("string", "diff_hunk"), "body",
        _null("string", "created_at"), _null("string", "updated_at"), _null("string", "commit_id"),
        _null("string", "original_commit_id"), F.col("turn").alias("line"), _null("bigint", "original_line"),
        _null("string", "html_url"),
    ]
    return [
        enrichment.Child("files", these(kept(changed_files(spark, sf_dir))).repartition(parts, *gate.KEY), FILE_ORDER, file_item),
        enrichment.Child("reviews", these(kept(reviews(spark, sf_dir))).repartition(parts, *gate.KEY), ["event_id"], review_item),
        enrichment.Child("review_comments", these(review_comments(spark, sf_dir, kept=kept)), ["turn"], line_item),
        conversation(these(comments(spark, sf_dir, kept=kept))),
    ]


def conversation(rows: DataFrame) -> enrichment.Child:
    item = [
        F.col("comment_id").alias("id"), user_struct(F.col("login")).alias("user"), "body",
        _null("string", "created_at"), _null("string", "updated_at"), _null("string", "html_url"),
    ]
    return enrichment.Child("pr_comments", rows, ["turn"], item)


def verdict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat judged rows of all requests, with issue link and error columns.

    Written once: the verdict decides which wide child rows are touched at all,
    and several steps read it.
    """
    return slice_by_slice(spark, sf_dir, "judged", lambda kept: gate.quality_gate(
        gate.attach_counts(linked(spark, sf_dir, kept=kept), counts(spark, sf_dir, kept=kept))), written=True)


def judged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written verdicts of the requests that arrived whole."""
    good, _ = failures_of(verdict_table(spark, sf_dir))
    return good


def enriched(spark: SparkSession, sf_dir: str, kept: Slice = ALL) -> DataFrame:
    """Nested rows of every request that arrived whole."""
    good, _ = failures_of(linked(spark, sf_dir, kept=kept))
    return enrich(spark, sf_dir, good, kept=kept)


def enrich(spark: SparkSession, sf_dir: str, rows: DataFrame, only_these: bool = False, kept: Slice = ALL) -> DataFrame:
    """Assemble the given linked requests; ``only_these`` skips child rows of all others."""
    extra = [c for c in ("quality",) if c in rows.columns]
    spine = rows.select(
        *gate.KEY,
        F.struct(
            *gate.KEY, F.col("cand_additions").alias("additions"), F.col("cand_deletions").alias("deletions"),
            F.col("cand_changed_files").alias("changed_files"),
        ).alias("candidate"),
        F.struct(
            "html_url", "title", "body",
            F.when(F.col("login").isNotNull(), user_struct(F.col("login"), F.col("author_type"))).alias("user"),
            "author_association", "merged", "created_at", "updated_at", "closed_at", "merged_at",
            F.struct(F.col("base_sha").alias("sha")).alias("base"),
            F.struct(F.col("head_sha").alias("sha")).alias("head"),
            "merge_commit_sha", "changed_files", "additions", "deletions", "commits",
        ).alias("pr"),
        "full_diff", "linked_issue_number", "linked_issue", "api_errors", "retrieved_at", *extra,
    )
    talk = comments(spark, sf_dir)
    if only_these or kept != ALL:
        issues_needed = rows.select("repo_name", F.col("linked_issue_number").alias("pr_number"))
        talk = talk.join(issues_needed, gate.KEY, "left_semi")
    answers = enrichment.issue_comments(rows, conversation(talk))
    return enrichment.assemble_enriched(
        spine, children(spark, sf_dir, rows if only_these else None, kept), ((answers, "linked_issue_comments"),)
    )


def modeling_rows(spark: SparkSession, sf_dir: str, cap: int = 1000) -> DataFrame:
    """The 22-column modeling table of every request."""
    changed = changed_files(spark, sf_dir)
    rows = (
        judged(spark, sf_dir)
        .join(features.patch_sizes(changed), gate.KEY, "left")
        .join(file_jobs.top_language(changed, file_order()), gate.KEY, "left")
    )
    return features.modeling_base(rows, cap)


TRACE_SQL = r"""
WITH prs AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'org0/mono'
      ELSE 'team' || CAST((o_orderkey // 30) % 10 AS VARCHAR) || '/proj' || CAST(o_orderkey // 30 AS VARCHAR) END
      AS repo_name,
    o_orderkey AS pr_number, o_custkey,
    'https://code.example/pull/' || CAST(o_orderkey AS VARCHAR) AS html_url,
    CASE WHEN o_orderkey % 17 <> 0 THEN 'Change ' || CAST(o_orderkey AS VARCHAR) || ' in ' || o_orderstatus END AS title,
    CASE WHEN o_orderkey % 3 = 2 THEN 'Work on it. Closes #' || CAST(o_orderkey - 1 AS VARCHAR)
      WHEN o_orderkey % 6 = 0 THEN 'resolved  #' || CAST(o_orderkey - 3 AS VARCHAR)
      WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'No link, prefixes #' || CAST(o_orderkey AS VARCHAR) END AS body,
    CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey - 1
      WHEN o_orderkey % 6 = 0 AND o_orderkey >= 3 THEN o_orderkey - 3 END AS stated_issue,
    CASE WHEN o_custkey % 20 = 0 THEN 'Helper' || CAST(o_custkey AS VARCHAR) || '[BOT]'
      WHEN o_custkey % 20 = 1 THEN 'Renovate-' || CAST(o_custkey AS VARCHAR)
      WHEN o_custkey % 50 = 7 THEN NULL ELSE 'dev' || CAST(o_custkey AS VARCHAR) END AS login,
    CASE WHEN o_custkey % 20 = 0 THEN 'Bot' WHEN o_custkey % 50 = 8 THEN NULL ELSE 'User' END AS author_type,
    CASE WHEN o_orderkey % 23 <> 0 THEN o_orderpriority END AS author_association,
    o_orderstatus <> 'P' AS merged,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    strftime(o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS closed_at,
    CASE WHEN o_orderstatus <> 'P'
      THEN strftime(o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') END AS merged_at,
    CASE WHEN o_orderkey % 4 <> 0 THEN 1 + o_orderkey % 33 END AS changed_files,
    CAST(floor(o_totalprice / 220) AS BIGINT) AS additions,
    CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey % 50 END AS deletions,
    o_orderkey % 9 AS commits,
    CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 31 = 0 THEN NULL
      ELSE 'diff --git ' || CAST(o_orderkey AS VARCHAR) || chr(10) || '+' || o_orderpriority END AS full_diff,
    CASE WHEN o_orderkey % 2 = 0 THEN '2026-05-01T00:00:00Z' ELSE '2026-05-02T12:30:00Z' END AS retrieved_at,
    o_orderkey % 100 AS cand_additions, o_orderkey % 10 AS cand_deletions,
    o_orderkey % 31 = 0 AS bad_diff, o_orderkey % 37 = 0 AS bad_issue,
    o_custkey % 40 = 3 AS bad_pr, o_custkey % 60 = 7 AS bad_files,
    CAST(o_orderkey % 31 = 0 AS BIGINT) + CAST(o_orderkey % 37 = 0 AS BIGINT) AS api_error_count,
    NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS has_activity
  FROM orders),
files0 AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'org0/mono'
      ELSE 'team' || CAST((l_orderkey // 30) % 10 AS VARCHAR) || '/proj' || CAST(l_orderkey // 30 AS VARCHAR) END
      AS repo_name,
    l_orderkey AS pr_number, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    CASE WHEN l_suppkey % 50 <> 49 THEN
      CASE l_suppkey % 5 WHEN 0 THEN 'src/' WHEN 1 THEN 'lib/' WHEN 2 THEN 'Docs/' WHEN 3 THEN 'vendor/'
        ELSE 'tests/v1.2/' END ||
      CASE WHEN l_partkey % 60 = 8 THEN '.gitignore' WHEN l_partkey % 12 = 7 THEN 'yarn.lock'
        ELSE 'p' || CAST(l_partkey AS VARCHAR) ||
          CASE l_partkey % 12 WHEN 0 THEN CASE WHEN l_partkey % 24 = 0 THEN '.py' ELSE '.PY' END
            WHEN 1 THEN '.js' WHEN 2 THEN '.ts' WHEN 3 THEN '.go' WHEN 4 THEN '.java' WHEN 5 THEN '.rs'
            WHEN 6 THEN '.md' WHEN 8 THEN '.json' WHEN 9 THEN '.h' WHEN 10 THEN '.cpp' ELSE '.txt' END END
      END AS filename,
    CAST(l_quantity AS BIGINT) AS additions, CAST(l_linenumber AS BIGINT) AS deletions,
    CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linenumber = 7 THEN ''
      ELSE '@@ -' || CAST(l_linenumber AS VARCHAR) || ' +' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
        || ' @@' || chr(10) || '+value ' || l_linestatus END AS patch
  FROM lineitem),
files1 AS (
  SELECT *, lower(regexp_extract(regexp_extract(filename, '[^/]*$'), '(?s)^\.*[^.].*(\.[^.]*)$', 1)) AS ext
  FROM files0),
files AS (
  SELECT *, lower(filename) AS low,
    coalesce(ext IN ('.md', '.rst', '.txt', '.adoc') OR regexp_matches(lower(filename),
      'docs/|doc/|documentation/|changelog|changeset'), false) AS is_doc,
    coalesce(regexp_extract(filename, '[^/]*$') IN ('package-lock.json', 'yarn.lock', 'pnpm-lock.yaml', 'poetry.lock',
      'Pipfile.lock', 'Cargo.lock', 'go.sum', 'composer.lock', 'Gemfile.lock'), false) AS is_lock,
    coalesce(regexp_matches(lower(filename), 'vendor/|dist/|build/|generated/|gen/|__generated__/|autogen/|migrations/'
      || '|node_modules/|third_party/|\.pb\.|\.generated\.'), false) AS is_generated,
    CASE WHEN ext = '.py' THEN 'python' WHEN ext IN ('.js', '.jsx') THEN 'javascript'
      WHEN ext IN ('.ts', '.tsx') THEN 'typescript' WHEN ext = '.go' THEN 'go' WHEN ext = '.java' THEN 'java'
      WHEN ext = '.rs' THEN 'rust' WHEN ext IN ('.cpp', '.cc', '.hpp') THEN 'c++' WHEN ext IN ('.c', '.h') THEN 'c/c++'
      WHEN ext = '.cs' THEN 'c#' WHEN ext = '.rb' THEN 'ruby' WHEN ext = '.php' THEN 'php'
      WHEN ext = '.swift' THEN 'swift' WHEN ext = '.kt' THEN 'kotlin' WHEN ext = '.scala' THEN 'scala' END AS language
  FROM files1),
ev_n AS (SELECT (max(event_id) + 1) // 3 AS n FROM events),
conv_n AS (SELECT max(conv_id) + 1 AS n FROM conversations),
reviews AS (
  SELECT repo_name, pr_number, event_id, 'rev' || CAST(user_id AS VARCHAR) AS login, props AS body,
    CASE event_type WHEN 'error' THEN CASE WHEN event_id % 5 = 0 THEN 'changes_requested' ELSE 'CHANGES_REQUESTED' END
      WHEN 'click' THEN 'COMMENTED' WHEN 'purchase' THEN 'APPROVED' WHEN 'view' THEN 'DISMISSED' END AS state
  FROM prs JOIN events ON event_id % (SELECT n FROM ev_n) = pr_number % (SELECT n FROM ev_n)
  WHERE has_activity),
rcs0 AS (
  SELECT repo_name, pr_number, turn, 'src/p' || CAST(turn AS VARCHAR) || '.py' AS path,
    CASE WHEN (turn + pr_number) % 9 = 2 THEN NULL
      WHEN (turn + pr_number) % 4 = 1 THEN repeat(' ', 40) || 'LGTM' || chr(10) ELSE text END AS body
  FROM prs JOIN conversations ON conv_id = pr_number % (SELECT n FROM conv_n)
  WHERE role = 'assistant' AND has_activity),
rcs AS (
  SELECT *, coalesce(length(regexp_replace(body, '^\s+|\s+$', '', 'g')) >= 30
    AND lower(regexp_replace(body, '^\s+|\s+$', '', 'g')) NOT IN ('lgtm', 'looks good', 'thanks', 'thank you', '+1',
      'approved', 'nice', 'nit', 'ok', 'okay', 'done'), false) AS meaningful
  FROM rcs0),
pcs AS (
  SELECT repo_name, pr_number, turn, CASE WHEN (turn + pr_number) % 8 <> 3 THEN text END AS body
  FROM prs JOIN conversations ON conv_id = pr_number % (SELECT n FROM conv_n)
  WHERE role = 'user'),
issues AS (
  SELECT repo_name, pr_number AS number, o_custkey % 5 = 0 AS is_pr,
    'https://code.example/issues/' || CAST(pr_number AS VARCHAR) AS issue_url,
    'Issue ' || CAST(pr_number AS VARCHAR) AS issue_title,
    'Problem: ' || o_orderpriority AS issue_body, 'rep' || CAST(o_custkey AS VARCHAR) AS issue_login
  FROM prs JOIN (SELECT o_orderkey, o_orderpriority FROM orders) ON o_orderkey = pr_number),
linked AS (
  SELECT prs.*, number AS linked_issue_number, issue_url, issue_title, issue_body, issue_login
  FROM prs LEFT JOIN (SELECT * FROM issues WHERE NOT is_pr) i
    ON i.repo_name = prs.repo_name AND i.number = prs.stated_issue),
fc AS (
  SELECT repo_name, pr_number, count(*) AS file_count,
    count(*) FILTER (WHERE filename <> '') AS named_count,
    count(*) FILTER (WHERE is_doc) AS doc_count, count(*) FILTER (WHERE is_lock) AS lock_count,
    count(*) FILTER (WHERE is_generated) AS generated_count,
    count(*) FILTER (WHERE language IS NOT NULL) AS source_file_count,
    count(*) FILTER (WHERE language IS NOT NULL AND patch <> '') AS source_patch_count
  FROM files GROUP BY ALL),
rc AS (
  SELECT repo_name, pr_number, count(*) AS review_count,
    count(*) FILTER (WHERE state = 'CHANGES_REQUESTED') AS changes_requested_exact,
    count(*) FILTER (WHERE state = 'COMMENTED') AS commented_exact,
    count(*) FILTER (WHERE upper(state) = 'APPROVED') AS approved_count,
    count(*) FILTER (WHERE upper(state) = 'COMMENTED') AS commented_count,
    count(*) FILTER (WHERE upper(state) = 'CHANGES_REQUESTED') AS changes_requested_count
  FROM reviews GROUP BY ALL),
cc AS (
  SELECT repo_name, pr_number, count(*) AS review_comment_count, count(*) FILTER (WHERE meaningful) AS meaningful_count
  FROM rcs GROUP BY ALL),
dc AS (SELECT repo_name, pr_number, count(*) AS discussion_count FROM pcs GROUP BY ALL),
good AS (SELECT * FROM prs WHERE NOT bad_pr AND NOT bad_files),
facts AS (
  SELECT prs.*,
    coalesce(file_count, 0) AS file_count, coalesce(named_count, 0) AS named_count,
    coalesce(doc_count, 0) AS doc_count, coalesce(lock_count, 0) AS lock_count,
    coalesce(generated_count, 0) AS generated_count, coalesce(source_file_count, 0) AS source_file_count,
    coalesce(source_patch_count, 0) AS source_patch_count, coalesce(review_count, 0) AS review_count,
    coalesce(changes_requested_exact, 0) AS changes_requested_exact, coalesce(commented_exact, 0) AS commented_exact,
    coalesce(approved_count, 0) AS approved_count, coalesce(commented_count, 0) AS commented_count,
    coalesce(changes_requested_count, 0) AS changes_requested_count,
    coalesce(review_comment_count, 0) AS review_comment_count, coalesce(meaningful_count, 0) AS meaningful_count,
    coalesce(discussion_count, 0) AS discussion_count,
    coalesce(additions, 0) + coalesce(deletions, 0) AS diff_lines,
    coalesce(prs.changed_files, file_count, 0) AS n_changed,
    coalesce(lower(login) LIKE '%[bot]' OR lower(login) LIKE '%renovate%', false) AS is_bot
  FROM good AS prs LEFT JOIN fc USING (repo_name, pr_number) LEFT JOIN rc USING (repo_name, pr_number)
    LEFT JOIN cc USING (repo_name, pr_number) LEFT JOIN dc USING (repo_name, pr_number)),
reasoned AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT merged THEN 'not_merged' END,
    CASE WHEN is_bot THEN 'bot_author' END,
    CASE WHEN n_changed < 2 OR n_changed > 30 THEN 'bad_changed_files_count' END,
    CASE WHEN diff_lines < 50 OR diff_lines > 2000 THEN 'bad_diff_size' END,
    CASE WHEN named_count = 0 THEN 'no_files' END,
    CASE WHEN named_count > 0 AND doc_count = named_count THEN 'docs_only' END,
    CASE WHEN named_count > 0 AND lock_count = named_count THEN 'lockfile_only' END,
    CASE WHEN named_count > 0 AND generated_count = named_count THEN 'generated_or_vendor_only' END,
    CASE WHEN source_file_count = 0 THEN 'no_source_files' END,
    CASE WHEN source_patch_count = 0 THEN 'no_source_patches' END,
    CASE WHEN review_comment_count < 2 THEN 'not_enough_review_comments' END,
    CASE WHEN meaningful_count < 2 THEN 'not_enough_meaningful_review_comments' END,
    CASE WHEN discussion_count < 2 THEN 'not_enough_discussion' END,
    CASE WHEN coalesce(full_diff, '') = '' THEN 'missing_full_diff' END) AS reasons
  FROM facts),
scored AS (
  SELECT *,
    CAST(CASE WHEN merged THEN 20 ELSE 0 END + CASE WHEN meaningful_count >= 2 THEN 20 ELSE 0 END
    + CASE WHEN discussion_count >= 2 THEN 10 ELSE 0 END + CASE WHEN source_file_count > 0 THEN 10 ELSE 0 END
    + CASE WHEN source_patch_count > 0 THEN 10 ELSE 0 END
    + CASE WHEN diff_lines BETWEEN 50 AND 2000 THEN 10 ELSE 0 END
    + CASE WHEN changes_requested_exact > 0 THEN 10 WHEN commented_exact > 0 THEN 5 ELSE 0 END
    - CASE WHEN is_bot THEN 20 ELSE 0 END
    - CASE WHEN named_count > 0 AND doc_count = named_count THEN 20 ELSE 0 END
    - CASE WHEN named_count > 0 AND lock_count = named_count THEN 20 ELSE 0 END
    - CASE WHEN named_count > 0 AND generated_count = named_count THEN 20 ELSE 0 END AS BIGINT) AS score
  FROM reasoned),
judged AS (
  SELECT *, reasons = '' AND score >= 70 AS accepted,
    replace(repo_name, '/', '__') || '__pull_' || CAST(pr_number AS VARCHAR) AS example_id,
    CASE WHEN review_count = 0 AND review_comment_count = 0 THEN NULL
      ELSE CAST(changes_requested_count > 0 OR meaningful_count >= 2 AS BIGINT) END AS review_concern
  FROM scored),
langs AS (
  SELECT repo_name, pr_number, language, count(*) AS n,
    min((l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS pos
  FROM files WHERE language IS NOT NULL GROUP BY ALL),
toplang AS (
  SELECT repo_name, pr_number, language AS top_language FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_name, pr_number ORDER BY n DESC, pos) AS rn FROM langs)
  WHERE rn = 1),
blocks AS (
  SELECT *, 'diff -- ' || filename || chr(10) || patch AS block FROM files
  WHERE language IS NOT NULL AND patch <> ''),
sizes AS (
  SELECT repo_name, pr_number, string_agg(block, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice) AS patch_text
  FROM blocks GROUP BY ALL),
mrows AS (
  SELECT example_id, repo_name AS repo, pr_number, review_concern, CAST(accepted AS BIGINT) AS accepted_quality,
    n_changed AS changed_files, coalesce(additions, 0) AS additions, coalesce(deletions, 0) AS deletions, diff_lines,
    commits, coalesce(length(title), 0) AS pr_title_length, coalesce(length(body), 0) AS pr_body_length,
    CAST(coalesce(body, '') <> '' AS BIGINT) AS has_pr_body, source_file_count, source_patch_count,
    CASE WHEN n_changed <> 0 THEN source_file_count::DOUBLE / n_changed ELSE 0 END AS source_file_ratio,
    coalesce(length(patch_text), 0) AS source_patch_char_count,
    coalesce(len(regexp_extract_all(patch_text, '\w+')), 0) AS source_patch_token_count_raw,
    coalesce(top_language, 'unknown') AS top_language,
    upper(coalesce(author_association, 'UNKNOWN')) AS author_association
  FROM judged LEFT JOIN sizes USING (repo_name, pr_number) LEFT JOIN toplang USING (repo_name, pr_number))
"""


# --- labelled frame ---------------------------------------------------------

def labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label: repo, label, text, tabular columns."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        F.expr("concat('doc', doc_id)").alias("example_id"),
        F.col("source").alias("repo"),
        F.col("doc_id").alias("pr_number"),
        F.col("quality").cast("long").alias("review_concern"),
        F.col("toxic").cast("long").alias("accepted_quality"),
        F.col("lang").alias("top_language"),
        F.col("n_chars").alias("diff_lines"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("changed_files"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("long")
        .alias("source_patch_token_count_capped"),
        "text",
    )


def scored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled frame with deterministic scores of three stand-in models, long form."""
    frame = labelled_frame(spark, sf_dir).drop("text")
    top = table(spark, sf_dir, "documents").agg(F.max("n_chars").alias("m")).scalar()
    share = (F.col("diff_lines") / top).cast("float")
    models = F.array(
        F.struct(F.lit("length").alias("model"), share.alias("score")),
        F.struct(
            F.lit("digest").alias("model"),
            (F.conv(F.substring(F.md5("example_id"), 1, 4), 16, 10).cast("long") / 65536.0).cast("float").alias("score"),
        ),
        F.struct(F.lit("constant").alias("model"), F.lit(1.0).cast("float").alias("score")),
    )
    return (
        frame.withColumn("y", F.col("review_concern"))
        .withColumn("m", F.explode(models))
        .select("*", "m.model", "m.score")
        .drop("m")
    )


FRAME_SQL = """
WITH frame AS (
  SELECT 'doc' || CAST(doc_id AS VARCHAR) AS example_id, source AS repo, doc_id AS pr_number,
    CAST(quality AS BIGINT) AS review_concern, CAST(toxic AS BIGINT) AS accepted_quality, lang AS top_language,
    n_chars AS diff_lines, length(text) - length(replace(text, chr(10), '')) AS changed_files,
    length(text) - length(replace(text, ' ', '')) AS source_patch_token_count_capped, text
  FROM documents JOIN labels USING (doc_id)),
ms AS (
  SELECT *, 'length' AS model, CAST(diff_lines / (SELECT max(n_chars) FROM documents) AS FLOAT) AS score FROM frame
  UNION ALL
  SELECT *, 'digest' AS model,
    CAST(CAST('0x' || substr(md5(example_id), 1, 4) AS BIGINT) / 65536.0 AS FLOAT) AS score FROM frame
  UNION ALL
  SELECT *, 'constant' AS model, CAST(1.0 AS FLOAT) AS score FROM frame),
sc AS (SELECT *, review_concern AS y, CAST(score AS DOUBLE) AS s FROM ms)
"""
