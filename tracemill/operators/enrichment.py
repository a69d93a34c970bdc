"""Assembly of nested rows from landed child tables, and issue links.

Counting never needs nested rows: see ``gate.child_counts``. Arrays are built
only for outputs that are nested themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import linked_issue_number

KEY = ["repo_name", "pr_number"]


@dataclass(frozen=True)
class Child:
    """A landed child table of requests: ``order`` sorts the rows, ``item`` are their fields."""

    name: str
    rows: DataFrame
    order: list[str]
    item: list[Column]
    keys: list[str] = field(default_factory=lambda: KEY)


def nest(child: Child) -> DataFrame:
    """One ordered array per request. The row it goes to is the output's own unit."""
    entry = F.struct(*child.order, F.struct(*child.item).alias("item"))
    return child.rows.groupBy(*child.keys).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["item"]).alias(child.name))


def assemble_enriched(spine: DataFrame, children: list[Child], ready: tuple[tuple[DataFrame, str], ...] = ()) -> DataFrame:
    """Left-join the child arrays to the spine; absent children are empty arrays.

    One row per request, however long its listings are. ``ready`` holds arrays
    that are already keyed by request. Every side has one row per key, and all
    joins share one partitioning by it, so the spine is exchanged once.
    """
    out = spine
    for side, name in [*((nest(c), c.name) for c in children), *ready]:
        out = out.join(side, KEY, "left").withColumn(name, F.coalesce(F.col(name), F.array()))
    return out


def issue_comments(links: DataFrame, comments: Child) -> DataFrame:
    """Comments of linked issues, keyed by the request that links them.

    ``links``: the request key and ``linked_issue_number``. The join runs on
    narrow links and one array per issue, not on assembled rows; an issue that
    very many requests link is a skewed key on the narrow side only.
    """
    arrays = nest(comments).select(
        "repo_name", F.col("pr_number").alias("linked_issue_number"), F.col(comments.name).alias("linked_issue_comments"))
    wanted = links.filter(F.col("linked_issue_number").isNotNull()).select(*KEY, "linked_issue_number")
    return wanted.join(arrays, ["repo_name", "linked_issue_number"]).select(*KEY, "linked_issue_comments")


def linked_issue_extract(prs: DataFrame) -> DataFrame:
    return prs.withColumn("linked_issue_number", linked_issue_number(F.col("title"), F.col("body")))


def linked_issue_join(prs: DataFrame, issues: DataFrame, issue_columns: list[str], parts: int | None = None) -> DataFrame:
    """Attach the referenced issue of the same repository.

    The number is dropped when the issue is missing or is a request itself.
    ``issues``: repo_name, number, is_pull_request and ``issue_columns``.
    With ``parts``, the result is dealt out to as many partitions by request.
    """
    dealt = (lambda rows: rows.repartition(parts, *KEY)) if parts else (lambda rows: rows)
    wanted = issues.filter(~F.coalesce("is_pull_request", F.lit(False))).select(
        "repo_name",
        F.col("number").alias("__issue"),
        F.struct(*issue_columns).alias("linked_issue"),
    )
    # Only requests that name a number take part, as narrow rows: those without
    # one would all meet under one null key, and wide rows would move with them.
    named = prs.filter(F.col("linked_issue_number").isNotNull()).select(*KEY, "linked_issue_number").distinct()
    hits = named.join(wanted.withColumnRenamed("__issue", "linked_issue_number"), ["repo_name", "linked_issue_number"])
    # By request alone, as every other side of a request: wide rows that are dealt out by it stay where they are.
    by_request = dealt(hits).groupBy(*KEY).agg(F.collect_list(F.struct("linked_issue_number", "linked_issue")).alias("__hits"))
    columns = [c for c in prs.columns if c != "linked_issue_number"]
    number = F.col("linked_issue_number")
    own = F.filter("__hits", lambda h: h["linked_issue_number"] == number)
    joined = dealt(prs).join(by_request, KEY, "left").select(*columns, F.explode_outer(own).alias("__hit"))
    return joined.select(*columns, F.col("__hit")["linked_issue_number"].alias("linked_issue_number"), F.col("__hit")["linked_issue"].alias("linked_issue"))


def failure_split(rows: DataFrame, mandatory: dict[str, str], optional: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows with their ``api_errors``, and failure rows.

    ``mandatory`` and ``optional`` map a part name to a column that holds an
    error struct (error_type, message, status_code), null when the part arrived.
    The first failed mandatory part fails the row; optional ones are kept on it.
    """
    failure = F.coalesce(*[F.col(c) for c in mandatory.values()])
    errors = F.array_compact(F.array(*[
        F.when(
            F.col(c).isNotNull(),
            F.struct(
                F.lit(stage).alias("stage"),
                F.col(c)["error_type"].alias("error_type"),
                F.col(c)["message"].alias("message"),
                F.col(c)["status_code"].alias("status_code"),
            ),
        )
        for stage, c in optional.items()
    ]))
    status = [*mandatory.values(), *optional.values()]
    good = rows.filter(failure.isNull()).withColumn("api_errors", errors).drop(*status)
    bad = rows.filter(failure.isNotNull()).select(
        *KEY,
        "candidate",
        failure["error_type"].alias("error_type"),
        failure["message"].alias("error_message"),
        "retrieved_at",
    )
    return good, bad

