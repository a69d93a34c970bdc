"""Quality gate: counts per request -> ordered reject reasons, score, verdict.

The gate works on a flat table of facts. Facts come either from child tables
(``child_counts``: one aggregate, no arrays) or from a nested row
(``nested_facts``); both give the same columns.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions import paths
from tracemill.functions.text import is_bot_login, is_meaningful_comment, nonempty
from tracemill.settings import GateRules

KEY = ["repo_name", "pr_number"]

# Verdict names, review states and penalty reasons.
ACCEPTED_TIER = "mvp_silver"
REJECTED_TIER = "rejected"
CHANGES_REQUESTED = "CHANGES_REQUESTED"
COMMENTED = "COMMENTED"
APPROVED = "APPROVED"
PENALTY_REASONS = ["bot_author", "docs_only", "lockfile_only", "generated_or_vendor_only"]

FACT_COLUMNS = [
    "file_count", "named_count", "doc_count", "lock_count", "generated_count", "source_file_count",
    "source_patch_count", "review_count", "changes_requested_exact", "commented_exact", "approved_count",
    "commented_count", "changes_requested_count", "review_comment_count", "meaningful_count", "discussion_count",
]


def _file_flags(path: Column, ext: Column, low: Column, patch: Column) -> dict[str, Column]:
    named = nonempty(path)
    source = named & F.coalesce(ext.isin(paths.SOURCE_EXTENSIONS), F.lit(False))
    return {
        "file_count": F.lit(True),
        "named_count": named,
        "doc_count": named & F.coalesce(paths.is_doc(ext, low), F.lit(False)),
        "lock_count": named & F.coalesce(paths.is_lockfile(path), F.lit(False)),
        "generated_count": named & F.coalesce(paths.is_generated(low), F.lit(False)),
        "source_file_count": source,
        "source_patch_count": source & nonempty(patch),
    }


def _review_flags(state: Column) -> dict[str, Column]:
    upper = F.upper(state)
    is_state = lambda s, v: F.coalesce(s == v, F.lit(False))
    return {
        "review_count": F.lit(True),
        "changes_requested_exact": is_state(state, CHANGES_REQUESTED),
        "commented_exact": is_state(state, COMMENTED),
        "approved_count": is_state(upper, APPROVED),
        "commented_count": is_state(upper, COMMENTED),
        "changes_requested_count": is_state(upper, CHANGES_REQUESTED),
    }


def _comment_flags(body: Column) -> dict[str, Column]:
    return {"review_comment_count": F.lit(True), "meaningful_count": is_meaningful_comment(body)}


def _flag_rows(child: DataFrame, flags: dict[str, Column], order: list[str]) -> DataFrame:
    """Child rows as the request key and one number, a bit for each flag that holds."""
    return child.select(*KEY, reduce(
        lambda a, b: a.bitwiseOR(b), [F.when(e, 1 << order.index(c)).otherwise(0).cast("long") for c, e in flags.items()]).alias("__flags"))


def language_facts() -> dict[str, str]:
    """Language -> fact column with its source files."""
    return {name: f"{name}_files" for name in paths.LANGUAGE_NAMES}


def child_counts(files: DataFrame, reviews: DataFrame, review_comments: DataFrame, comments: DataFrame,
                 parts: int | None = None, languages: bool = False) -> DataFrame:
    """All facts of a request in one aggregate over the union of its child tables.

    Child rows move as flags of a few bytes. With ``parts``, they are dealt to as
    many partitions by request and counted there; ``languages`` adds ``language_facts``.
    """
    dealt = (lambda rows: rows.repartition(parts, *KEY)) if parts else (lambda rows: rows)
    path, ext = F.col("filename"), F.col("ext")
    named = files.select(*KEY, "filename", "patch", paths.file_ext(path).alias("ext"), F.lower(path).alias("low"))
    file_flags = _file_flags(path, ext, F.col("low"), F.col("patch"))
    if languages:
        named = named.withColumn("language", paths.language_of_ext(ext))
        file_flags |= {c: F.col("language") == name for name, c in language_facts().items()}
    order = [*FACT_COLUMNS, *(language_facts().values() if languages else ())]
    children = [
        (named, file_flags), (reviews, _review_flags(F.col("state"))), (review_comments, _comment_flags(F.col("body"))),
        (comments, {"discussion_count": F.lit(True)}),
    ]
    rows = dealt(reduce(DataFrame.unionByName, [_flag_rows(child, flags, order) for child, flags in children]))
    return rows.groupBy(*KEY).agg(
        *[F.sum(F.shiftright("__flags", i).bitwiseAND(F.lit(1).cast("long"))).alias(c) for i, c in enumerate(order)])


def attach_counts(prs: DataFrame, counts: DataFrame) -> DataFrame:
    """Requests without any child get zeros."""
    joined = prs.join(counts, KEY, "left")
    return joined.select(*prs.columns, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts.columns if c not in KEY])


def nested_facts(enriched: DataFrame) -> DataFrame:
    """The same facts from the arrays of a nested row, plus the flat gate inputs."""
    groups = {
        "__files": lambda x: _file_flags(x["filename"], x["ext"], x["low"], x["patch"]),
        "reviews": lambda x: _review_flags(x["state"]),
        "review_comments": lambda x: _comment_flags(x["body"]),
        "pr_comments": lambda x: {"discussion_count": F.lit(True)},
    }

    def count(array: str, name: str) -> Column:
        matching = F.filter(F.coalesce(F.col(array), F.array()), lambda x: groups[array](x)[name])
        return F.size(matching).cast("long").alias(name)

    names = {
        "__files": FACT_COLUMNS[0:7], "reviews": FACT_COLUMNS[7:13],
        "review_comments": FACT_COLUMNS[13:15], "pr_comments": FACT_COLUMNS[15:16],
    }
    columns = [count(array, name) for array, wanted in names.items() for name in wanted]
    # Extensions are cut out once per file, ahead of the counters that look them up.
    with_ext = enriched.withColumn("__files", F.transform("files", lambda x: F.struct(
        x["filename"].alias("filename"), paths.file_ext(x["filename"]).alias("ext"),
        F.lower(x["filename"]).alias("low"),
        F.substring(x["patch"], 1, 1).alias("patch"),
    )))
    return with_ext.select("*", *columns, *gate_inputs("pr.")).drop("__files")


def gate_inputs(prefix: str = "") -> list[Column]:
    return [
        F.col(prefix + "merged").alias("merged"),
        F.col(prefix + ("user.login" if prefix else "login")).alias("login"),
        F.col(prefix + "changed_files").alias("changed_files"),
        F.col(prefix + "additions").alias("additions"),
        F.col(prefix + "deletions").alias("deletions"),
    ]


def size_of_change() -> Column:
    zero = F.lit(0).cast("long")
    return F.coalesce("additions", zero) + F.coalesce("deletions", zero)


def files_changed() -> Column:
    """Stated number of files, else the number of files listed; zero counts as unstated."""
    return F.coalesce(F.nullif("changed_files", F.lit(0)), F.col("file_count"))


def all_files_are(kind_count: str) -> Column:
    """Every named file is of the kind, and there is at least one."""
    return (F.col("named_count") > 0) & (F.col(kind_count) == F.col("named_count"))


def meaningful_used(rules: GateRules) -> Column:
    return F.col("meaningful_count" if rules.exclude_trivial_review_comments else "review_comment_count")


def _lines_in_range(rules: GateRules) -> Column:
    return size_of_change().between(rules.min_diff_lines, rules.max_diff_lines)


def reject_conditions(rules: GateRules = GateRules()) -> dict[str, Column]:
    """Reason -> condition, in reporting order. A disabled reason folds to false."""
    merged = F.coalesce("merged", F.lit(False))
    on = F.lit
    return {
        "not_merged": ~merged,
        "bot_author": on(rules.exclude_bots) & is_bot_login(F.col("login")),
        "bad_changed_files_count": ~files_changed().between(rules.min_changed_files, rules.max_changed_files),
        "bad_diff_size": ~_lines_in_range(rules),
        "no_files": F.col("named_count") == 0,
        "docs_only": on(rules.exclude_docs_only) & all_files_are("doc_count"),
        "lockfile_only": on(rules.exclude_lockfile_only) & all_files_are("lock_count"),
        "generated_or_vendor_only": on(rules.exclude_generated_vendor_only) & all_files_are("generated_count"),
        "no_source_files": F.col("source_file_count") == 0,
        "no_source_patches": on(rules.require_source_patch) & (F.col("source_patch_count") == 0),
        "not_enough_review_comments": F.col("review_comment_count") < rules.min_review_comments,
        "not_enough_meaningful_review_comments": meaningful_used(rules) < rules.min_meaningful_review_comments,
        "not_enough_discussion": F.col("discussion_count") < rules.min_discussion_comments,
        "missing_full_diff": on(rules.store_full_diff) & ~nonempty(F.col("full_diff")),
    }


def _with_reasons(facts: DataFrame, rules: GateRules) -> DataFrame:
    """One boolean column per reason; reasons, score and verdict all read these."""
    return facts.withColumns({f"__{r}": c for r, c in reject_conditions(rules).items()})


def _reason_array(rules: GateRules) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f"__{r}"), F.lit(r)) for r in reject_conditions(rules)]))


def _drop_reasons(rows: DataFrame, rules: GateRules) -> DataFrame:
    return rows.drop(*[f"__{r}" for r in reject_conditions(rules)])


def reject_reasons(facts: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Add ``reject_reasons``, an array in reporting order."""
    rows = _with_reasons(facts, rules).withColumn("reject_reasons", _reason_array(rules))
    return _drop_reasons(rows, rules)


def quality_score(rules: GateRules = GateRules()) -> Column:
    """Points for what is present, minus penalties for four of the reasons."""
    points = [
        (F.coalesce("merged", F.lit(False)), 20),
        (meaningful_used(rules) >= rules.min_meaningful_review_comments, 20),
        (F.col("discussion_count") >= rules.min_discussion_comments, 10),
        (F.col("source_file_count") > 0, 10),
        (F.col("source_patch_count") > 0, 10),
        (_lines_in_range(rules), 10),
    ]
    score = F.when(F.col("changes_requested_exact") > 0, 10).when(F.col("commented_exact") > 0, 5).otherwise(0)
    for condition, value in points:
        score = score + F.when(condition, value).otherwise(0)
    for reason in PENALTY_REASONS:
        score = score - F.when(F.col(f"__{reason}"), 20).otherwise(0)
    return score.cast("long")


def quality_gate(facts: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Add the ``quality`` struct."""
    scored = _with_reasons(facts, rules).withColumn("__score", quality_score(rules))
    rejected = reduce(or_, [F.col(f"__{r}") for r in reject_conditions(rules)])
    accepted = ~rejected & (F.col("__score") >= rules.min_score)
    judged = scored.withColumn("__accepted", accepted).withColumn(
        "quality",
        F.struct(
            F.col("__accepted").alias("accepted"),
            F.col("__score").alias("score"),
            F.when(F.col("__accepted"), ACCEPTED_TIER).otherwise(REJECTED_TIER).alias("tier"),
            _reason_array(rules).alias("reject_reasons"),
            "discussion_count",
            "review_comment_count",
            meaningful_used(rules).alias("meaningful_review_comment_count"),
            "source_file_count",
            "source_patch_count",
            size_of_change().alias("diff_lines"),
        ),
    )
    return _drop_reasons(judged, rules).drop("__score", "__accepted")


def review_concern_label(min_meaningful: int = 2, exclude_inactive: bool = True) -> Column:
    """1 when changes were requested or enough comments are meaningful, else 0;
    null without any review activity, unless ``exclude_inactive`` is off."""
    label = (
        (F.col("changes_requested_count") > 0) | (F.col("meaningful_count") >= min_meaningful)
    ).cast("long")
    if not exclude_inactive:
        return label
    return F.when((F.col("review_count") > 0) | (F.col("review_comment_count") > 0), label)


def review_state_counts(reviews: DataFrame, by: tuple[str, ...] = (), missing: str | None = "UNKNOWN") -> DataFrame:
    """Reviews per upper-cased state; states without text are named or left out."""
    state = F.when(nonempty(F.col("state")), F.upper("state"))
    state = F.coalesce(state, F.lit(missing)) if missing else state
    return (
        reviews.select(*by, state.alias("state"))
        .filter(F.col("state").isNotNull())
        .groupBy(*by, "state")
        .agg(F.count(F.lit(1)).alias("n_reviews"))
    )
