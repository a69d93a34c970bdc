"""Leakage-free splits by repository, and the audit sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, UserDefinedType

from tracemill.functions.text import nonempty, or_none, seeded_digest
from tracemill.operators.ranking import digest_rank, take_by_digest
from tracemill.settings import AuditRules, SplitRules
from tracemill.storage import materialize

# Labels a human may give.
AUDIT_LABELS = [
    "accept_good", "reject_trivial", "reject_bad_issue_link", "reject_weak_review", "reject_docs_only",
    "reject_deps_only", "reject_bad_diff", "reject_no_real_problem", "reject_other",
]
REVIEW_PREVIEW_CHARS = 1500
LARGE_REPO = 100_000       # rows
SALTS = 1 << 20


def assign_repos(repos: DataFrame, repo: str, rules: SplitRules = SplitRules()) -> DataFrame:
    """Each distinct repository -> train, val or test, cut by count in digest order."""
    return _repo_sizes(repos, repo, rules).select(repo, "split")


def _repo_sizes(repos: DataFrame, repo: str, rules: SplitRules) -> DataFrame:
    """``repo``, ``split`` and the number of its rows ``__rows``."""
    distinct = repos.filter(nonempty(F.col(repo))).groupBy(repo).agg(F.count(F.lit(1)).alias("__rows"))
    ranked = digest_rank(
        distinct.withColumn("__digest", seeded_digest(rules.seed, F.col(repo))), "__digest", tie=(repo,)
    )
    train = F.floor(F.col("total") * F.lit(float(rules.train_ratio)))
    val = F.floor(F.col("total") * F.lit(float(rules.val_ratio)))
    name = F.when(F.col("rank") <= train, "train").when(F.col("rank") <= train + val, "val").otherwise("test")
    return ranked.select(repo, name.alias("split"), "__rows")


def _joined(rows: DataFrame, sizes: DataFrame, repo: str) -> DataFrame:
    """``rows`` with the ``split`` of their repository, null where it has none.

    The few repositories of ``LARGE_REPO`` rows or more are looked up in a broadcast
    (one entry per ``LARGE_REPO`` rows at most) and their rows are dealt by a hash,
    so that the join by repository has no large key that one task would have to sort.
    """
    # The salt is written too: a literal would be folded away and the join be by repository alone.
    sizes = materialize(sizes.withColumn("__salt", F.lit(0).cast("long")), "repo-splits")
    large = sizes.filter(F.col("__rows") >= LARGE_REPO).select(repo, F.col("split").alias("__large"))
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType, UserDefinedType))]
    salt = F.when(F.col("__large").isNotNull(), F.pmod(F.xxhash64(*plain), F.lit(SALTS)) + 1).otherwise(F.lit(0).cast("long"))
    dealt = rows.join(F.broadcast(large), repo, "left").withColumn("__salt", salt)
    # Salted rows find nothing here: their split is known.
    found = dealt.join(sizes.select(repo, "split", "__salt"), [repo, "__salt"], "left")
    return found.withColumn("split", F.coalesce("__large", "split")).drop("__salt", "__large")


def split_by_repo(rows: DataFrame, repo: str = "repo", rules: SplitRules = SplitRules()) -> DataFrame:
    """Rows follow their repository; rows without one are dropped.

    The repository map is one row each.
    """
    return _joined(rows.drop("split"), _repo_sizes(rows, repo, rules), repo).filter(F.col("split").isNotNull())


def split_labeled(rows: DataFrame, label: str, repo: str = "repo", rules: SplitRules = SplitRules()) -> DataFrame:
    """Split the repositories of labelled rows; rows of other repositories are ``excluded``.

    ``in_matrix`` is true for the labelled rows of a split.
    """
    labelled = rows.filter(F.col(label).isNotNull())
    joined = _joined(rows.drop("split"), _repo_sizes(labelled, repo, rules), repo)
    return joined.withColumn("split", F.coalesce("split", F.lit("excluded"))).withColumn(
        "in_matrix", (F.col("split") != "excluded") & F.col(label).isNotNull()
    )


def split_summary(rows: DataFrame, label: str | None = None, accepted: str | None = None, repo: str = "repo") -> DataFrame:
    """Rows, repositories, classes and accepted rows per split, and for all.

    Sums are taken per (split, repository) first, so the distinct count needs
    no extra pass and no repository lands in one task whole.
    """
    sums: dict[str, Column] = {"n_rows": F.count(F.lit(1))}
    if label:
        sums["label_0"] = F.count_if(F.col(label) == 0)
        sums["label_1"] = F.count_if(F.col(label) == 1)
    if accepted:
        sums["accepted_rows"] = F.sum(F.col(accepted).cast("long"))
    per_repo = rows.groupBy("split", repo).agg(*[e.alias(n) for n, e in sums.items()])
    flat = per_repo.rollup("split").agg(
        F.grouping("split").alias("__all"),
        *[F.sum(n).alias(n) for n in sums],
        F.count_if(F.col(repo).isNotNull()).alias("repos"),
    )
    return flat.select(
        F.when(F.col("__all") == 1, "all").otherwise(F.col("split")).alias("split"), *sums, "repos"
    )


def audit_sample(judged: DataFrame, rules: AuditRules = AuditRules()) -> DataFrame:
    """Seeded samples of accepted, rejected and borderline rows, one row per id.

    ``judged`` needs ``example_id`` and ``quality``. A row drawn for several
    strata keeps the first (accepted, rejected, borderline).
    """
    accepted = F.col("quality.accepted")
    border = F.col("quality.score").between(rules.borderline_low, rules.borderline_high)
    # Stratum numbers in concatenation order.
    strata = F.array_compact(F.array(
        F.when(accepted, F.lit(1)), F.when(~accepted, F.lit(2)), F.when(border, F.lit(3)),
    ))
    keyed = judged.filter(nonempty(F.col("example_id"))).select(
        "example_id", F.explode(strata).alias("stratum")
    ).withColumn("__digest", seeded_digest(rules.seed, F.concat_ws(":", F.col("stratum").cast("string"), "example_id")))
    sizes = [(1, rules.accepted_size), (2, rules.rejected_size), (3, rules.borderline_size)]
    quotas = judged.sparkSession.createDataFrame(sizes, "stratum int, quota int")
    drawn = take_by_digest(keyed, quotas, "__digest", ("stratum",), ("example_id",))
    # At most the sum of the three sizes remains.
    return drawn.groupBy("example_id").agg(F.min("stratum").alias("stratum"))


def audit_rows(traces: DataFrame, sample: DataFrame) -> DataFrame:
    """17 audit columns for the sampled traces, two of them left blank."""
    text = lambda c: F.coalesce(c, F.lit(""))
    files = F.array_join(
        F.transform(
            F.slice(F.col("code_diff.files"), 1, 5),
            lambda x: F.concat(
                or_none(x["filename"]), F.lit(" +"), or_none(x["additions"]), F.lit(" -"), or_none(x["deletions"])
            ),
        ),
        "\n",
    )
    reviews = F.array_join(
        F.transform(F.slice(F.col("review.review_comments"), 1, 3), lambda x: text(x["body"])), "\n\n"
    )
    # The sample is bounded by its three sizes.
    return traces.join(F.broadcast(sample.select("example_id")), "example_id", "left_semi").select(
        "example_id",
        "repo",
        "pr_url",
        "linked_issue_url",
        F.col("issue.title").alias("issue_title"),
        F.col("pr.title").alias("pr_title"),
        F.col("quality.score").alias("score"),
        F.col("quality.accepted").alias("accepted"),
        F.array_join("quality.reject_reasons", ",").alias("reject_reasons"),
        F.col("quality.discussion_count").alias("discussion_count"),
        F.col("quality.meaningful_review_comment_count").alias("meaningful_review_comment_count"),
        F.col("quality.source_patch_count").alias("source_patch_count"),
        files.alias("files_preview"),
        F.substring(reviews, 1, REVIEW_PREVIEW_CHARS).alias("review_preview"),
        F.lit(",".join(AUDIT_LABELS)).alias("valid_labels"),
        F.lit("").alias("human_label"),
        F.lit("").alias("human_notes"),
    )
