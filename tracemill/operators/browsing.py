"""Scored rows laid out for looking at the first of them.

Rows are written twice, in ranges of the probability and in ranges of the
repository, one file a range, with a few facts per file: which labels, verdicts
and languages it has, and which trigrams occur in its repositories and ids. A
page is looked up by reading files in their order, only those whose facts allow
a match, until the page is full. All later files hold rows that come after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators.modeling import browse_scored

TRIGRAM_BUCKETS = 4096
LAYOUTS = ("by_probability", "by_repository")


def _order(layout: str) -> list[Column]:
    tie = [F.asc("repo"), F.asc("pr_number")]
    return [F.desc("pred_probability"), *tie] if layout == "by_probability" else tie


def _trigrams(text: Column) -> Column:
    """Buckets of the trigrams of a lower-cased text."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3)))
    found = F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(TRIGRAM_BUCKETS)).cast("int"))
    return F.when(F.length(text) >= 3, F.array_distinct(found)).otherwise(F.array().cast("array<int>"))


def sink_scores(scored: DataFrame, path: str, files: int) -> None:
    """Write both layouts and the facts of their files. Extra columns are kept."""
    spark = scored.sparkSession
    for layout in LAYOUTS:
        dealt = scored.repartitionByRange(files, *_order(layout)).withColumn("file", F.spark_partition_id())
        dealt.sortWithinPartitions(*_order(layout)).write.partitionBy("file").parquet(f"{path}/{layout}/rows")
        rows = spark.read.schema(dealt.schema).parquet(f"{path}/{layout}/rows")
        rows.groupBy("file", "review_concern", "accepted_quality", "top_language").count().write.parquet(f"{path}/{layout}/facts")
        text = lambda c: _trigrams(F.lower(F.coalesce(c, F.lit(""))))
        rows.select("file", F.explode(F.array_union(text("repo"), text("example_id"))).alias("bucket")).distinct().write.parquet(
            f"{path}/{layout}/trigrams")


@dataclass
class Page:
    rows: DataFrame
    files_read: int
    files: int


def _possible(spark: SparkSession, place: str, label: str, quality: str, language: str, search: str) -> list[int]:
    """Files that can hold a match, in their order. One short row per file comes to the driver."""
    facts = spark.read.parquet(f"{place}/facts")
    if label in ("concern", "no concern"):
        facts = facts.filter(F.col("review_concern") == (1 if label == "concern" else 0))
    if quality in ("accepted", "rejected"):
        facts = facts.filter(F.col("accepted_quality") == (1 if quality == "accepted" else 0))
    if language != "all":
        facts = facts.filter(F.col("top_language") == language)
    found = facts.select("file").distinct()
    text = search.strip().lower()
    if len(text) >= 3:
        wanted = spark.range(1).select(_trigrams(F.lit(text)).alias("b")).first()["b"]
        has = spark.read.parquet(f"{place}/trigrams").filter(F.col("bucket").isin(wanted)).groupBy("file").count()
        found = found.join(has.filter(F.col("count") == len(wanted)).select("file"), "file")
    return sorted(r["file"] for r in found.collect())


def browse_saved(spark: SparkSession, path: str, label: str = "all", quality: str = "all", language: str = "all",
                 search: str = "", sort: str = "highest probability", limit: int = 100) -> Page:
    """The page that ``browse_scored`` gives on all rows, from few files."""
    layout = "by_repository" if sort == "repository" else "by_probability"
    place = f"{path}/{layout}"
    everything = spark.read.parquet(f"{place}/rows")
    chosen = _possible(spark, place, label, quality, language, search)
    if sort == "lowest probability":
        chosen = chosen[::-1]
    filters = {"label": label, "quality": quality, "language": language, "search": search, "sort": sort, "limit": limit}
    read = 0
    while read < len(chosen):
        read = min(len(chosen), max(1, 2 * read))
        page = browse_scored(everything.filter(F.col("file").isin(chosen[:read])), **filters)
        if page.count() >= limit:
            break
    return Page(browse_scored(everything.filter(F.col("file").isin(chosen[:read])), **filters), read, everything.select("file").distinct().count())
