"""Resumable landing of hourly dumps: each run takes only files it has not seen.

The stream's checkpoint remembers landed files, so a restarted or repeated run
neither skips nor repeats one. Landed rows are columnar and dated, so later
jobs prune by day and never parse JSON lines again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators import discovery
from tracemill.sources.batches import BatchTable
from tracemill.sources.readers import parse_event_lines

MERGE_AT = 24  # batches of a view that become one


def land_events(spark: SparkSession, input_dir: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Parse all new dumps of a folder into Parquet partitioned by day, then stop."""
    lines = (
        spark.readStream.format("text")
        .schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(input_dir)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )
    events = parse_event_lines(lines).withColumn("day", F.substring("created_at", 1, 10))
    query = (
        events.writeStream.format("parquet")
        .partitionBy("day")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def absorb(events: DataFrame, view: str, order: Column) -> list[str]:
    """Add new dumps (by ``file_name``) to a view of request activity; returns their names.

    Only the given events are read. Dumps may come late, in any order and again:
    a name that the view knows is left out. Each call is one batch, there as a
    whole or not at all; ``MERGE_AT`` batches are merged into one.
    """
    spark = events.sparkSession
    table = BatchTable(spark, view)
    known = table.committed()
    # File names of one call: as many as it was given files.
    new = sorted({r["file_name"] for r in events.select("file_name").distinct().collect()} - known)
    if not new:
        return []
    fresh = events.filter(F.col("file_name").isin(new) & ~F.col("is_bad_json"))
    partials = discovery.candidate_partials(discovery.parse_activity(fresh), order)
    table.commit(f"dumps:{'+'.join(new)}", {"partials": lambda at: partials.write.parquet(at["partials"])}, holds=tuple(new))
    if len(table.batches()) >= MERGE_AT:
        merge(spark, view)
    return new


def merge(spark: SparkSession, view: str) -> None:
    """All batches of a view as one; what it answers stays the same."""
    table = BatchTable(spark, view)
    live = table.batches()
    if len(live) > 1:
        rows = discovery.merge_partials(spark.read.parquet(*table.folders("partials")))
        table.commit(
            f"merged:{'+'.join(live)}", {"partials": lambda at: rows.write.parquet(at["partials"])},
            holds=tuple(table.committed() - set(live)), replaces=tuple(live))


def view_candidates(spark: SparkSession, view: str) -> DataFrame:
    """Candidates from everything a view has absorbed, from its partial rows alone."""
    return discovery.candidates_of_partials(spark.read.parquet(*BatchTable(spark, view).folders("partials")))


def follow_dumps(spark: SparkSession, input_dir: str, view: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Absorb all new dumps of a folder as a stream, then stop. The stream's checkpoint knows the
    files, the view knows the dumps, so a batch that is run again adds nothing."""
    lines = (
        spark.readStream.format("text")
        .schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(input_dir)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )
    query = (
        lines.writeStream.foreachBatch(
            lambda batch, _: absorb(parse_event_lines(batch), view, F.struct("created_at", "file_name")) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
