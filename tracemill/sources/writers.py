"""Writers. Each takes a DataFrame and a path; Spark commits the files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill import schemas
from tracemill.schemas import INT, TEXT, struct
from tracemill.sources.batches import BatchTable
from tracemill.storage import shuffle_files_go

KEY_BUCKETS = 256
KEYS = struct(key=TEXT, bucket=INT)


def sink_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Overwrite, append, or (with an empty frame) truncate; nulls are written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def sink_candidates(df: DataFrame, path: str | None = None, table: str | None = None, table_path: str | None = None,
                    buckets: int = 64) -> None:
    """Candidates in (repo, number) order as CSV, or as a table in buckets of (repo, number)."""
    rows = df.select(schemas.CANDIDATE.fieldNames())
    if table:
        sink_bucketed(rows, table, table_path, ["repo_name", "pr_number"], buckets)
    if path:
        sink_csv(rows.orderBy("repo_name", "pr_number"), path)


def sink_bucketed(df: DataFrame, table: str, path: str | None, keys: list[str], buckets: int) -> DataFrame:
    """A table whose rows are dealt to buckets by ``keys``, one sorted file a bucket.

    Tables with the same keys and buckets join and group by them without an
    exchange, however large they are. Returns the table as read back.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
    (writer.option("path", path) if path else writer).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def sink_trace_parquet(path: str, *traces: DataFrame) -> None:
    """Accepted and rejected traces in one pass, one folder each. Of several frames one is written after the other."""
    for k, rows in enumerate(traces):
        with shuffle_files_go(rows.sparkSession):
            rows.withColumn("accepted", F.col("quality.accepted")).sortWithinPartitions("example_id").write.mode(
                "append" if k else "overwrite").partitionBy("accepted").option("compression", "zstd").parquet(path)


def sink_features(features: DataFrame, csv_path: str, parquet_path: str) -> DataFrame:
    """Feature rows per split in both formats; returns the row counts per split.

    Features are computed for the Parquet write only; CSV and counts read that.
    """
    features.write.mode("overwrite").partitionBy("split").parquet(parquet_path)
    saved = features.sparkSession.read.schema(features.schema).parquet(parquet_path)
    sink_csv(saved, csv_path, partition_by=("split",))
    return saved.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def sink_matrix(matrix: DataFrame, path: str, manifest: dict) -> None:
    """Labelled matrix rows by split, with the manifest next to them."""
    matrix.write.mode("overwrite").partitionBy("split").option("compression", "zstd").parquet(f"{path}/rows")
    sink_document(matrix.sparkSession, manifest, f"{path}/manifest")


def sink_document(spark: SparkSession, document: dict, path: str) -> None:
    """A small JSON document as a one-line text file."""
    spark.createDataFrame([(json.dumps(document, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def key_bucket() -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS)).cast("int")


def incremental_append(table: BatchTable, run: str, outcomes: DataFrame, failures: DataFrame) -> bool:
    """Append one run's good and failed rows (each with its ``key``), both or neither.

    Their keys are a third part, by bucket, so that later runs need not read
    whole rows to know what is done. A run that is appended again changes nothing.
    """
    spark = outcomes.sparkSession

    def keys(at: dict[str, str]) -> None:
        both = spark.read.schema(KEYS).json([at["outcomes"], at["failures"]])
        both.select("key").withColumn("bucket", key_bucket()).repartition("bucket").write.partitionBy("bucket").parquet(at["keys"])

    return table.commit(run, {
        "outcomes": lambda at: sink_jsonl(outcomes, at["outcomes"]), "failures": lambda at: sink_jsonl(failures, at["failures"]), "keys": keys})


def not_appended(table: BatchTable, wanted: DataFrame) -> DataFrame:
    """Rows of ``wanted`` whose ``key`` no run has. Only folders of buckets that ``wanted`` has keys in are read."""
    buckets = sorted(r["bucket"] for r in wanted.select(key_bucket().alias("bucket")).distinct().collect())
    done = table.read("keys", KEYS).filter(F.col("bucket").isin(buckets))
    return wanted.join(done.select("key"), "key", "left_anti")
