"""Readers: gzip NDJSON event dumps, candidate CSV files, JSONL rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tracemill import schemas
from tracemill.functions.text import strip

# Fixed value: hourly dump name, e.g. 2025-01-31-7.json.gz
DUMP_SUFFIX = ".json.gz"


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted file names of a glob on any Hadoop file system (names only, no data)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return sorted(s.getPath().toString() for s in (found or []) if s.isFile())


def path_exists(spark: SparkSession, location: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path)


def scan_event_log(
    spark: SparkSession, pattern: str, limit_files: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Parse event lines; ``is_bad_json`` marks lines that are no JSON object.

    A gzip file is one task, so ``partitions`` spreads the lines before the
    costly part of a job when there are fewer files than cores.
    """
    if limit_files is None:
        lines = spark.read.text(pattern)
    else:
        files = list_files(spark, pattern)[:limit_files]
        if not files:
            return parse_event_lines(spark.createDataFrame([], "value string, file_name string"))
        lines = spark.read.text(files)
    lines = lines.select("value", F.col("_metadata.file_name").alias("file_name"))
    if partitions:
        lines = lines.repartition(partitions)
    return parse_event_lines(lines)


def parse_event_lines(lines: DataFrame) -> DataFrame:
    """``value`` (one line) -> event columns. Blank lines are dropped, bad ones flagged."""
    schema = StructType([*schemas.EVENT_LINE.fields, StructField("_bad", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return (
        lines.filter(strip(F.col("value")) != "")
        .withColumn("event", F.from_json("value", schema, options))
        .select(
            "event.type",
            "event.repo",
            "event.created_at",
            "event.payload",
            F.col("event._bad").isNotNull().alias("is_bad_json"),
            *[c for c in lines.columns if c != "value"],
        )
    )


def expected_dumps(spark: SparkSession, start_date: str, end_date: str) -> DataFrame:
    """One row per hourly dump between two dates, both included."""
    if end_date < start_date:
        raise ValueError("end_date must not be before start_date")
    return dump_calendar(
        spark.range(1).select(
            F.lit(start_date).cast("date").alias("first_day"),
            F.lit(end_date).cast("date").alias("last_day"),
        )
    )


def dump_calendar(bounds: DataFrame) -> DataFrame:
    """``first_day, last_day`` -> every hour of the range and its dump name."""
    # Days and hours as such: every day has 24 dumps, whatever the session's zone.
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    hours = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    return hours.select(
        F.expr("cast(day as timestamp_ntz) + make_dt_interval(0, h)").alias("hour"), _dump(F.col("day"), F.col("h")).alias("file_name"))


def _dump(day: Column, hour: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("-"), hour.cast("string"), F.lit(DUMP_SUFFIX))


def dump_name(hour: Column) -> Column:
    return _dump(hour.cast("date"), F.hour(hour))


def hourly_coverage(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected dumps that have not landed yet."""
    return expected.join(landed.select("file_name").distinct(), "file_name", "left_anti")


def scan_candidates_csv(spark: SparkSession, path, schema: StructType = schemas.CANDIDATE) -> DataFrame:
    """Candidate CSV with header, optional byte-order mark and quoted line breaks."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def scan_candidates_dir(
    spark: SparkSession,
    directory: str,
    pattern: str = "candidate_prs_*.csv",
    schema: StructType = schemas.CANDIDATE,
) -> DataFrame:
    """All matching candidate files of a directory, each row with its file name."""
    if not path_exists(spark, directory):
        raise FileNotFoundError(f"no such candidate directory: {directory}")
    files = list_files(spark, f"{directory.rstrip('/')}/{pattern}")
    if not files:
        raise FileNotFoundError(f"no candidate file matches {pattern!r} in {directory}")
    return scan_candidates_csv(spark, files, schema).withColumn("file_name", F.col("_metadata.file_name"))


def scan_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines; blank lines are skipped and an absent path is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
