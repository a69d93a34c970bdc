"""Summaries of landed batches that add up: quantiles and distinct counts without old rows.

A batch leaves one row per measure: the counts of its values by bucket
(``ranking.number_bucket``, ``STEPS`` steps per power of two) and exact count,
sum, least and most. Counts add up, so a quantile of any set of batches has the
right rank and a value that is off by less than 1/STEPS of itself. Distinct
counts are HLL sketches (12 bits: about 1.6 % standard error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, MapType

from tracemill.operators.ranking import number_bucket
from tracemill.schemas import LONG, TEXT, struct

STEPS = 64
HLL_BITS = 12
SKETCH = struct(
    batch=TEXT, measure=TEXT, n=LONG, total=DoubleType(), least=DoubleType(), most=DoubleType(), buckets=MapType(LONG, LONG),
    distinct=BinaryType())


def batch_sketches(rows: DataFrame, batch: Column, numbers: dict[str, Column], distinct: dict[str, Column]) -> DataFrame:
    """One row for each batch and measure. Nulls don't count."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), e.cast("double").alias("v")) for m, e in numbers.items())))
    long = rows.select(batch.cast("string").alias("batch"), values.alias("x")).select("batch", "x.*").filter("v is not null")
    counted = long.groupBy("batch", "measure", number_bucket(F.col("v"), STEPS).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most"))
    # The bucket scheme bounds the rows of a measure.
    summed = counted.groupBy("batch", "measure").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("buckets")).withColumn("distinct", F.lit(None).cast("binary"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    for measure, value in distinct.items():
        summed = summed.unionByName(rows.groupBy(batch.cast("string").alias("batch")).agg(
            F.count(value).alias("n"), F.hll_sketch_agg(value, HLL_BITS).alias("distinct")).select(
            "batch", F.lit(measure).alias("measure"), "n", none("double", "total"), none("double", "least"), none("double", "most"),
            none("map<bigint,bigint>", "buckets"), "distinct"))
    return summed


def merged_counts(sketches: DataFrame) -> DataFrame:
    """``(measure, bucket, n)`` over all batches."""
    return sketches.filter("buckets is not null").select("measure", F.explode("buckets").alias("bucket", "n")).groupBy(
        "measure", "bucket").agg(F.sum("n").alias("n"))


def bucket_floor(bucket: Column) -> Column:
    """The value at which a bucket begins (of a negative one: at which it ends, next to zero)."""
    code = F.abs(bucket) - 1
    size = F.pow(F.lit(2.0), F.floor(code / STEPS) - 1100) * (1 + F.pmod(code, F.lit(STEPS)) / STEPS)
    return F.when(bucket == 0, 0.0).when(bucket < 0, -size).otherwise(size)


def merged_quantiles(sketches: DataFrame, steps: int = 20) -> DataFrame:
    """``(measure, step, quantile)``: of the rank ``ceil(n * step / steps)``, at least the first."""
    upto = Window.partitionBy("measure").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    laddered = merged_counts(sketches).withColumns({
        "upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("measure"))})
    step = F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step")
    wanted = laddered.select("measure", "bucket", "n", "upto", "all", step)
    rank = F.greatest(F.ceil(F.col("all") * F.col("step") / steps), F.lit(1))
    return wanted.filter((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)).select(
        "measure", F.col("step").cast("long").alias("step"), bucket_floor(F.col("bucket")).alias("quantile"))


def merged_totals(sketches: DataFrame) -> DataFrame:
    """Exact count, sum, mean, least and most of each measure, and estimated distinct values."""
    return sketches.groupBy("measure").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), (F.sum("total") / F.sum("n")).alias("mean"),
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"))

