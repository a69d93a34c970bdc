"""How far the rows of a release have moved from those of the release before.

Every measure is a histogram per release; the histograms of neighbours are
aligned on the union of their buckets. Two distances are given: the population
stability index (each bucket gets half a row more, so an empty one is finite)
and the Jensen-Shannon distance (square root, base 2: 0 for equal, 1 for
disjoint histograms).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.storage import materialize

# Usual limits of the stability index.
MODERATE = 0.1
STRONG = 0.25


def histograms(rows: DataFrame, release: Column, measures: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """``(release, measure, bucket, n)``; null is the bucket ``(none)``. A row counts once, or as often as ``weight`` says."""
    weight = F.lit(1).cast("long") if weight is None else weight
    cells = F.explode(F.array(*(
        F.struct(F.lit(m).alias("measure"), F.coalesce(e.cast("string"), F.lit("(none)")).alias("bucket")) for m, e in measures.items())))
    return rows.select(release.alias("release"), weight.alias("weight"), cells.alias("c")).filter("release is not null").groupBy(
        "release", "c.measure", "c.bucket").agg(F.sum("weight").alias("n"))


def size_bucket(value: Column) -> Column:
    """Sizes by powers of two."""
    return F.floor(F.log2(F.greatest(value, F.lit(0)) + 1)).cast("long")


def distances(*parts: DataFrame) -> DataFrame:
    """``(release, previous, measure, psi, js_distance, alarm)`` for every release but the first.

    The counts are written once, since a release is compared both with the one before and with the one after.
    """
    counts = materialize(reduce(DataFrame.unionByName, parts), "histograms")
    # One row per release.
    order = counts.select("release").distinct().withColumn("previous", F.lag("release").over(Window.orderBy("release")))
    pairs = order.filter("previous is not null")
    now = counts.join(pairs, "release").select("release", "previous", "measure", "bucket", F.col("n").alias("n1"), F.lit(0).cast("long").alias("n0"))
    was = counts.withColumnRenamed("release", "previous").join(pairs, "previous").select(
        "release", "previous", "measure", "bucket", F.lit(0).cast("long").alias("n1"), F.col("n").alias("n0"))
    aligned = now.unionByName(was).groupBy("release", "previous", "measure", "bucket").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    key = ["release", "previous", "measure"]
    sizes = aligned.groupBy(*key).agg(F.sum("n1").alias("all1"), F.sum("n0").alias("all0"), F.count(F.lit(1)).alias("buckets"))
    both = aligned.join(sizes, key)
    share = lambda n, total: F.col(n) / F.col(total)
    smooth = lambda n, total: (F.col(n) + 0.5) / (F.col(total) + 0.5 * F.col("buckets"))
    p, q = share("n1", "all1"), share("n0", "all0")
    part = lambda x: F.when(x > 0, 0.5 * x * F.log2(2 * x / (p + q))).otherwise(0.0)
    a, b = smooth("n1", "all1"), smooth("n0", "all0")
    found = both.filter("all1 > 0 and all0 > 0").groupBy(*key).agg(
        F.sum((a - b) * F.log(a / b)).alias("psi"), F.sqrt(F.greatest(F.sum(part(p) + part(q)), F.lit(0.0))).alias("js_distance"))
    alarm = F.when(F.col("psi") >= STRONG, "strong").when(F.col("psi") >= MODERATE, "moderate").otherwise("none")
    return found.withColumn("alarm", alarm)
