"""Exact global order without a global sort in one task.

Rows are put into ordered buckets, bucket sizes are summed up on a table whose
row count is bounded by the bucket scheme, and ranks are completed inside each
bucket. Two bucket schemes are used:

* hex digests: the leading digits (uniform by construction);
* numbers: sign, binary exponent and 12 leading mantissa bits. A float32 or
  int32 column has at most 2**19 distinct values per bucket, and there are
  fewer than 3 million buckets, whatever the data looks like. Values are
  grouped before they are ranked, so copies never pile up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.storage import materialize

DIGEST_DIGITS = 4
MANTISSA_STEPS = 4096
_ZERO = "__z"


def number_bucket(value: Column, steps: int = MANTISSA_STEPS) -> Column:
    """Order-preserving coarse bucket of a finite number, ``steps`` of them for each power of two."""
    v = value.cast("double")
    size = F.abs(v)
    exponent = F.floor(F.log2(F.when(size > 0, size)))
    step = F.floor((size / F.pow(F.lit(2.0), exponent) - 1.0) * steps)
    code = (exponent + 1100) * steps + F.least(step, F.lit(steps - 1)) + 1
    code = F.coalesce(code.cast("long"), F.lit(0).cast("long"))
    return F.when(v < 0, -code).otherwise(code)


def digest_rank(df: DataFrame, digest: str, rank: str = "rank", total: str = "total", by: tuple[str, ...] = (),
                tie: tuple[str, ...] = (), digits: int = DIGEST_DIGITS) -> DataFrame:
    """1-based rank by a hex digest (within ``by``) and the group size."""
    bucketed = df.withColumn("__b", F.substring(digest, 1, digits))
    before = Window.partitionBy(*by).orderBy("__b")
    sizes = bucketed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(
        *by,
        "__b",
        (F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*by)).alias(total),
    )
    inside = Window.partitionBy(*by, "__b").orderBy(digest, *tie)
    # With no strata the offset table has at most 16**digits rows.
    offsets = offsets if by else F.broadcast(offsets)
    return (
        bucketed.join(offsets, [*by, "__b"])
        .withColumn(rank, F.col("__before") + F.row_number().over(inside))
        .drop("__b", "__before")
    )


def kth_in_order(rows: DataFrame, order: Column, k: int) -> DataFrame:
    """One row with the ``k``-th smallest value ``o`` of ``order`` (1-based), or the largest one if there are fewer.

    Rows are dealt to ranges of the order and counted; only the range that the
    place falls into is sorted. The driver sees one count per range.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(
        rows.select(order.alias("o")).repartitionByRange(ranges, "o").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = sorted(dealt.groupBy("part").count().collect())
    left, part = k, None
    for part, size in sizes:
        if left <= size:
            break
        left -= size
    inside = dealt.filter(F.col("part") == part) if part is not None else dealt
    return inside.select("o").orderBy("o").limit(max(0, left)).agg(F.max("o").alias("o"))


def take_by_digest(df: DataFrame, quotas: DataFrame, digest: str, by: tuple[str, ...],
                   tie: tuple[str, ...] = (), digits: int = DIGEST_DIGITS) -> DataFrame:
    """Keep the first ``quota`` rows of each stratum in digest order.

    ``quotas`` has one row per stratum: ``by`` and ``quota``. Bucket counts give
    each stratum the bucket in which its quota runs out. Rows of earlier buckets
    pass without a shuffle, later ones are dropped in the scan, and only the
    rows of that one bucket are ranked. The cut table holds one row per
    stratum; the optimizer broadcasts it where its size allows.
    """
    bucketed = df.withColumn("__b", F.substring(digest, 1, digits))
    upto = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        bucketed.groupBy(*by, "__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .join(quotas.select(*by, F.col("quota").alias("__quota")), list(by))
        .withColumn("__upto", F.sum("__n").over(upto))
        .groupBy(*by)
        .agg(
            F.min(F.when(F.col("__upto") >= F.col("__quota"), F.col("__b"))).alias("__cut"),
            (
                F.first("__quota")
                - F.coalesce(F.max(F.when(F.col("__upto") < F.col("__quota"), F.col("__upto"))), F.lit(0))
            ).alias("__room"),
        )
    )
    reached = bucketed.join(cuts, list(by)).filter(
        F.col("__cut").isNull() | (F.col("__b") <= F.col("__cut"))
    )
    at_cut = F.coalesce(F.col("__b") == F.col("__cut"), F.lit(False))
    inside = Window.partitionBy(*by, "__b").orderBy(digest, *tie)
    edge = (
        reached.filter(at_cut)
        .withColumn("__rn", F.row_number().over(inside))
        .filter(F.col("__rn") <= F.col("__room"))
        .drop("__rn")
    )
    return reached.filter(~at_cut).unionByName(edge).drop("__b", "__cut", "__room")


def ladder(df: DataFrame, value: str, by: tuple[str, ...] = (), sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct value with counts, extra sums and running totals.

    Output: ``by``, value, ``n``, ``n_before`` (rows with smaller values),
    ``n_total``, and per extra sum ``s``: ``s``, ``s_before``, ``s_total``.
    """
    sums = sums or {}
    names = ["n", *sums]
    # Written, so that whatever reads the ladder does not count the rows again.
    counted = materialize(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(e.cast("long")).alias(s) for s, e in sums.items()]), "ladder")
    steps = counted.withColumn("__b", number_bucket(F.col(value)))
    buckets = steps.groupBy(*by, "__b").agg(*[F.sum(s).alias(f"__{s}") for s in names])
    upto = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    edges = buckets.select(
        *by,
        "__b",
        *[(F.sum(f"__{s}").over(upto) - F.col(f"__{s}")).alias(f"__{s}_off") for s in names],
        *[F.sum(f"__{s}").over(every).alias(f"{s}_total") for s in names],
    )
    inside = Window.partitionBy(*by, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(edges, [*by, "__b"]).select(
        *by,
        value,
        *names,
        *[(F.col(f"__{s}_off") + F.sum(s).over(inside) - F.col(s)).alias(f"{s}_before") for s in names],
        *[f"{s}_total" for s in names],
    )


def quantile_points(steps: DataFrame, value: str, probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Linear-interpolation quantiles from a ladder: ``by``, ``q``, ``quantile``.

    Each step emits only the positions that fall on it, so the result of the
    explode holds two rows per probability and group.
    """
    wanted = F.array(*[
        F.struct(F.lit(p).alias("q"), F.lit(side).alias("side"))
        for p in probs for side in (0, 1)
    ])
    place = lambda w: F.least(
        F.floor(w["q"] * (F.col("n_total") - 1)) + w["side"], F.col("n_total") - 1
    )
    hits = F.filter(
        wanted,
        lambda w: (place(w) >= F.col("n_before")) & (place(w) < F.col("n_before") + F.col("n")),
    )
    found = steps.select(*by, F.col(value).cast("double").alias("__v"), "n_total", F.explode(hits).alias("w"))
    pair = found.groupBy(*by, F.col("w.q").alias("q")).agg(
        F.max(F.when(F.col("w.side") == 0, F.col("__v"))).alias("__lo"),
        F.max(F.when(F.col("w.side") == 1, F.col("__v"))).alias("__hi"),
        F.max("n_total").alias("__n"),
    )
    place_in_rows = F.col("q") * (F.col("__n") - 1)
    share = place_in_rows - F.floor(place_in_rows)
    return pair.select(
        *by, "q", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * share).alias("quantile")
    )
