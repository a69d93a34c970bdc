"""Candidate selection: keep-first, anti-join, quotas, balanced sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import blank_to_null, candidate_key, seeded_digest
from tracemill.operators.ranking import kth_in_order, take_by_digest
from tracemill.storage import materialize


def with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", candidate_key(F.col("repo_name"), F.col("pr_number")))


def dedup_keep_first(rows: DataFrame, key: str, order: Column, offset: int = 0, limit: int | None = None) -> DataFrame:
    """First row per key, with the number of copies it stands for in ``copies``.

    A group of copies is reduced map-side to one row per task before anything
    is shuffled, so its size does not matter. ``offset`` skips rows of the
    input order, ``limit`` keeps the first distinct keys of it.
    """
    source = rows
    if offset:
        # Rows before the offset do not take part at all, as when reading a file.
        # The last of the first ``offset`` places is the cut.
        cut = kth_in_order(rows, order, offset).scalar()
        source = rows.filter(F.coalesce(order > cut, F.lit(True)))
    columns = [c for c in rows.columns if c != key]
    first = source.groupBy(key).agg(
        F.min_by(F.struct(*columns), order).alias("row"),
        F.min(order).alias("__order"),
        F.count(F.lit(1)).alias("copies"),
    )
    if limit is not None:
        first = first.orderBy("__order").limit(limit)
    return first.select(key, "row.*", "copies")


def dedup_across_files(rows: DataFrame, key: str, file: str, order: Column) -> DataFrame:
    """Earlier file wins, then the earlier row of that file."""
    return dedup_keep_first(rows, key, F.struct(F.col(file), order))


def seen_keys(*outputs: DataFrame) -> DataFrame:
    """Keys present in earlier outputs; the repository may be under either name."""
    parts = []
    for out in outputs:
        names = [blank_to_null(F.col(c)) for c in ("repo_name", "repo") if c in out.columns]
        keyed = out.select(candidate_key(F.coalesce(*names), F.col("pr_number")).alias("key"))
        parts.append(keyed.filter(F.col("key").isNotNull()))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct()


def anti_join_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    return rows.join(seen, "key", "left_anti")


def quota_rebalance(counts: DataFrame, stratum: str, available: str, total: int) -> DataFrame:
    """Split ``total`` evenly over strata; what small strata cannot use goes to the others.

    The split runs in rounds: each round shares what is left among the strata
    that still have rows, and its remainder goes one each to the first of them
    (null comes last). What a round leaves of a stratum follows from its own
    rows and the rounds' few numbers, so a round is one aggregate over the count
    table and, where there is a remainder, the search for one place in its order.
    """
    kinds = dict(counts.dtypes)
    table = materialize(counts.select(stratum, F.col(available).cast("long").alias(available)), "strata")
    room, left, before = F.greatest(F.col(available), F.lit(0)), max(int(total), 0), None
    while True:
        found = table.agg(F.count_if(room > 0).alias("open"), F.sum(room).alias("room")).first()
        left -= 0 if before is None else before - found["room"]
        if not left or not found["open"]:
            break
        before = found["room"]
        share, remainder = divmod(left, found["open"])
        offer = F.lit(share).cast("long")
        if remainder:
            last = kth_in_order(table.filter(room > 0), F.struct(F.col(stratum).isNull(), F.col(stratum).alias("s")), remainder).first()["o"]["s"]
            early = F.lit(True) if last is None else F.coalesce(F.col(stratum) <= F.lit(last).cast(kinds[stratum]), F.lit(False))
            offer = offer + F.when(early, 1).otherwise(0)
        room = F.greatest(room - offer, F.lit(0))
    return table.withColumn("quota", F.col(available) - room)


def balanced_sample(rows: DataFrame, stratum: str, key: str, total: int | None, seed: int) -> DataFrame:
    """Seeded sample with balanced quotas, or everything when ``total`` covers it.

    The result carries ``position_digest``: ordering by it is the shuffle.
    """
    marked = rows.withColumn("__digest", seeded_digest(seed, F.col(key)))
    if total is not None:
        counts = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("__available"))
        quotas = quota_rebalance(counts, stratum, "__available", total).drop("__available")
        marked = take_by_digest(marked, quotas, "__digest", (stratum,), (key,))
    return marked.withColumn("position_digest", seeded_digest(seed + 1, F.col(key))).drop("__digest")


def shuffled(sample: DataFrame, key: str) -> DataFrame:
    return sample.orderBy("position_digest", key).drop("position_digest")


def pending_by_file(rows: DataFrame, file: str, key: str, order: Column, seen: DataFrame) -> DataFrame:
    """One row per (file, key) with its copy count and two flags: already seen, and
    first file among the files where the key is pending."""
    per_file = rows.groupBy(file, key).agg(
        F.count(F.lit(1)).alias("copies"), F.min(order).alias("first_order")
    )
    known = seen.select(key, F.lit(True).alias("__seen"))
    flagged = per_file.join(known, key, "left").withColumn("already_seen", F.coalesce("__seen", F.lit(False)))
    winner = flagged.groupBy(key).agg(F.min(file).alias("__winner"))
    return flagged.join(winner, key).select(
        file,
        key,
        "copies",
        "first_order",
        "already_seen",
        (~F.col("already_seen") & (F.col(file) == F.col("__winner"))).alias("pending"),
    )


def selection_stats(flagged: DataFrame, selected: DataFrame, file: str, key: str, total: int | None) -> DataFrame:
    """Per file: raw, deduplicated, already seen, pending, selected; plus the total row."""
    chosen = selected.select(key, F.lit(1).alias("__chosen"))
    joined = flagged.join(chosen, key, "left")
    stats = joined.rollup(file).agg(
        F.grouping(file).alias("is_total"),
        F.sum("copies").alias("raw_rows"),
        F.count(F.lit(1)).alias("deduped_rows"),
        F.count_if("already_seen").alias("already_seen"),
        F.count_if("pending").alias("pending_rows"),
        F.count_if(F.col("pending") & F.col("__chosen").isNotNull()).alias("selected_rows"),
        F.count_if(~F.col("pending") & ~F.col("already_seen")).alias("global_duplicates"),
    )
    # A limit of zero counts as "all pending" in the shortfall, as no limit does.
    goal = F.lit(total) if total else F.col("pending_rows")
    shortfall = F.greatest(goal - F.col("selected_rows"), F.lit(0)) if total is not None else F.lit(0)
    return stats.select(
        F.when(F.col("is_total") == 1, F.lit("[total]")).otherwise(F.col(file)).alias("file"),
        "raw_rows",
        "deduped_rows",
        "already_seen",
        "pending_rows",
        "selected_rows",
        (F.col("raw_rows") - F.col("deduped_rows")).alias("local_duplicates_removed"),
        F.col("global_duplicates").alias("global_duplicates_removed"),
        F.when(F.col("is_total") == 1, shortfall).cast("long").alias("shortfall"),
    )
