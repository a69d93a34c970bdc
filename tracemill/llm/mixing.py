"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source whose target is t and whose size is w is due t / w
copies: a whole number of them, and one more with the remaining probability.
Those probabilities are settled by pivotal sampling in units of words: two
documents of a source meet, mass moves from one to the other until one of them
is settled (no further copy, or one), and the other meets the next. The
direction is random with the odds that keep every expectation, and the words of
a pair never change, so a source misses its target by less than the last
document's size.

The meetings form a tree: documents are dealt to blocks by a hash, each block
settles all but one of its documents, and the residuals of ``FAN`` blocks form
a block of the next level, up to one residual per source. No block holds
more than a small number of rows, however large a source is.

Column expressions only; chances come from hashes of ids, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracemill.storage import Workspace

BLANKS = "\\x20\\x09-\\x0D"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5    # of all sizes
MOST = 2.0     # a target is at most so many times its source's size
FAN = 64       # residuals that meet in one block

_ITEM = "struct<id:bigint,size:bigint,due:double,room:double>"
_STATE = f"struct<out:array<struct<id:bigint,size:bigint,extra:int>>,last:{_ITEM}>"


def words(text: Column) -> Column:
    """Number of runs of other characters than blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def ranked(ws: Workspace, sources: DataFrame) -> DataFrame:
    """``place``: the position of each source by code point, null last. Ranges of
    sources are numbered apart and shifted by the counts of the ranges before."""
    key = [F.col("source").isNull(), F.col("source")]
    parts = ws.save(
        sources.repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "source_ranges")
    counts = parts.groupBy("part").count().collect()  # one row for each partition
    before = {p: sum(r["count"] for r in counts if r["part"] < p) for p in sorted(r["part"] for r in counts)}
    shift = reduce(lambda c, p: c.when(F.col("part") == p, before[p]), before, F.when(F.lit(False), 0))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*key))
    return parts.withColumn("place", (within - 1 + shift).cast("long")).drop("part")


def targets(ws: Workspace, sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    The total goes out by weight; a source that would get more than ``most``
    times its size stops there, and the excess goes to the others by weight,
    until none is above. Weights repeat in the order of the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = ws.save(
        ranked(ws, sources).select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")),
        "weighted")
    total = share * (table.agg(F.sum("source_size").alias("s")).first()["s"] or 0)
    level, capped = 0.0, -1
    while True:  # each pass stops at least one more source
        full = F.col("weight") * level > F.col("cap") if capped >= 0 else F.lit(False)
        at = table.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if at["n"] == capped or not at["open"]:
            break
        capped, level = at["n"], (total - at["held"]) / at["open"]
    target = F.when(F.col("weight") * level > F.col("cap"), F.col("cap")).otherwise(F.col("weight") * level)
    return table.select("source", "source_size", target.cast("double").alias("target"))


def _chance(a: Column, b: Column, seed: int) -> Column:
    """A number in [0, 1) for a meeting of two ids."""
    return F.pmod(F.xxhash64(a, b, F.lit(seed)), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _meet(items: Column, seed: int) -> Column:
    """Settles all items of a block but the last survivor.

    due: words still to be given as a further copy; room: words of a whole
    further copy. Both are multiples of the item's own size.
    """
    none = F.array().cast("array<struct<id:bigint,size:bigint,extra:int>>")
    first = F.struct(none.alias("out"), F.element_at(items, 1).cast(_ITEM).alias("last")).cast(_STATE)

    def step(state: Column, x: Column) -> Column:
        y = state["last"]
        rise = F.least(x["room"] - x["due"], y["due"])        # x gains, y gives
        fall = F.least(x["due"], y["room"] - y["due"])        # x gives, y gains
        up = _chance(x["id"], y["id"], seed) * (rise + fall) < fall
        moved = F.when(up, rise).otherwise(-fall)
        x_due, y_due = x["due"] + moved, y["due"] - moved
        x_full = up & (rise >= x["room"] - x["due"])
        x_done = x_full | (~up & (fall >= x["due"]))
        y_full = ~x_done & ~up & (fall >= y["room"] - y["due"])
        settled = F.when(x_done, F.struct(x["id"].alias("id"), x["size"].alias("size"), x_full.cast("int").alias("extra")))
        settled = settled.otherwise(F.struct(y["id"].alias("id"), y["size"].alias("size"), y_full.cast("int").alias("extra")))
        on_y = F.struct(y["id"].alias("id"), y["size"].alias("size"), y_due.alias("due"), y["room"].alias("room"))
        on_x = F.struct(x["id"].alias("id"), x["size"].alias("size"), x_due.alias("due"), x["room"].alias("room"))
        return F.struct(
            F.array_append(state["out"], settled).alias("out"), F.when(x_done, on_y).otherwise(on_x).alias("last")).cast(_STATE)

    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17) -> DataFrame:
    """``(id_col, source_col, size, source_size, target, copies)``, one row for each row of documents.

    copies is at most ``most``, rounded up. Null texts have size 0 and get no
    copies, like empty ones; null sources form one source, the last. Repeated
    rows of one id, source and size are settled together and get the same
    number of copies. Null ids count as one id. An empty table gives an empty
    result. Other columns are not read.
    """
    ws = Workspace(documents.sparkSession)
    rows = ws.save(
        documents.select(
            F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = ws.save(targets(ws, sources, weights, share, most), "goals")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals_due = goals.select("source", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part"))
    # One item for each id and size; repeated rows weigh together.
    items = rows.filter("size > 0").groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    items = _with_source(items, goals_due).filter("part > 0")
    source_blocks = F.greatest(F.ceil(F.col("items") / FAN), F.lit(1))
    per_source = ws.save(items.groupBy("source").agg(F.count("*").alias("items")), "per_source")
    mass = (F.col("size") * F.col("n")).cast("double")
    dealt = _with_source(items, per_source).select(
        "source", F.pmod(F.xxhash64("id", "size", F.lit(seed)), source_blocks).alias("block"),
        F.struct("id", "size", (mass * F.col("part")).alias("due"), mass.alias("room")).cast(_ITEM).alias("item"))
    settled, level = [], 0
    while True:
        order = lambda x: F.struct(F.xxhash64(x["id"], x["size"], F.lit(seed + level)).alias("h"), x.alias("x"))  # noqa: B023, E731
        block = F.transform(F.array_sort(F.transform(F.collect_list("item"), order)), lambda p: p["x"])
        met = ws.save(
            dealt.groupBy("source", "block").agg(_meet(block, seed + level).alias("m"))
            .select("source", "block", "m.out", "m.last"), f"level{level}")
        settled.append(met.select("source", F.explode("out").alias("o")).select("source", "o.*"))
        level += 1
        more = met.groupBy("source").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
        if not more:
            break
        dealt = met.select("source", F.floor(F.col("block") / FAN).cast("long").alias("block"), F.col("last").alias("item"))
    # The one residual of a source: a last draw with the chance it has left.
    last = met.select(
        "source", "last.id", "last.size",
        (_chance(F.col("last.id"), F.lit(-1), seed) * F.col("last.room") < F.col("last.due")).cast("int").alias("extra"))
    extra = reduce(DataFrame.unionByName, [*settled, last])
    out = _with_source(rows, goals_due)
    keyed = extra.select(F.col("id").alias("id_"), F.col("source").alias("source_"), F.col("size").alias("size_"), "extra")
    same = out["id"].eqNullSafe(keyed["id_"]) & out["source"].eqNullSafe(keyed["source_"]) & (out["size"] == keyed["size_"])
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(0)
    return out.join(keyed, same, "left").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.cast("long").alias("copies"))


def _with_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on source, where null equals null."""
    right = right.withColumnRenamed("source", "source_")
    return left.join(right, left["source"].eqNullSafe(right["source_"])).drop("source_")

