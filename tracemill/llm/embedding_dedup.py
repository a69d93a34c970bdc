"""Near-duplicate vectors by sorted projection passes.

Each pass draws random directions, writes the signs of a vector's products with
them one after the other as one bit string, and sorts all vectors by it. Near
vectors agree in most bits, so in some passes they agree in the first ones and
stand near each other. Every vector is compared with the next ``WINDOW`` ones,
by exact cosine; pairs found in any pass are united. The number of passes grows
with the logarithm of the number of vectors.

A pass only has to connect: of its pairs a block names a spanning forest.
Afterwards every component is compared whole, block against block, so the links
inside a component are counted exactly, however tight it is, and no pair
leaves a task.

Vectors that are positive multiples of each other to the last bit are one
member throughout, however many they are.

The sort order is cut into blocks of fixed length. A block also gets the
``WINDOW`` rows before it, so no window is cut off, and no
task holds more than a block, whatever the data. Signs come from a fixed seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracemill.llm.graph import components
from tracemill.storage import Workspace

PASSES = 32      # for up to PLAIN vectors
PLAIN = 100_000
MORE = 8         # passes for each doubling beyond
WINDOW = 512
BLOCK = 4000
CELL = 4096      # members of a block of a large component
SHARED = 2000    # members of small components that one task group compares, about
CHUNK = 256      # rows of a product
NEAR = 1e-5      # cosines of single precision so near the threshold are computed again
BITS = 126       # two numbers of 63 bits each
AT_ONCE = 8      # passes sorted by one job


def _directions(pass_: int, width: int) -> np.ndarray:
    return np.random.default_rng([97, pass_]).standard_normal((width, BITS))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, unit array<double>): null where a vector links with nothing."""
    schema = pa.schema([("id", pa.int64()), ("unit", pa.list_(pa.float64()))])
    for batch in batches:
        out = []
        for v in batch.column(1).to_pylist():
            unit = None
            if v and None not in v:
                x = np.array(v, np.float64)
                big = np.abs(x).max()
                if np.isfinite(x).all() and big > 0:
                    x = x / big  # so that squares neither overflow nor vanish
                    unit = (x / np.sqrt(x @ x)).tolist()
            out.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, schema.field(1).type)], schema=schema)


def _keys(passes: range):
    """One row for each vector and pass: (pass, hi, lo, rep, unit)."""

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        halves = (1 << np.arange(62, -1, -1)).astype(np.int64)
        for frame in frames:
            sizes = frame["unit"].map(len)
            for width, part in frame.groupby(sizes.to_numpy()):
                x = np.stack(part["unit"].to_numpy())
                for p in passes:
                    bits = (x @ _directions(p, int(width)) > 0).astype(np.int64)
                    yield pd.DataFrame({
                        "pass": p, "hi": bits[:, :63] @ halves, "lo": bits[:, 63:] @ halves,
                        "rep": part["rep"].to_numpy(), "unit": part["unit"].to_numpy()})

    return keys


def _neighbours(cosine: float):
    def near(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", kind="stable")
        rep, at = frame["rep"].to_numpy(), frame["at"].to_numpy()
        widths = frame["unit"].map(len).to_numpy()
        found = []
        for width in np.unique(widths):  # vectors of different lengths aren't comparable
            own = np.flatnonzero(widths == width)
            x = np.stack(frame["unit"].to_numpy()[own])
            r, t = rep[own], at[own]
            x32 = x.astype(np.float32)
            label = np.arange(len(own))
            for k in range(0, len(own), CHUNK):
                product = x32[k:k + CHUNK] @ x32[k:k + CHUNK + WINDOW].T
                i, j = np.nonzero(product >= cosine - NEAR)
                doubt = product[i, j] < cosine + NEAR
                i, j = i + k, j + k
                inside = (i < j) & (t[j] - t[i] <= WINDOW)
                i, j, doubt = i[inside], j[inside], doubt[inside]
                if doubt.any():
                    doubt[doubt] = np.einsum("ij,ij->i", x[i[doubt]], x[j[doubt]]) < cosine
                    i, j = i[~doubt], j[~doubt]
                label = _united(label, i, j)
            moved = np.flatnonzero(label != np.arange(len(own)))
            found.append(np.stack([r[label[moved]], r[moved]]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]})

    return near


def _united(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after uniting the ends of all pairs; label holds roots, the smallest of each tree."""
    while True:
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        if not len(i):
            return label
        for a, b in zip(*(label[v[np.unique(j, return_index=True)[1]]].tolist() for v in (i, j))):
            while label[a] != a:
                a = label[a]
            while label[b] != b:
                b = label[b]
            label[max(a, b)] = min(a, b)
        while (label[label] != label).any():
            label = label[label]


def _counts(cosine: float):
    """(content, others): links of the members of a cell, weighted by copies."""

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        label, copies, side = frame["label"].to_numpy(), frame["copies"].to_numpy(np.float64), frame["side"].to_numpy()
        apart = frame["i"].iat[0] != frame["j"].iat[0]
        widths = frame["unit"].map(len).to_numpy()
        others = np.zeros(len(frame))
        for width in np.unique(widths):
            left = np.flatnonzero((widths == width) & (side == 0))
            right = np.flatnonzero((widths == width) & (side == 1)) if apart else left
            if not len(left) or not len(right):
                continue
            x, y = (np.stack(frame["unit"].to_numpy()[w]) for w in (left, right))
            x32, y32 = x.astype(np.float32), y.astype(np.float32)
            for k in range(0, len(left), CHUNK):
                own = left[k:k + CHUNK]
                product = x32[k:k + CHUNK] @ y32.T
                ok = product >= cosine + NEAR
                a, b = np.nonzero((product >= cosine - NEAR) & ~ok)
                ok[a, b] = np.einsum("ij,ij->i", x[a + k], y[b]) >= cosine
                ok &= label[own, None] == label[right][None]
                if not apart:
                    ok[np.arange(len(own)), np.arange(k, k + len(own))] = False
                ok = ok.astype(np.float64)
                others[own] += ok @ copies[right]
                if apart:
                    others[right] += copies[own] @ ok
        return pd.DataFrame({"content": frame["content"], "others": others.astype(np.int64)})[others > 0]

    return count


def _linked(ws: Workspace, members: DataFrame, cosine: float) -> DataFrame:
    """(content, others) over all pairs of each component; members: (content, label, copies, unit)."""
    sizes = ws.save(members.groupBy("label").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    groups = (sizes.agg(F.sum("size")).first()[0] or 0) // SHARED + 1
    dealt = members.join(sizes, "label").withColumn("blocks", F.ceil(F.col("size") / CELL).cast("int"))
    small = dealt.filter("blocks = 1").select(
        F.pmod(F.xxhash64("label"), F.lit(groups)).alias("cell"), *(F.lit(0).alias(c) for c in ("i", "j", "side")),
        "content", "label", "copies", "unit")
    # A large component is dealt to cells of two blocks each, so every pair meets in one cell.
    placed = dealt.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    large = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("label").alias("cell"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "content", "label", "copies", "unit")
    shape = "content binary, others long"
    return (
        small.groupBy("cell", "i", "j").applyInPandas(_counts(cosine), shape)
        .unionByName(large.groupBy("cell", "i", "j").applyInPandas(_counts(cosine), shape))
        .groupBy("content").agg(F.sum("others").alias("others")))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
                 passes: int | None = None) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row for each row with an id.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, and so do vectors of another length. Repeated ids keep
    their rows and count as vectors of their own; rows without an id are left
    out. Every link has a cosine of at least ``cosine`` in double precision, and
    ``n_links`` counts all links inside a component; a pair that no pass brings
    within the window and no other links connect is not found (the tests and the
    README have the recall). An empty table gives an empty result. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter("id is not null")
    units = ws.save(
        rows.mapInArrow(_members, "id long, unit array<double>").withColumn(
            "content", F.when(F.col("unit").isNotNull(), F.unhex(F.sha2(F.array_join("unit", ","), 256)))), "units")
    ids = units.select("id", "content")
    classes = ws.save(
        ids.filter("content is not null").groupBy("content").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    one = units.join(classes, (units["content"] == classes["content"]) & (units["id"] == classes["rep"]))
    reps = ws.save(one.select(classes["content"], "rep", "unit").dropDuplicates(["content"]), "reps")
    if passes is None:
        passes = PASSES + math.ceil(MORE * math.log2(max(reps.count() / PLAIN, 1)))
    pairs = []
    for start in range(0, passes, AT_ONCE):
        keyed = reps.select("rep", "unit").mapInPandas(
            _keys(range(start, min(start + AT_ONCE, passes))), "pass int, hi long, lo long, rep long, unit array<double>")
        ranged = ws.save(
            keyed.repartitionByRange("pass", "hi", "lo", "rep").withColumn("part", F.spark_partition_id())
            .sortWithinPartitions("pass", "hi", "lo", "rep"), f"sorted{start}")
        order = Window.partitionBy("part", "pass").orderBy("hi", "lo", "rep")
        # One row for each part and pass: where its rows begin in the order.
        counts = ranged.groupBy("pass", "part").count()
        before = counts.withColumn(
            "before", F.sum("count").over(Window.partitionBy("pass").orderBy("part")) - F.col("count")).select("pass", "part", "before")
        placed = ranged.withColumn("within", F.row_number().over(order)).join(F.broadcast(before), ["pass", "part"]).withColumn(
            "at", F.col("before") + F.col("within") - 1)
        own, last = (F.floor((F.col("at") + more) / BLOCK).cast("long") for more in (0, WINDOW))
        blocks = placed.withColumn("block", F.explode(F.sequence(own, last))).select("pass", "block", "at", "rep", "unit")
        found = blocks.groupBy("pass", "block").applyInPandas(_neighbours(cosine), "a long, b long")
        pairs.append(ws.save(found.distinct(), f"pairs{start}"))
        ws.drop(f"sorted{start}")
    links = pairs[0]
    for more in pairs[1:]:
        links = links.unionByName(more)
    links = ws.save(links.distinct(), "links")
    ws.drop(*(f"pairs{s}" for s in range(0, passes, AT_ONCE)))
    labels = components(links).select(F.col("node").alias("rep"), "label")
    labelled = ws.save(
        classes.join(labels, "rep", "left").select("content", "copies", F.coalesce("label", "rep").alias("label")), "labelled")
    linked = _linked(ws, labelled.join(reps.select("content", "unit"), "content"), cosine)
    known = labelled.join(linked, "content", "left").select(
        "content", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.col("label").alias("component"))
    out = ids.join(known, "content", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
