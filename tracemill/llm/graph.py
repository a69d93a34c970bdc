"""Connected components of an edge table, without gathering anything.

Edges are first reduced block by block: a block of bounded size keeps one edge
from each of its nodes to the smallest node it is connected with inside the
block. Where one block holds all edges, that is the answer. Otherwise each
round points every node at its smallest neighbour (nodes are compared by
a hash of their id, so that chains of rising ids shrink as fast as any other
graph) and contracts the edges along those pointers; edges inside one node
disappear. The pointers of all rounds, followed in turn, lead to one root per
component. Hot nodes only ever meet partial minima and joins on a side with
one row per node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace

BLOCK_EDGES = 1_000_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): every node of this block of edges with its smallest companion."""
    held = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
    if not held:
        return
    nodes, ends = np.unique(np.concatenate(held, axis=1), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        # The labels themselves move too, so whole trees merge at once.
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], schema=schema)


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, label)`` for every node of an edge: label is the smallest node
    id of its component. Self loops, repeated edges and nulls are ignored; no
    edges give no rows. Node ids are of type long."""
    ws = Workspace(edges.sparkSession)
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("v"))
    current = ws.save(
        edges.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b"))
        .filter("a is not null and b is not null and a <> b").distinct(), "edges0")
    blocks = max(1, -(-current.count() // BLOCK_EDGES))
    stars = ws.save(current.coalesce(blocks).mapInArrow(_stars, "a long, b long"), "stars")
    ws.drop("edges0")
    if blocks == 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("label"))
    current = ws.save(stars.filter("a <> b").distinct(), "edges0")
    rounds = []
    while current.limit(1).count():
        k = len(rounds)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ws.save(
            both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
            .select("a", F.least(F.col("m"), order(F.col("a")))["v"].alias("p")), f"step{k}")
        rounds.append(step)
        moved = (
            current.join(step.withColumnRenamed("p", "pa"), "a")
            .join(step.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        following = ws.save(moved, f"edges{k + 1}")
        ws.drop(f"edges{k}")
        current = following
    # From the last round to the first: where a pointer's target goes on.
    onward = rounds[-1].select(F.col("a").alias("n"), F.col("p").alias("root"))
    for k in range(len(rounds) - 2, -1, -1):
        onward = ws.save(
            rounds[k].join(onward.withColumnRenamed("n", "p"), "p", "left")
            .select(F.col("a").alias("n"), F.coalesce("root", "p").alias("root")), f"onward{k}")
        ws.drop(f"step{k + 1}")
    smallest = onward.groupBy("root").agg(F.min("n").alias("label"))
    return ws.save(
        onward.join(smallest, "root").select(F.col("n").alias("node"), "label"), "components")
