"""Exact top-k search in Hamming space by incremental multi-index hashing.

Codes of 64 bits are cut into segments. A code within distance r of a query
lies within floor(r / m) of it in at least one of the m segments, so the search
looks up all segment values at radius 0, then 1, and so on, verifies every code
it meets, and stops when the k-th verified distance is provably covered: with
m segments done to radius s and j of them to s + 1, every code up to distance
m (s + 1) - 1 + j has been met.

Equal codes are one entry with its k + 1 smallest ids, which is all that a
top-k ordered by (distance, id) can use. The entries are dealt to blocks of
bounded size, each block answers every query from an index of its own, and the
answers are merged; queries are dealt to tasks too.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracemill.storage import Workspace

CODE_BITS = 64
BLOCK_CODES = 50_000    # entries in the index of one block
QUERY_ROWS = 4_000      # queries in one task


def sign_code(vector: Column) -> Column:
    """64 bits of a vector: bit i is set where component i is above 0. Null
    vectors and vectors with other than 64 components, or a null one, have no code."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(b))
    whole = (F.size(vector) == CODE_BITS) & ~F.exists(vector, lambda x: x.isNull())
    return F.when(whole, code)


@lru_cache(maxsize=64)
def _masks(width: int, radius: int) -> np.ndarray:
    """Numbers of ``width`` bits with ``radius`` of them set."""
    values = np.arange(1 << width, dtype=np.uint32)
    return values[np.bitwise_count(values) == radius]


class Index:
    """The segments of one block of distinct codes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        # About one entry for each segment value, as multi-index hashing advises.
        bits = min(16, max(4, int(np.log2(max(len(codes), 2)))))
        self.widths = [len(x) for x in np.array_split(np.arange(CODE_BITS), -(-CODE_BITS // bits))]
        self.shifts = np.cumsum([0, *self.widths[:-1]])
        self.tables = []
        for shift, width in zip(self.shifts, self.widths):
            value = self._segment(codes, shift, width)
            order = np.argsort(value, kind="stable")
            starts = np.searchsorted(value[order], np.arange((1 << width) + 1))
            self.tables.append((order, starts))

    @staticmethod
    def _segment(codes, shift, width):
        return (codes >> np.uint64(shift)) & np.uint64((1 << width) - 1)

    def search(self, query: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries that hold the k nearest members, and their distances: every
        entry up to the distance of the k-th member, so ties are whole."""
        met = np.zeros(0, np.int64)
        far = np.zeros(0, np.int64)
        segments = len(self.widths)
        for radius in range(max(self.widths) + 1):
            for j, (shift, width) in enumerate(zip(self.shifts, self.widths)):
                if radius <= width:
                    order, starts = self.tables[j]
                    values = int((query >> np.uint64(shift)) & np.uint64((1 << width) - 1)) ^ _masks(width, radius)
                    lo, n = starts[values], starts[values + 1] - starts[values]
                    hit = np.flatnonzero(n)
                    if len(hit):
                        lo, n = lo[hit], n[hit]
                        ends = np.cumsum(n)
                        new = order[np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)]
                        met = np.union1d(met, new)
                        far = np.bitwise_count(self.codes[met] ^ query).astype(np.int64)
                covered = segments * radius + j
                inside = far <= covered
                if self.counts[met[inside]].sum() >= k:
                    return self._nearest(met, far, k)
        return self._nearest(met, far, k)

    def _nearest(self, met, far, k):
        order = np.argsort(far, kind="stable")
        met, far = met[order], far[order]
        reach = np.searchsorted(np.cumsum(self.counts[met]), k)
        keep = far <= far[min(reach, len(far) - 1)] if len(far) else np.zeros(0, bool)
        return met[keep], far[keep]


def _answers(k: int):
    schema = ["query_id", "distance", "id"]

    def search(_, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in schema})
        counts = entries["ids"].map(len).to_numpy()
        index = Index(entries["code"].to_numpy().view(np.uint64), counts)
        ids = entries["ids"].to_numpy()
        out = []
        for qid, code in zip(queries["query_id"].to_numpy(), queries["code"].to_numpy().view(np.uint64)):
            met, far = index.search(code, k + 1)  # one may be the query itself
            own = np.concatenate([ids[e] for e in met])
            rows = np.stack([np.full(len(own), qid), np.repeat(far, counts[met]), own], 1)
            rows = rows[own != qid]
            out.append(rows[np.lexsort((rows[:, 2], rows[:, 1]))[:k]])
        return pd.DataFrame(np.concatenate(out), columns=schema)

    return search


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``codes (id, code)`` and ``queries (query_id, code)`` to ``(query_id, rank, id, distance)``.

    The k nearest rows of each query by (distance, id), without the row that has
    the query's own id; all rows where there are fewer. Rows with a null id or
    code are neither searched nor found; repeated rows of one id and code count
    once, as do repeated queries. Empty tables give an empty result.
    """
    ws = Workspace(codes.sparkSession)
    rows = codes.select(F.col("id").cast("long").alias("id"), F.col("code").cast("long").alias("code")).dropna().distinct()
    first = Window.partitionBy("code").orderBy("id")
    least = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
    entries = ws.save(least.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    asked = ws.save(
        queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("code").cast("long").alias("code")).dropna().distinct(),
        "queries")
    n_blocks = max(1, -(-entries.count() // BLOCK_CODES))
    n_groups = max(1, -(-asked.count() // QUERY_ROWS), min(codes.sparkSession.sparkContext.defaultParallelism, asked.count()) // n_blocks)
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("long")
    # Each block meets each group of queries: both are bounded.
    cell = F.struct(F.col("block"), F.col("part"))
    left = asked.withColumn("part", dealt("query_id", n_groups)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    right = entries.withColumn("block", dealt("code", n_blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).withColumn("part", F.col("part").cast("long"))
    left, right = left.withColumn("cell", cell), right.withColumn("cell", cell)
    found = left.select("cell", "query_id", "code").groupBy("cell").cogroup(right.select("cell", "code", "ids").groupBy("cell")).applyInPandas(
        _answers(k), "query_id long, distance long, id long")
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("long").alias("rank"), "id", "distance"))
