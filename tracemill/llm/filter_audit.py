"""How quality filters interact: every order of five filters, from one table of counts.

Each document passes or fails each filter, whatever the order, so a part of the
corpus is described by how many documents have each of the 2x2x2x2x2 patterns.
One pass over the texts gives these counts; every order and step is then a
contraction of the tensor, which selects pass, fail or all along each axis:

* kept: pass along the filters so far, all along the rest;
* removed: pass along the earlier ones, fail along the filter, all along the rest;
* failing alone: fail along the filter, pass along all others.

Three tensors are contracted at once: all documents, good ones, toxic ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace

LETTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "\t\n\x0b\x0c\r"  # and the space

_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)

OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> list[Column]:
    """Filters A to D of one text: too few words, too few distinct ones, too many capitals, a symbol."""
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    points = F.char_length(text)
    capitals = points - F.char_length(F.translate(text, CAPITALS, ""))
    return [
        n_words < LEAST_WORDS, 100 * n_distinct < DISTINCT_PERCENT * n_words, 100 * capitals > CAPITAL_PERCENT * points,
        text.rlike(SYMBOLS)]


def cells(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``(part, pattern, n, good, toxic)``: documents of a part by failures, bit i of ``pattern`` for filter i.

    Copies are found by a digest of the whole text. The first document of a text
    meets its own row again by digest and id, so no join is by a text alone and a
    text that a third of all rows share is no hot key.
    """
    ws = Workspace(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(text))), F.lit(0))
    facts = ws.save(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), mask.alias("mask")), "facts")
    firsts = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"))
    # Repeated rows are one row with a count before they meet anything.
    counted = facts.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(firsts, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.groupBy("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("pattern")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


@lru_cache(maxsize=1)
def plan() -> tuple[list[str], np.ndarray]:
    """The orders, and what each (order, step, measure) selects along each axis: (120, 5, 4, axis, 2).

    Measures: kept, removed, failing in any company, failing alone."""
    orders = ["".join(p) for p in permutations(LETTERS)]
    chosen = np.empty((len(orders), 5, 4, 5, 2), np.int64)
    for o, order in enumerate(orders):
        for s, letter in enumerate(order):
            before, at = [LETTERS.index(x) for x in order[:s]], LETTERS.index(letter)
            kept, removed, failing, alone = chosen[o, s]
            kept[:] = removed[:] = failing[:] = _ALL
            alone[:] = kept[before] = removed[before] = _PASS
            kept[at] = _PASS
            removed[at] = failing[at] = alone[at] = _FAIL
    return orders, chosen


def contract(tensors: np.ndarray) -> np.ndarray:
    """Counts by (tensor, order, step, measure) of tensors shaped (n, 2, 2, 2, 2, 2)."""
    _, chosen = plan()
    a, b, c, d, e = np.moveaxis(chosen.reshape(-1, 5, 2), 1, 0)
    found = np.einsum("nabcde,sa,sb,sc,sd,se->ns", tensors, a, b, c, d, e, optimize=True)
    return found.reshape(len(tensors), *chosen.shape[:3])


def _audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    orders, _ = plan()
    at = {letter: np.array([o.index(letter) for o in orders]) for letter in LETTERS}
    for frame in batches:
        for part, found in zip(frame["part"], frame["cells"]):
            tensors = np.zeros((3, 2, 2, 2, 2, 2), np.int64)
            for cell in found:
                axes = tuple(cell["pattern"] >> i & 1 for i in range(5))
                tensors[(slice(None), *axes)] = cell["n"], cell["good"], cell["toxic"]
            counts = contract(tensors)
            kept, removed, failing, alone = np.moveaxis(counts[0], -1, 0)
            rows = np.arange(len(orders))
            shares = {letter: int(removed[rows, at[letter]].sum()) for letter in LETTERS}
            yield pd.DataFrame({
                "part": part, "filter_order": np.repeat(orders, 5), "step": np.tile(np.arange(1, 6, dtype=np.int32), len(orders)),
                "kept": kept.ravel(), "removed": removed.ravel(), "redundant": (failing - removed).ravel(),
                "unique_fails": alone.ravel(), "good_lost": counts[1, :, :, 1].ravel(), "toxic_lost": counts[2, :, :, 1].ravel(),
                "shapley": [shares[letter] for order in orders for letter in order]})


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    A null part is the empty string, a null text is empty and so fails A alone
    (and E, if a smaller id is empty too). A document without an id is nobody's
    copy and nobody is its copy. Repeated rows count as often as they come; rows
    of one id and text are no copies of each other. A document is good or toxic
    if any label row of its id says so. An empty table has no parts and no rows.
    Other columns are not read.
    """
    grouped = cells(documents, labels, part).groupBy("part").agg(
        F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))
    return grouped.mapInPandas(_audited, OUT)
