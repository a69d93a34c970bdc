"""Exact Jaccard similarity join of whole texts as a metric-space join.

Texts are sets of word shingles under the Jaccard distance d; two texts link
when d <= 1/4, that is 100 * common >= 75 * union.

* **Pivots and regions.** The pivots are the sets of one shingle each, in one
  global order (shingles that very many texts share come last, the others by
  number). All pivots inside a set are equally near, so its Voronoi region is
  that of its first shingle.
* **Boundary windows.** If x and y link, their intersection z lies within the
  radius of both: d(x, z) <= d(x, y). So x is replicated to the region of every
  pivot that can be the first shingle of a set within that radius, which are
  the first |x| - ceil(3/4 |x|) + 1 shingles of x, and no others. x and y
  then meet in the region of their first common shingle, and the positions
  there bound what else they can share.
* **Small regions** name their pairs at once. **Large regions** are joined
  recursively: one member becomes the pivot, every member gets its exact
  distance to it, the region falls into rings of width 1/4 around that pivot,
  and members next to a border are replicated to the ring outside (triangle
  inequality). Rings whose members are linked already are done. What is left
  after the last round is compared block by block inside the tasks, between
  different components, and only links leave them. Bit signatures go first: a
  bit that one set has and another has not is a shingle that they don't share,
  which bounds what they can share. Only members that this leaves a partner
  bring their sets.

Pairs and cells bring sets along in slices, each of which moves about as much
as all kept sets: the room on disk stays a multiple of the texts.

Equal sets are one member throughout. The result is the class of each text,
so links inside one component need not be listed.

Sets are compared through 64-bit numbers of shingles and of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.graph import components
from tracemill.llm.shingles import set_key, shingle_set
from tracemill.storage import Workspace

SHARED_BY = 32       # a shingle at the head of more texts than this comes late in the order
LATE_AT_MOST = 1 << 22  # shingles moved to the end of the order, the most shared first (32 MB, sent to the executors)
MOVED = 1 << 24      # numbers of sets that may be moved at once (128 MB), or as many as all kept sets have
SMALL = 32           # a region of at most so many members names all its pairs
LEAF = 2000          # members of a block of a region that is left
PAIRS = 1 << 14      # pairs whose signatures are compared at once
TALL = 200           # members that are compared with all others of a cell at once
DENSE = 48           # members from which a shingle of a cell is counted by products
MAP_BITS = 1 << 24   # of the map of wanted texts (2 MB)
ROUNDS = 2           # recursive divisions of large regions

_ROWS = "kind byte, s long, a long, b long, n int, pos int"
_ARROW = pa.schema([("kind", pa.int8()), ("s", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                    ("n", pa.int32()), ("pos", pa.int32())])
DOCUMENT, MEMBER, PAIR = 0, 1, 2


def window(n):
    """How many pivots a set of n shingles is replicated to."""
    return n - (3 * n + 3) // 4 + 1


def _may_link(na, nb, pa_, pb):
    """Sizes and positions of a first common shingle that a link allows."""
    both = na + nb
    return (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)) & (
        7 * (1 + np.minimum(na - pa_, nb - pb) - 1) >= 3 * both)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, fields, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for arrays in fields(batches):
        held.append(arrays)
        rows += len(arrays[0])
        if rows >= size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s, c): shingles at the head of the texts of this task, one count per distinct set."""
    schema = pa.schema([("s", pa.int64()), ("c", pa.int64())])
    seen: set[int] = set()
    for batch in batches:
        parts = []
        for text in batch.column(0).to_pylist():
            numbers = shingle_set(text)
            if len(numbers) and (key := set_key(numbers)) not in seen:
                seen.add(key)
                parts.append(numbers[: window(len(numbers))])
        if parts:
            s, c = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(c.astype(np.int64))], schema=schema)


def _replicas(late: np.ndarray):
    """DOCUMENT rows (s: id, a: key, n) and, once per set and task, MEMBER rows (s: pivot, a: key, n, pos)."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                numbers = shingle_set(text)
                n = len(numbers)
                key = set_key(numbers) if n else 0
                one = np.ones(1, np.int64)
                yield one * DOCUMENT, one * id_, one * key, one * 0, one * n, one * 0
                if not n or key in seen:
                    continue
                seen.add(key)
                p = window(n)
                if len(late):
                    at = np.minimum(np.searchsorted(late, numbers), len(late) - 1)
                    is_late = late[at] == numbers
                    if is_late[: p].any():
                        numbers = np.concatenate([numbers[~is_late], numbers[is_late]])
                many = np.ones(p, np.int64)
                yield many * MEMBER, numbers[:p], many * key, many * 0, many * n, np.arange(p)

    return lambda batches: _blocks(batches, 50_000, rows, _ARROW)


def _regions(small: int):
    """PAIR rows of small regions, MEMBER rows of large ones, DOCUMENT rows as they are."""

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            papers = columns[0] == DOCUMENT
            if papers.any():
                yield batch.filter(pa.array(papers))
            held.append([c[~papers] for c in columns])
        if not held:
            return
        _, s, key, _, n, pos = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((key, s))
        s, key, n, pos = s[order], key[order], n[order], pos[order]
        first = np.ones(len(s), bool)
        first[1:] = (s[1:] != s[:-1]) | (key[1:] != key[:-1])
        s, key, n, pos = s[first], key[first], n[first], pos[first]
        edge = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True])
        size = np.repeat(np.diff(edge), np.diff(edge))
        large = size > small
        for at in range(0, int(large.sum()), 100_000):
            w = np.flatnonzero(large)[at:at + 100_000]
            yield _batch(np.full(len(w), MEMBER), s[w], key[w], np.zeros(len(w), np.int64), n[w], pos[w])
        keep = (size > 1) & ~large
        s, key, n, pos = s[keep], key[keep], n[keep].astype(np.int64), pos[keep].astype(np.int64)
        pairs, fits = [], []
        for step in range(1, small):
            i = np.flatnonzero(s[:-step] == s[step:])
            if not len(i):
                break
            i = i[4 * np.minimum(n[i], n[i + step]) >= 3 * np.maximum(n[i], n[i + step])]
            j = i + step
            pairs.append(np.stack([key[i], key[j]], 1))
            fits.append(_may_link(n[i], n[j], pos[i], pos[j]))
        if pairs:
            pairs, which, times = np.unique(np.concatenate(pairs), axis=0, return_inverse=True, return_counts=True)
            fit = np.zeros(len(pairs), np.int64)
            fit[which.ravel()[np.concatenate(fits)]] = 1
            yield _batch(np.full(len(pairs), PAIR), times, pairs[:, 0], pairs[:, 1], fit, np.zeros(len(pairs), np.int64))

    return regions


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def signature(numbers: np.ndarray) -> bytes:
    """One bit for each of at least twice as many buckets as there are numbers, a power of two of them."""
    bits = max(64, 1 << int(2 * len(numbers) - 1).bit_length())
    with np.errstate(over="ignore"):
        mixed = (numbers.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
    out = np.zeros(bits, np.uint8)
    out[mixed & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A signature with fewer buckets."""
    while len(words) > length:
        words = words[:len(words) // 2] | words[len(words) // 2:]
    return words


def _can_share(f: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs of rows can link, by their sizes and signatures."""
    n, words = f["n"].to_numpy(np.int64), [np.frombuffer(b, "<u8") for b in f["bits"]]
    lengths = np.array([len(w) for w in words])
    out = np.zeros(len(i), bool)
    at = np.minimum(lengths[i], lengths[j])
    for length in np.unique(at):
        there = np.flatnonzero(lengths >= length)
        place = np.full(len(n), -1)
        place[there] = np.arange(len(there))
        table = np.stack([folded(words[t], length) for t in there])
        chosen = np.flatnonzero(at == length)
        for s in range(0, len(chosen), PAIRS):
            c = chosen[s:s + PAIRS]
            x, y, na, nb = table[place[i[c]]], table[place[j[c]]], n[i[c]], n[j[c]]
            apart = x ^ y
            only_x = np.bitwise_count(apart & x).sum(axis=1, dtype=np.int64)
            only_y = np.bitwise_count(apart & y).sum(axis=1, dtype=np.int64)
            out[c] = 7 * np.minimum(na - only_x, nb - only_y) >= 3 * (na + nb)
    return out


def _sets(words: np.ndarray):
    """(key, numbers, bits) of the texts whose bit is set."""
    schema = pa.schema([("key", pa.int64()), ("numbers", pa.list_(pa.int64())), ("bits", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(0).to_numpy(zero_copy_only=False)
            wanted = (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            found = [shingle_set(t) for t in batch.column(1).filter(pa.array(wanted)).to_pylist()]
            found = [f for f in found if len(f)]
            if found:
                ends = np.cumsum([0, *map(len, found)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(f) for f in found], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(found))),
                     pa.array([signature(f) for f in found], pa.binary())], schema=schema)

    return sets


class JaccardJoin:
    """The steps of one join; ``result`` is the entry."""

    def __init__(self, documents: DataFrame, id_col: str, text_col: str):
        self.spark = documents.sparkSession
        self.ws = Workspace(self.spark)
        self.docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def late_shingles(self) -> np.ndarray:
        """At most LATE_AT_MOST numbers, sorted."""
        counted = (
            self.docs.select("text").mapInArrow(_heads, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
            .filter(F.col("c") > SHARED_BY))
        late = self.ws.save(counted, "late")
        if late.count() > LATE_AT_MOST:
            late = late.orderBy(F.desc("c"), "s").limit(LATE_AT_MOST)
        # As Arrow columns: a Row for each number would take ten times the memory.
        numbers = np.sort(late.select("s").toArrow().column("s").to_numpy().astype(np.int64))
        self.ws.drop("late")
        return numbers

    def keep_sets(self, keys: DataFrame) -> None:
        """Writes the whole sets of the given keys, for all later comparisons."""
        wanted = keys.distinct().join(self.readers, "key")
        # A bit map of fixed size spares the texts that no pair can want; the
        # joins with it are exact, so a bit set by chance costs a text and no more.
        bit = F.pmod(F.xxhash64("id"), F.lit(MAP_BITS))
        words, self.numbers = np.zeros(MAP_BITS // 64, np.uint64), 0
        for r in wanted.select(bit.alias("bit"), "n").groupBy(F.shiftright("bit", 6).alias("word")).agg(
                F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"),
                F.sum(F.col("n").cast("long")).alias("numbers")).collect():
            words[r["word"]] = np.int64(r["bits"]).view(np.uint64)
            self.numbers += r["numbers"]
        self.sets = self.ws.save(
            self.docs.filter("id is not null").select(bit.alias("bit"), "text").mapInArrow(
                _sets(words), "key long, numbers array<long>, bits binary"), "sets")

    def in_slices(self, moved: int, rows: DataFrame, by: list[str], do, name: str) -> DataFrame:
        """``do`` over the rows, slice after slice: what a slice has moved is gone before the next one.

        ``moved`` is how many numbers all rows bring along. One slice moves about
        as many as the kept sets have, so disk does not grow with the pairs.
        """
        slices = max(1, -(-moved // max(self.numbers, MOVED)))
        of = F.pmod(F.xxhash64(F.lit("slice"), *by), F.lit(slices))  # not the hash that deals out blocks
        return reduce(DataFrame.unionByName, [
            self.ws.save(do(rows.filter(of == k) if slices > 1 else rows), f"{name}{k}") for k in range(slices)])

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, common, total) of each distinct pair, from the whole sets."""
        common = F.size(F.array_intersect("x", "y"))
        pairs = self.ws.save(pairs.distinct(), f"{name}_distinct")
        moved = _total(pairs.join(self.readers.select(F.col("key").alias("a"), "n"), "a"), F.col("n"))

        def compared(some: DataFrame) -> DataFrame:
            return (
                some.join(self.sets.select(F.col("key").alias("a"), F.col("numbers").alias("x")), "a")
                .join(self.sets.select(F.col("key").alias("b"), F.col("numbers").alias("y")), "b")
                .select("a", "b", common.cast("long").alias("common"), (F.size("x") + F.size("y")).cast("long").alias("total"))
                .distinct())

        out = self.in_slices(moved, pairs, ["a", "b"], compared, f"{name}_verified")
        self.ws.drop(f"{name}_distinct")
        return out

    def small_pairs(self, found: DataFrame, members: DataFrame) -> DataFrame:
        """Pairs of small regions that their heads allow to link.

        Up to the last pivot of the head that ends first, all common shingles
        were counted: in small regions one by one, in large ones at most as many
        as either set has there. Beyond it, a set has no more than what follows its
        head.
        """
        counted = found.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(
            F.sum("s").alias("seen"), F.max("n").alias("fits")).filter("fits = 1")
        in_large = members.groupBy("key").agg(F.count("*").alias("large"))
        sizes = self.ws.save(
            self.readers.join(in_large, "key", "left").select("key", "n", F.coalesce("large", F.lit(0)).alias("large")), "head_sizes")
        for side in ("a", "b"):
            counted = counted.join(sizes.select(
                F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("large").alias(f"large_{side}")), side)
        # What follows the head of n shingles is ceil(3/4 n) - 1.
        after = F.ceil(3 * F.greatest("n_a", "n_b") / 4) - 1
        most = F.col("seen") + F.least("large_a", "large_b") + after
        return counted.filter(7 * most >= 3 * (F.col("n_a") + F.col("n_b"))).select("a", "b")

    def labelled(self, members: DataFrame, links: list[DataFrame]) -> DataFrame:
        """Members with the label of their component so far; regions of one label only are left out."""
        labels = components(self.edges(links)).select(F.col("node").alias("key"), "label")
        out = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        open_ = out.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        return out.join(open_.select("region"), "region", "left_semi")

    @staticmethod
    def edges(links: list[DataFrame]) -> DataFrame:
        whole = reduce(DataFrame.unionByName, links)
        return whole.filter("100 * common >= 75 * (total - common)").select("a", "b")

    def divide(self, members: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
        """One recursive step over large regions: verified pairs with each region's
        pivot, and the rings that remain."""
        spread = members.groupBy("key").agg(F.count("*").alias("regions"))
        rank = F.struct((F.col("guest") != 0).alias("g"), (-F.col("regions")).alias("r"), F.col("key").alias("k"))
        # A region whose members all came as guests in one round was compared where they are at home.
        pivots = members.join(spread, "key").groupBy("region").agg(
            F.min(rank)["k"].alias("pivot"), F.bit_and("guest").alias("guests")).filter("guests = 0").drop("guests")
        paired = members.join(pivots, "region")
        lo, hi = F.least("key", "pivot"), F.greatest("key", "pivot")
        checked = self.verified(paired.filter("key <> pivot").select(lo.alias("a"), hi.alias("b")), f"round{round_}")
        # Four times the distance, rounded down, in whole numbers: nothing is lost at a border.
        ring = F.expr("cast((4 * (total - 2 * common)) div (total - common) as int)")
        measured = (
            paired.filter("key <> pivot").withColumn("a", lo).withColumn("b", hi).join(checked, ["a", "b"]).withColumn("ring", ring))
        # A member is at home in its own ring, and a guest in the next one out. Two
        # guests of one round also meet at home; guests of different rounds may not.
        places = F.array(
            F.struct(F.col("ring").alias("ring"), F.col("guest").alias("guest")),
            F.struct((F.col("ring") + 1).alias("ring"), F.col("guest").bitwiseOR(F.lit(1 << round_)).alias("guest")))
        rest = measured.withColumn("place", F.explode(places)).select(
            F.xxhash64("region", "place.ring", F.lit(round_)).alias("region"), "key", "n", "pos",
            F.col("place.guest").alias("guest"))
        return checked, rest

    def result(self) -> DataFrame:
        """(id, n, label): label is the smallest id of the component."""
        late = self.late_shingles()
        replicas = self.docs.filter("id is not null").mapInArrow(_replicas(late), _ROWS)
        found = self.ws.save(replicas.repartition("s").mapInArrow(_regions(SMALL), _ROWS), "found", ("kind",))
        papers = found.filter(F.col("kind") == DOCUMENT).select(F.col("s").alias("id"), F.col("a").alias("key"), "n")
        classes = papers.filter("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"))
        self.readers = self.ws.save(classes, "readers")
        members = found.filter(F.col("kind") == MEMBER).select(
            F.col("s").alias("region"), F.col("a").alias("key"), "n", "pos", F.lit(0).alias("guest"))
        pairs = self.ws.save(self.small_pairs(found, members), "small_pairs")
        self.keep_sets(pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(members.select("key")))
        links = [self.verified(pairs, "small")]
        for round_ in range(ROUNDS):
            members = self.ws.save(self.labelled(members, links), f"members{round_}")
            if not members.limit(1).count():
                break
            checked, rest = self.divide(members, round_)
            links.append(checked)
            members = rest
        else:
            members = self.ws.save(self.labelled(members, links), "members_last")
        if members.limit(1).count():
            links.append(self.leaf_links(members))
        self.ws.drop("sets", "small_pairs")
        labels = components(self.edges(links)).select(F.col("node").alias("key"), "label")
        # Components of keys, then the smallest id of each.
        class_label = self.readers.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        least = class_label.groupBy("label").agg(F.min("id").alias("component"))
        named = class_label.join(least, "label").select("key", "component")
        return papers.join(named, "key", "left").select(
            "id", "n", F.coalesce("component", "id").alias("label"))

    def leaf_links(self, members: DataFrame) -> DataFrame:
        """Links between different components inside the regions that are left.

        A region is dealt to cells of two blocks each (or of one with itself), so
        every pair of its members meets in one cell. First each cell names the
        members that have a partner which labels, sizes, positions and signatures
        allow; only those bring their sets. No pair leaves a task but links that
        unite components.
        """
        counted = members.groupBy("region").agg(F.ceil(F.count("*") / LEAF).cast("int").alias("blocks"))
        dealt = members.join(counted, "region").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        cells = dealt.withColumn("other", other).withColumn("cell", F.struct(
            "region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
        rows = cells.select("cell", "key", "label", "n", "pos", "guest", "block")
        bits, sets = (self.sets.select("key", c).dropDuplicates(["key"]) for c in ("bits", "numbers"))
        # A signature has at most a sixteenth of the room of its set.
        kept = self.in_slices(
            _total(dealt, F.col("n") * F.col("blocks")) // 16, rows, ["cell"],
            lambda some: some.join(bits, "key").groupBy("cell").applyInPandas(_with_partner, rows.schema), "leaf_members")
        return self.in_slices(
            _total(kept, F.col("n")), kept, ["cell"],
            lambda some: some.join(sets, "key").groupBy("cell").applyInPandas(
                _leaf(DENSE), "a long, b long, common long, total long").distinct(), "leaf_verified")


def _total(rows: DataFrame, size) -> int:
    return rows.agg(F.sum(size.cast("long")).alias("total")).collect()[0]["total"] or 0


def _allowed(f: pd.DataFrame, rows: slice) -> np.ndarray:
    """Which pairs of the given rows with all rows may link, and would unite two components."""
    n, left, label = f["n"].to_numpy(np.int64), (f["n"] - f["pos"]).to_numpy(np.int64), f["label"].to_numpy()
    guest = f["guest"].to_numpy()  # one bit for each round that brought a row as a guest
    block, cell = f["block"].to_numpy(), f["cell"].iloc[0]
    ok = 7 * np.minimum(left[rows, None], left[None]) >= 3 * (n[rows, None] + n[None])
    ok &= 4 * np.minimum(n[rows, None], n[None]) >= 3 * np.maximum(n[rows, None], n[None])
    if cell["i"] != cell["j"]:
        ok &= block[rows, None] != block[None]  # pairs of one block meet in the cell of that block alone
    return ok & (label[rows, None] != label[None]) & (guest[rows, None] & guest[None] == 0)


def _with_partner(f: pd.DataFrame) -> pd.DataFrame:
    partner = np.zeros(len(f), bool)
    for k in range(0, len(f), TALL):
        i, j = np.nonzero(np.triu(_allowed(f, slice(k, k + TALL)), k + 1))
        fits = _can_share(f, i + k, j)
        partner[(i + k)[fits]] = partner[j[fits]] = True
    return f[partner].drop(columns="bits")


def _leaf(many: int):
    """Links of a cell that unite components, from the whole sets of its members.

    Shingles of at least ``many`` members are counted as products of 0/1
    columns, the others by the pairs that share them.
    """

    def leaf(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates("key").reset_index(drop=True)
        m, key, n = len(f), f["key"].to_numpy(), f["n"].to_numpy(np.int64)
        common = np.zeros((m, m), np.float32)
        owner = np.repeat(np.arange(m), n)
        _, column, times = np.unique(np.concatenate(f["numbers"].to_numpy()), return_inverse=True, return_counts=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        dense = times >= many
        rank = np.cumsum(dense) - 1
        picked = dense[column]
        rows, columns = owner[picked], rank[column[picked]]
        for at in range(0, int(dense.sum()), 1024):
            inside = (columns >= at) & (columns < at + 1024)
            x = np.zeros((m, 1024), np.float32)
            x[rows[inside], columns[inside] - at] = 1
            for k in range(0, m, TALL):
                common[k:k + TALL] += x[k:k + TALL] @ x.T
        rows, columns = owner[~picked], column[~picked]
        flat = common.ravel()
        for step in range(1, many):
            i = np.flatnonzero(columns[:-step] == columns[step:]) if step < len(columns) else []
            if not len(i):
                break
            found, times = np.unique(rows[i] * m + rows[i + step], return_counts=True)
            flat[found] += times
            flat[(found % m) * m + found // m] += times
        label = {v: v for v in f["label"]}

        def root(v):
            while label[v] != v:
                label[v] = label[label[v]]
                v = label[v]
            return v

        of, out = f["label"].tolist(), []
        for k in range(0, m, TALL):
            linked = 175 * common[k:k + TALL] >= 75 * (n[k:k + TALL, None] + n[None])
            i, j = np.nonzero(np.triu(linked & _allowed(f, slice(k, k + TALL)), k + 1))
            for x, y in zip((i + k).tolist(), j.tolist()):
                u, v = root(of[x]), root(of[y])
                if u != v:
                    label[u] = v
                    c = int(common[x, y])
                    out.append((min(key[x], key[y]), max(key[x], key[y]), c, int(n[x] + n[y])))
        return pd.DataFrame(out, columns=["a", "b", "common", "total"]).astype(np.int64)

    return leaf


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row for each row of documents with an id.

    Null, empty and blank texts have no shingles and link with nothing: their
    component is their own id. Rows whose id is null are left out, since nothing
    could name them. Repeated ids each keep their row; their texts count as
    texts of one and the same id. Other columns, whatever their names, are not
    read. An empty table gives an empty result.
    """
    out = JaccardJoin(documents, id_col, text_col).result()
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("label").alias("component_id"))
