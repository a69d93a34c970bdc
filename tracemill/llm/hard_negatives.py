"""Hard negatives of anchors: rows of other labels that score just below an anchor's best rows of its own label.

Scores are inner products of whole numbers. To score few pairs, each vector is
encoded once: it is rotated, and one bit says the sign of each component. The
signs with one stored coefficient, the alignment of vector and code, are the
closest multiple of the code; what is left is at right angles to it, is rotated
again and encoded the same way, a few levels deep. With each level its residual
norm is stored.

An anchor is rotated alike and its components are rounded to 8 bits. Counting
bits that code and bit planes share gives its inner product with a code up to a
known rounding error. By Cauchy-Schwarz the rest is at most the residual norm
times the norm of the anchor's part at right angles to the code. So every pair
has an interval that surely holds its score; pairs whose interval can't reach
the answer go, the others see the next level, and what survives all levels is
scored in whole numbers. No answer is estimated.

Anchors and rows meet in blocks of bounded size, dealt by a hash of the id.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.storage import Workspace

SCALE = 256
LEVELS = 6              # of the pairs of the given embeddings 4 to 5 % survive; with 4 levels 16 to 32 %
PLANES = 8
SLACK = 1e-9            # of the product of norms, for rounding in double precision
ROW_BLOCK = 8_192       # rows of a block, about
ANCHOR_BLOCK = 4_096    # anchors of a block, about
STRIP = 64              # anchors whose pairs are in memory at once
SCORED = 1 << 16        # pairs scored at once

CODED = "vec_id long, label long, anchor boolean, dims int, vector binary, codes binary, numbers binary"
SCORES = "anchor_id long, other_id long, score long"


@lru_cache(maxsize=64)
def rotation(dims: int, level: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng((dims, level)).standard_normal((dims, dims)))[0]


def _bits(chosen: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(chosen, axis=1, bitorder="little")
    padded = np.zeros((len(chosen), -(-chosen.shape[1] // 64) * 8), np.uint8)
    padded[:, :packed.shape[1]] = packed
    return padded.view("<u8")


def codes_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, level, word), and numbers (row): the norm, then alignment and residual norm of each level."""
    rest, dims = vectors, vectors.shape[1]
    words, numbers = [], [np.linalg.norm(vectors, axis=1)]
    for level in range(LEVELS):
        rest = rest @ rotation(dims, level)
        signs = np.where(rest >= 0, 1.0, -1.0)
        aligned = np.abs(rest).sum(axis=1) / max(dims, 1)
        rest = rest - aligned[:, None] * signs
        words.append(_bits(signs > 0))
        numbers += [aligned, np.linalg.norm(rest, axis=1)]
    return np.stack(words, axis=1), np.stack(numbers, axis=1)


def _coded(frames):
    for frame in frames:
        sizes = frame["vector"].map(len).to_numpy()
        for dims in np.unique(sizes):
            part = frame[sizes == dims]
            vectors = np.floor(SCALE * np.array(part["vector"].tolist(), np.float64).reshape(len(part), dims))
            words, numbers = codes_of(vectors)
            narrow = np.abs(vectors).max(axis=1, initial=0) < 2 ** 31
            yield pd.DataFrame({
                "vec_id": part["vec_id"].to_numpy(), "label": part["label"].to_numpy(), "anchor": part["anchor"].to_numpy(),
                "dims": np.int32(dims), "vector": [v.astype("<i4" if n else "<f8").tobytes() for v, n in zip(vectors, narrow)],
                "codes": [w.tobytes() for w in words], "numbers": [x.tobytes() for x in numbers]})


class Block:
    """Rows of one dimension, out of their stored form."""

    def __init__(self, frame: pd.DataFrame):
        self.ids, self.labels = frame["vec_id"].to_numpy(np.int64), frame["label"].to_numpy(np.int64)
        self.dims = int(frame["dims"].iloc[0])
        self.vectors = np.array([
            np.frombuffer(v, "<i4" if len(v) == 4 * self.dims else "<f8") for v in frame["vector"]], np.float64).reshape(len(frame), self.dims)
        self.codes = np.frombuffer(b"".join(frame["codes"]), "<u8").reshape(len(frame), LEVELS, -1)
        numbers = np.frombuffer(b"".join(frame["numbers"]), "<f8").reshape(len(frame), -1)
        self.norms, self.aligned, self.residual = numbers[:, 0], numbers[:, 1::2], numbers[:, 2::2]
        self.ones = np.bitwise_count(self.codes).sum(axis=2, dtype=np.int64)


class Asked:
    """Rotated and rounded anchors: bit planes of each level, with what turns their counts into products."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.norms = vectors, np.linalg.norm(vectors, axis=1)
        dims, turned = vectors.shape[1], vectors
        self.planes, self.low, self.unit, self.total, self.error = [], [], [], [], []
        for level in range(LEVELS):
            turned = turned @ rotation(dims, level)
            low, high = turned.min(axis=1, initial=0), turned.max(axis=1, initial=0)
            unit = np.where(high > low, (high - low) / (2 ** PLANES - 1), 1.0)
            whole = np.clip(np.rint((turned - low[:, None]) / unit[:, None]), 0, 2 ** PLANES - 1).astype(np.uint8)
            self.planes.append(np.stack([_bits(whole >> b & 1) for b in range(PLANES)], axis=1))
            self.low.append(low)
            self.unit.append(unit)
            self.total.append(whole.sum(axis=1, dtype=np.int64))
            self.error.append(np.abs(turned - low[:, None] - unit[:, None] * whole).sum(axis=1))

    def product(self, a, level: int, shared: np.ndarray, ones: np.ndarray, dims: int) -> np.ndarray:
        """Inner product with the signs of a code, from the bits it shares with the planes and its own ones."""
        return self.unit[level][a] * (2 * shared - self.total[level][a]) + self.low[level][a] * (2 * ones - dims)


def _shared(codes: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Bits shared by codes (..., word) and planes (..., plane, word), each plane with its weight."""
    total = 0
    for b in range(PLANES):
        total = total + (np.bitwise_count(codes & planes[..., b, :]).sum(axis=-1, dtype=np.int64) << b)
    return total


def _interval(asked: Asked, rows: Block, a, r, level: int, shared, before, slip):
    """(estimate, rounding error so far, lower, upper) of the scores of anchors ``a`` with rows ``r``."""
    product = asked.product(a, level, shared, rows.ones[r, level], rows.dims)
    error = asked.error[level][a]
    aligned, norm = rows.aligned[r, level], asked.norms[a]
    estimate, slip = before + aligned * product, slip + aligned * error
    along = np.maximum(np.abs(product) - error, 0) ** 2 / max(rows.dims, 1)
    width = slip + rows.residual[r, level] * np.sqrt(np.maximum(norm ** 2 - along, 0)) + SLACK * norm * rows.norms[r]
    lower, upper = (np.clip(x, -2.0 ** 63, 2.0 ** 63) for x in (estimate - width, estimate + width))
    unclear = np.isnan(lower) | np.isnan(upper)
    return estimate, slip, np.where(unclear, -np.inf, lower), np.where(unclear, np.inf, upper)


def _score(asked: Asked, rows: Block, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whole-number inner products of the pairs. Sums below 2^53 are whole in double precision; beyond 64 bits they are held at the bounds."""
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), SCORED):
        x, y = asked.vectors[a[s:s + SCORED]], rows.vectors[r[s:s + SCORED]]
        if np.max(asked.norms[a[s:s + SCORED]] * rows.norms[r[s:s + SCORED]], initial=0) < 2 ** 53:
            out[s:s + SCORED] = np.einsum("ij,ij->i", x, y)
        else:
            out[s:s + SCORED] = [max(-2 ** 63, min(2 ** 63 - 1, sum(int(p) * int(q) for p, q in zip(u, v)))) for u, v in zip(x, y)]
    return out


def _kth(anchors: int, a: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each anchor, minus infinity where it has fewer."""
    order = np.lexsort((-values, a))
    a, values = a[order], values[order]
    starts = np.searchsorted(a, np.arange(anchors))
    out = np.full(anchors, -np.inf)
    there = starts + k - 1 < np.searchsorted(a, np.arange(anchors), "right")
    out[there] = values[starts[there] + k - 1]
    return out


def _surviving(asked: Asked, rows: Block, wanted: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose interval ``keep(a, lower, upper)`` lets pass at every level.

    ``wanted`` says which pairs are of interest at all."""
    shared = _shared(rows.codes[None, :, 0], asked.planes[0][:, None])
    every = np.arange(len(rows.ids))[None]
    estimate, slip, lower, upper = _interval(asked, rows, np.arange(len(asked.norms))[:, None], every, 0, shared, 0.0, 0.0)
    a, r = np.nonzero(wanted)
    estimate, slip, lower, upper = (x[a, r] for x in (estimate, np.broadcast_to(slip, estimate.shape), lower, upper))
    for level in range(LEVELS):
        if level:
            shared = _shared(rows.codes[r, level], asked.planes[level][a])
            estimate, slip, low, high = _interval(asked, rows, a, r, level, shared, estimate, slip)
            lower, upper = np.maximum(lower, low), np.minimum(upper, high)
        ok = keep(a, lower, upper)
        a, r, estimate, slip, lower, upper = (x[ok] for x in (a, r, estimate, slip, lower, upper))
    return a, r


def _best(a: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best pairs of each anchor: highest score first, then the smaller id."""
    order = np.lexsort((ids, -scores, a))
    nth = np.arange(len(order)) - np.searchsorted(a[order], a[order])
    return order[nth < k]


def _by_dims(rows: pd.DataFrame, anchors: pd.DataFrame):
    """Anchors in strips, each with the block of rows of its dimension."""
    for dims, some in anchors.groupby("dims", sort=True):
        same = rows[rows["dims"] == dims]
        if len(same):
            block = Block(same)
            some = some.sort_values(["label", "vec_id"])
            for s in range(0, len(some), STRIP):
                yield block, some.iloc[s:s + STRIP]


def _positives(k: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, strip in _by_dims(rows, anchors):
            # Rows of the labels in the strip; anchors are sorted by label, so these are few.
            inside = np.isin(block.labels, strip["label"].unique())
            if not inside.any():
                continue
            part, ask = _part(block, inside), Block(strip)
            asked = Asked(ask.vectors)
            wanted = (ask.labels[:, None] == part.labels) & (ask.ids[:, None] != part.ids)
            reach = lambda a, lower, upper, n=len(ask.ids): upper >= _kth(n, a, lower, k)[a]
            a, r = _surviving(asked, part, wanted, reach)
            scores = _score(asked, part, a, r)
            best = _best(a, part.ids[r], scores, k)
            out.append(pd.DataFrame({"anchor_id": ask.ids[a[best]], "other_id": part.ids[r[best]], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({c: np.array([], np.int64) for c in ("anchor_id", "other_id", "score")})

    return find


def _part(block: Block, chosen: np.ndarray) -> Block:
    out = object.__new__(Block)
    out.dims = block.dims
    for name in ("ids", "labels", "vectors", "codes", "norms", "aligned", "residual", "ones"):
        setattr(out, name, getattr(block, name)[chosen])
    return out


def _negatives(k: int, low: int, high: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, strip in _by_dims(rows, anchors):
            ask = Block(strip)
            asked = Asked(ask.vectors)
            # Different positive scores of each anchor: bounds that a whole number within them has.
            windows = [[(-(-low * p // 100), high * p // 100, p) for p in map(int, ps)] for ps in strip["scores"]]
            most = max(map(len, windows))
            floor, ceiling = np.full((len(windows), most), np.inf), np.full((len(windows), most), -np.inf)
            for i, ws in enumerate(windows):
                for j, (least, top, _) in enumerate(ws):
                    floor[i, j], ceiling[i, j] = least, top

            def inside(a, lower, upper):
                ok = np.zeros(len(a), bool)
                for j in range(most):
                    least, top = floor[a, j], ceiling[a, j]
                    sure = (lower >= least) & (upper <= top)
                    reach = np.maximum(least, _kth(len(windows), a[sure], lower[sure], k)[a])
                    ok |= (upper >= reach) & (lower <= top)
                return ok

            a, r = _surviving(asked, block, ask.labels[:, None] != block.labels, inside)
            scores = _score(asked, block, a, r)
            for j in range(most):
                least, top = (np.array([w[j][i] if j < len(w) else 1 - i for w in windows])[a] for i in (0, 1))
                fits = (scores >= least) & (scores <= top)
                x, y, found = a[fits], r[fits], scores[fits]
                best = _best(x, block.ids[y], found, k)
                positive = np.array([w[j][2] if j < len(w) else 0 for w in windows], np.int64)
                out.append(pd.DataFrame({
                    "anchor_id": ask.ids[x[best]], "positive_score": positive[x[best]], "other_id": block.ids[y[best]], "score": found[best]}))
        return pd.concat(out) if out else pd.DataFrame(
            {c: np.array([], np.int64) for c in ("anchor_id", "positive_score", "other_id", "score")})

    return find


def encoded(vectors: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """The rows that take part, one per id, with their codes."""
    x = F.col(vector_col)
    finite = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) * SCALE == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.struct(F.col(label_col).cast("long").alias("label"), x.cast("array<double>").alias("vector")).alias("v"))
    single = rows.groupBy("vec_id").agg(F.max("anchor").alias("anchor"), F.min("v").alias("v"))
    return single.select("vec_id", "v.label", "anchor", "v.vector").mapInPandas(_coded, CODED)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components are floored multiples of 1/``SCALE``. An anchor's positives are
    its best other rows of its label; for each, its negatives are the best rows
    of other labels whose score lies between ``low`` and ``high`` percent of the
    positive's. Equal scores come by the smaller id. Fewer are returned where
    there are fewer; anchors without a positive give no rows, nor does a
    negative positive score.

    Rows without an id, a label or a vector, or with a component that is null or
    not finite, take no part. Of rows of one id the one with the smallest label,
    then vector, stands for all. Vectors of different lengths don't meet. A
    score beyond 64 bits is held at the bounds. Other columns are not read.
    """
    ws = Workspace(vectors.sparkSession)
    coded = ws.save(encoded(vectors, anchors, id_col, label_col, vector_col), "codes")
    counts = coded.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, sides = max(1, -(-counts["rows"] // ROW_BLOCK)), max(1, -(-counts["anchors"] // ANCHOR_BLOCK))
    block, side = (F.pmod(F.xxhash64("vec_id", F.lit(s)), F.lit(n)).cast("int") for s, n in ((1, blocks), (2, sides)))
    rows = coded.withColumn("block", block).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))

    def meet(asking: DataFrame, find, schema: str) -> DataFrame:
        dealt = asking.withColumn("side", side).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        # Columns of their own: both sides come from one table.
        dealt = dealt.select(*(F.col(c).alias(c) for c in dealt.columns))
        return rows.groupBy("block", "side").cogroup(dealt.groupBy("block", "side")).applyInPandas(find, schema)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id"))
        return found.withColumn("rank", nth).filter(F.col("rank") <= k)

    asking = coded.filter("anchor")
    own = ws.save(first(meet(asking, _positives(positives), SCORES), ["anchor_id"], positives).select(
        "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = own.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score"), False).alias("scores"))
    other = first(
        meet(asking.join(windows, "vec_id"), _negatives(negatives, low, high), "anchor_id long, positive_score long, other_id long, score long"),
        ["anchor_id", "positive_score"], negatives)
    return own.join(other, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
