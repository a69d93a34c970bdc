"""Toxicity of whole texts: a recurrent network over all overlapping windows.

The network of ``gru.py`` is fitted on a bounded sample of labelled documents.
A label belongs to a document, toxic words to a few of its windows, so each
epoch scores all windows of the sample and learns from the highest window of
every document (and from one more window of the harmless ones). The highest
logit of a document, calibrated on the sample's labels, is its score.

Scoring is a map over documents: no shuffle, and a task keeps one chunk of
words and a bounded cache of words it has met.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.gru import EDGE, HIDDEN, ROWS, Model, words_of

WINDOW, STRIDE = 32, 16
FIT_TOXIC, FIT_OTHER = 1200, 2400   # labelled documents to fit on, at most (by hash)
FIT_CHARS = 30_000                  # longer labelled texts are left out of the fit
VOCABULARY = 20_000
EPOCHS = 12
CHUNK_WORDS = 60_000
CACHE_WORDS = 200_000


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts laid end to end: (places, mask) of shape (WINDOW, n), and the text of each window."""
    number = np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1
    text = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    begin = np.cumsum(counts) - counts
    at = nth[None, :] * STRIDE + np.arange(WINDOW)[:, None]
    mask = at < counts[text]
    return np.where(mask, at + begin[text], 0), mask, text


def _logits(model: Model, gates: np.ndarray, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows, always in batches of ROWS: a window scores alike in any company."""
    out = np.empty(at.shape[1], np.float32)
    for k in range(0, at.shape[1], ROWS):
        n = min(ROWS, at.shape[1] - k)
        fill = ((0, 0), (0, ROWS - n))
        part, own = np.pad(at[:, k:k + n], fill), np.pad(mask[:, k:k + n], fill)
        own[0, n:] = True
        out[k:k + n] = model.forward(gates[part], own)[:n]
    return out


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> tuple[Model, float, float]:
    """A model and the slope and offset of its calibration. labels holds both 0 and 1."""
    split = [words_of(t) for t in texts]
    split = [w or [b"<none>"] for w in split]
    held = [{w.strip(EDGE) or w for w in ws} for ws in split]
    seen, bad = Counter(), Counter()
    for ws, y in zip(held, labels):
        seen.update(ws)
        if y:
            bad.update(ws)
    common = sorted((w for w in seen if seen[w] >= 3), key=lambda w: (-seen[w], w))[:VOCABULARY]
    n_bad, n = float(labels.sum()), float(len(labels))
    odds = [np.log((bad[w] + 0.2) / (n_bad + 0.4)) - np.log((seen[w] - bad[w] + 0.2) / (n - n_bad + 0.4)) for w in common]
    model = Model({w: i + 1 for i, w in enumerate(common)}, np.clip(np.array([0.0, *odds]), -3, 3).astype(np.float32), seed)
    rng = np.random.default_rng(seed)
    words = [w for ws in split for w in ws]
    at, mask, text = places(np.array([len(w) for w in split]))
    first = np.searchsorted(text, np.arange(len(texts)))
    start_odds = model.p["word"][:, 0]
    unique = sorted(set(words))
    number = {w: i for i, w in enumerate(unique)}
    of_word = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    at = of_word[at].astype(np.int32)  # windows of distinct words from here on
    scores = np.where(mask, start_odds[model.inputs(unique)[0]][at], -9.0).max(0)
    for epoch in range(epochs):
        if epoch:
            scores = _logits(model, model.gates(unique), at, mask)
        jitter = scores + rng.random(len(scores)) * 1e-6
        order = np.lexsort((jitter, text))
        top = order[np.append(first[1:], len(text)) - 1]
        other = first + (rng.random(len(texts)) * np.diff(np.append(first, len(text)))).astype(np.int64)
        chosen = np.concatenate([top, other[labels == 0]])
        y = np.concatenate([labels, np.zeros(int((labels == 0).sum()))]).astype(np.float32)
        shuffled = rng.permutation(len(chosen))
        for k in range(0, len(chosen), 256):
            pick = shuffled[k:k + 256]
            w, local = np.unique(at[:, chosen[pick]], return_inverse=True)
            model.learn([unique[i] for i in w], local.reshape(WINDOW, -1), mask[:, chosen[pick]], y[pick],
                        np.ones(len(pick), np.float32), 0.01 if epoch < epochs * 2 // 3 else 0.003)
    highest = np.maximum.reduceat(_logits(model, model.gates(unique), at, mask), first)
    return model, *_calibrate(highest, labels, weights)


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on x by Newton steps; the slope stays above 0."""
    mean, spread = float(x.mean()), float(x.std() + 1e-6)
    design = np.stack([(x - mean) / spread, np.ones(len(x))], 1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2) * 1e-2
        step = np.linalg.solve(hessian, design.T @ (weight * (y - p)) - 1e-2 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(w[0]), 1e-3) / spread
    return slope, float(w[1]) - slope * mean


class Scorer:
    def __init__(self, model: Model, slope: float, offset: float):
        self.model, self.slope, self.offset = model, slope, offset

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])
        row: dict[bytes, int] = {}
        gates = np.zeros((1 << 14, 2, 3 * HIDDEN), np.float32)
        for batch in batches:
            out = np.empty(batch.num_rows)
            texts: list[int] = []
            split: list[list[bytes]] = []
            size = 0
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py()) or [b"<none>"]
                texts.append(i)
                split.append(words)
                size += len(words)
                if size >= CHUNK_WORDS or i == batch.num_rows - 1:
                    if len(row) > CACHE_WORDS:
                        row.clear()
                    fresh = list({w for ws in split for w in ws if w not in row})
                    if fresh:
                        need = len(row) + len(fresh)
                        if need > len(gates):
                            gates = np.concatenate([gates, np.zeros((max(need - len(gates), len(gates)), 2, 3 * HIDDEN), np.float32)])
                        gates[len(row):need] = self.model.gates(fresh)
                        row.update(zip(fresh, range(len(row), need)))
                    numbers = np.fromiter((row[w] for ws in split for w in ws), np.int64, size)
                    at, mask, text_of = places(np.array([len(ws) for ws in split]))
                    logits = _logits(self.model, gates, numbers[at], mask)
                    first = np.searchsorted(text_of, np.arange(len(split)))
                    out[texts] = np.maximum.reduceat(logits, first)
                    texts, split, size = [], [], 0
            score = 1 / (1 + np.exp(-np.clip(self.slope * out + self.offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], schema=schema)


def held_out(id_: Column) -> Column:
    """Documents that labels are never learned from."""
    return F.pmod(F.crc32(id_.cast("string")), F.lit(5)) == 0


def score(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_toxic: int = FIT_TOXIC, fit_other: int = FIT_OTHER) -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row for each row of documents.

    Only ids and texts are read. Null and empty texts are scored as one window
    of a placeholder word. An id with several labels counts as toxic if one of
    them says so; null labels are left out. Without labels of both kinds every
    score is the share of toxic labels (0 without any). A row with a null id is
    scored, is not held out, and is never learned from; repeated rows are
    scored alike. An empty table gives an empty result.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    marks = marks.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    number = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = number.get(1, 0), number.get(0, 0)
    sample, drawn = [], {}
    if n_bad and n_good:
        part = lambda most, n: int(min(1.0, most / n) * (1 << 20))
        lucky = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20))
        ids = marks.filter(lucky < F.when(F.col("label") == 1, part(fit_toxic, n_bad)).otherwise(part(fit_other, n_good)))
        # About fit_toxic + fit_other ids: small enough to meet the texts where they are.
        sample = docs.join(F.broadcast(ids), "id").filter(F.coalesce(F.char_length("text"), F.lit(0)) <= FIT_CHARS).collect()
        sample.sort(key=lambda r: (r["id"], r["text"] or ""))
        drawn = Counter(r["label"] for r in sample)
    if not drawn.get(0) or not drawn.get(1):
        share = F.lit(n_bad / (n_bad + n_good) if n_bad + n_good else 0.0)
        scored = docs.select("id", share.alias("score"))
    else:
        y = np.array([r["label"] for r in sample])
        weights = np.where(y == 1, n_bad / drawn[1], n_good / drawn[0])
        scorer = Scorer(*fit([r["text"] for r in sample], y, weights / weights.mean()))
        del sample
        scored = docs.mapInArrow(scorer, "id long, score double")
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
