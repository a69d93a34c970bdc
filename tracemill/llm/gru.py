"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its embedding (one shared row for words that training did not
see often enough) next to the mean of the embeddings of its hashed character
trigrams. Windows of words run through one gated recurrent layer in either
direction; attention weights over the positions pool the states, and a linear
layer turns the pooled state into a logit.
"""

from __future__ import annotations

import numpy as np

WORD, CHAR, HIDDEN, ATTEND = 12, 12, 8, 8
BUCKETS = 4096
ROWS = 1024  # words or windows in one product
EDGE = b".,;:!?()[]{}<>|\"'`*%#$&@~^_=+-/\\"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of every word with its borders, and where each word's begin."""
    framed = b"".join(b"<%b>" % w for w in words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(framed, np.uint8).astype(np.uint32)
    ends = np.cumsum(sizes)
    if len(data) < 3:
        data = np.pad(data, (0, 3))
    code = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA77) ^ data[2:] * np.uint32(0xC2B2AE3D))
    code ^= code >> np.uint32(15)
    own = np.ones(len(code), bool)
    cuts = ends[:-1]
    for back in (1, 2):
        at = cuts - back
        own[at[(at >= 0) & (at < len(own))]] = False
    number = np.maximum(sizes - 2, 0)
    grams = (code % BUCKETS).astype(np.int64)[own][: int(number.sum())]
    return grams, np.concatenate([[0], np.cumsum(number)[:-1]]).astype(np.int64)


def _sig(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Model:
    def __init__(self, vocabulary: dict[bytes, int], log_odds: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = lambda *s, scale=0.3: (rng.standard_normal(s) * scale).astype(np.float32)
        d = WORD + CHAR
        self.vocabulary = vocabulary  # word -> row; row 0 is for all others
        self.p = {
            "word": size(len(vocabulary) + 1, WORD, scale=0.05), "char": size(BUCKETS, CHAR, scale=0.1),
            "w": size(2, d, 3 * HIDDEN), "u": size(2, HIDDEN, 3 * HIDDEN), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "a": size(2 * HIDDEN, ATTEND), "ab": np.zeros(ATTEND, np.float32), "v": size(ATTEND),
            "o": size(2 * HIDDEN), "ob": np.zeros(1, np.float32),
        }
        # What the training texts say about a word alone is where its embedding starts.
        self.p["word"][:, 0] = log_odds
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    # Inputs ---------------------------------------------------------------
    def inputs(self, words: list[bytes]):
        stripped = [w.strip(EDGE) or w for w in words]
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in stripped), np.int64, len(words))
        grams, starts = trigrams(stripped)
        counts = np.diff(np.append(starts, len(grams)))
        return rows, grams, starts, counts

    def embed(self, found) -> np.ndarray:
        rows, grams, starts, counts = found
        chars = np.add.reduceat(self.p["char"][grams], starts, axis=0) / counts[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][rows], chars], 1)

    def gates(self, words: list[bytes]) -> np.ndarray:
        """The input side of the gates of either direction: (words, 2, 3 HIDDEN)."""
        x = self.embed(self.inputs(words))
        out = np.empty((len(words), 2, 3 * HIDDEN), np.float32)
        # Products of one shape give a word the same numbers in any company.
        block = np.zeros((ROWS, x.shape[1]), np.float32)
        for at in range(0, len(words), ROWS):
            n = min(ROWS, len(words) - at)
            block[:n] = x[at:at + n]
            for k in (0, 1):
                out[at:at + n, k] = (block @ self.p["w"][k])[:n] + self.p["b"][k]
        return out

    # Windows --------------------------------------------------------------
    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """gates (time, n, 2, 3 HIDDEN) and mask (time, n) to logits (n,)."""
        steps, n = mask.shape
        u = self.p["u"]
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        trail = []
        for t in range(steps):
            x = np.stack([gates[t, :, 0], gates[steps - 1 - t, :, 1]])
            m = np.stack([mask[t], mask[steps - 1 - t]])[:, :, None]
            hu = h @ u
            zr = _sig(x[..., : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            c = np.tanh(x[..., 2 * HIDDEN:] + r * hu[..., 2 * HIDDEN:])
            new = h + m * (1 - z) * (c - h)
            if keep:
                trail.append((h, m, z, r, c, hu))
            h = new
            states[t, :, :HIDDEN] = h[0]
            states[steps - 1 - t, :, HIDDEN:] = h[1]
        e = np.tanh(states @ self.p["a"] + self.p["ab"])
        s = np.where(mask, e @ self.p["v"], np.float32(-1e9))
        w = np.exp(s - s.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, states)
        logit = pooled @ self.p["o"] + self.p["ob"][0]
        return (logit, (gates, mask, states, e, w, pooled, trail)) if keep else logit

    def backward(self, d_logit: np.ndarray, kept):
        """Gradients of the parameters behind the gates, and of the gates."""
        gates, mask, states, e, w, pooled, trail = kept
        g = {"o": pooled.T @ d_logit, "ob": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["o"]
        d_w = np.einsum("nh,tnh->tn", d_pooled, states)
        d_s = w * (d_w - (w * d_w).sum(0)) * mask
        g["v"] = np.einsum("tn,tnk->k", d_s, e)
        d_e = d_s[:, :, None] * self.p["v"] * (1 - e * e)
        g["a"] = np.einsum("tnh,tnk->hk", states, d_e)
        g["ab"] = d_e.sum((0, 1))
        d_states = w[:, :, None] * d_pooled + d_e @ self.p["a"].T
        steps = len(trail)
        d_gates, d_u = np.zeros_like(gates), np.zeros_like(self.p["u"])
        d_h = np.zeros_like(trail[0][0])
        u_t = self.p["u"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            h, m, z, r, c, hu = trail[t]
            d_h = d_h + np.stack([d_states[t, :, :HIDDEN], d_states[steps - 1 - t, :, HIDDEN:]])
            d_c = d_h * m * (1 - z) * (1 - c * c)
            d_z = -d_h * m * (c - h) * z * (1 - z)
            d_r = d_c * hu[..., 2 * HIDDEN:] * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_c], -1)
            d_hu = np.concatenate([d_z, d_r, d_c * r], -1)
            d_u += h.transpose(0, 2, 1) @ d_hu
            d_h = d_h * (1 - m * (1 - z)) + d_hu @ u_t
            d_gates[t, :, 0] += d_x[0]
            d_gates[steps - 1 - t, :, 1] += d_x[1]
        g["u"] = d_u
        return g, d_gates

    def learn(self, words: list[bytes], places: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float):
        """One step on windows: places (time, n) index into words."""
        found = self.inputs(words)
        rows, grams, starts, counts = found
        x = self.embed(found)
        gates = np.stack([x @ self.p["w"][k] + self.p["b"][k] for k in (0, 1)], 1)
        logit, kept = self.forward(gates[places], mask, keep=True)
        g, d_gates = self.backward(((_sig(logit) - y) * weight / weight.sum()).astype(np.float32), kept)
        flat = np.zeros_like(gates)
        np.add.at(flat, places.ravel(), (d_gates * mask[:, :, None, None]).reshape(-1, 2, 3 * HIDDEN))
        g["w"] = np.stack([x.T @ flat[:, k] for k in (0, 1)])
        g["b"] = flat.sum(0)[:, None, :]
        d_x = sum(flat[:, k] @ self.p["w"][k].T for k in (0, 1))
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], rows, d_x[:, :WORD])
        np.add.at(g["char"], grams, np.repeat(d_x[:, WORD:] / counts[:, None].astype(np.float32), counts, axis=0))
        self.steps += 1
        for k, d in g.items():
            one, two = self.moments[k]
            one += 0.1 * (d - one)
            two += 0.01 * (d * d - two)
            self.p[k] -= rate * (one / (1 - 0.9**self.steps)) / (np.sqrt(two / (1 - 0.99**self.steps)) + 1e-7)
        return logit
