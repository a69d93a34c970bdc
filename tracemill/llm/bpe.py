"""Byte-level BPE by dynamic programming over prefixes, and its inverse.

Any prefix of a word has one encoding, so it has one last token. Tokens that end
at a prefix come from an automaton over the whole vocabulary (its suffix links
give them longest first). The one among them that the encoding of the shorter
prefix before it can precede is the last token of the prefix: a token sequence
is an encoding exactly if each two neighbours are the encoding of their own
bytes. Back-pointers from the end of the word give its ids. Work is linear in a
word, however long it is. The last token depends on the prefix alone, so the new
words of a batch are sorted and every prefix that they share is looked at once,
all prefixes of one length together.

Two tokens can stand side by side if no merge across their border comes up
while both are built. Only tokens on the right edge of the left one and the
left edge of the right one ever touch the border; each is there from its own
merge to the merge that takes it in, so a walk along both edges decides.

Vocabulary files are those of the ``tokenizers`` library with a byte-level BPE
and no normalizer. Added tokens are cut out of a text before it is split into
words, as there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
CACHE_WORDS = 200_000      # words, and pieces between blanks, that a task keeps ids of
CACHE_PAIRS = 500_000      # pairs of tokens that a task keeps verdicts of
LONGEST_CACHED = 256       # characters
TOGETHER = 64              # bytes of a word up to which it is encoded together with others
BATCH_BYTES = 4 << 20      # of texts, for one batch of results

# Fixed value: how byte-level vocabularies of this kind split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones for themselves, the rest from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    return letters


class Vocabulary:
    """Tokens, merges and the automaton over them. Ids of texts and words are little-endian 32-bit numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        known = (
            model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and not spec["normalizer"] and not model.get("dropout")
            and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if not known or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        letters = byte_letters()
        self.added, ids = added, model["vocab"]
        self.bytes: dict[int, bytes] = {i: t.encode() for t, i in added.items()}
        for token, i in ids.items():
            if token not in added:
                self.bytes[i] = bytes(map(letters.__getitem__, token))
        # How each token is made, at which rank, and what each pair makes at which rank.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            if whole in self.made or any(len(t) > 1 and ids[t] not in self.made for t in (left, right)):
                raise ValueError(f"{path}: merge {rank} makes a token twice or before its parts")
            self.made[whole], self.merge[a, b] = (a, b, rank), rank
        self._build_automaton()
        self._words = regex.compile(WORDS)
        self._added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self._apart = regex.compile(r"\s\s| $")
        self._pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._seen: dict[str, bytes] = {}   # ids of words
        self._after: dict[str, bytes] = {}  # ids of what stands between two blanks, with the one before it

    def _build_automaton(self) -> None:
        """A tree over the bytes of all tokens, and from each state the state of its longest proper suffix in the tree."""
        self._goto: dict[int, int] = {}  # state << 8 | byte: next state
        self._ends: list[tuple[tuple[int, int], ...]] = [()]  # by state: (token, size) of the tokens it ends with
        self._suffix = [0]
        for i, word in self.bytes.items():
            if i in self.made or len(word) == 1:
                state = 0
                for byte in word:
                    state = self._goto.setdefault(state << 8 | byte, len(self._ends))
                    if state == len(self._ends):
                        self._ends.append(())
                        self._suffix.append(0)
                self._ends[state] = ((i, len(word)),)
        below: list[list[tuple[int, int]]] = [[] for _ in self._ends]
        for key, state in self._goto.items():
            below[key >> 8].append((key & 255, state))
        level = [0]
        while level:
            following = []
            for state in level:
                for byte, child in below[state]:
                    if state:
                        self._suffix[child] = self._step(self._suffix[state], byte)
                    self._ends[child] += self._ends[self._suffix[child]]
                    following.append(child)
            level = following
        keys = np.array(sorted(self._goto), np.int64)
        self._keys, self._next = keys, np.array([self._goto[k] for k in keys.tolist()], np.int64)
        self._suffixes = np.array(self._suffix, np.int64)
        self._first = np.cumsum([0, *map(len, self._ends)])
        self._end_token, self._end_size = np.array([e for ends in self._ends for e in ends], np.int64).T
        self._size = np.zeros(max(self.bytes) + 1, np.int64)
        self._size[list(self.bytes)] = [len(b) for b in self.bytes.values()]
        # The bytes of all tokens on end, and where each one's begin.
        self._flat = np.frombuffer(b"".join(self.bytes.values()), np.uint8)
        self._place = np.zeros(len(self._size), np.int64)
        self._place[list(self.bytes)] = np.cumsum([0, *map(len, self.bytes.values())])[:-1]

    def _step(self, state: int, byte: int) -> int:
        """The longest suffix in the tree of a state and one more byte."""
        while True:
            found = self._goto.get(state << 8 | byte)
            if found is not None or not state:
                return found or 0
            state = self._suffix[state]

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, float, float]]:
        """Tokens at one edge of ``token``, first the largest: (token, rank it is made at, rank it is taken in at)."""
        until = float("inf")
        while token in self.made:
            rank = self.made[token][2]
            yield token, rank, until
            token, until = self.made[token][side], rank
        yield token, -1.0, until

    def _touch(self, left: int, right: int) -> bool:
        """True if both tokens stay when they stand side by side."""
        rights = list(self._edge(right, 0))
        at = 0
        for x, made_x, until_x in self._edge(left, 1):
            # What stands on the right while x is on the left, from the latest on.
            while at < len(rights) and rights[at][1] >= until_x:
                at += 1
            for y, made_y, until_y in rights[at:]:
                rank = self.merge.get((x, y))
                # Of two merges of one rank the one further left comes first.
                if rank is not None and max(made_x, made_y) < min(until_x, until_y) and rank < until_x and rank <= until_y:
                    return False
                if made_y < made_x:
                    break
        return True

    def whole(self, token: int) -> bool:
        """True if the bytes of the token are encoded as the token."""
        found = self._whole.get(token)
        if found is None:
            if token not in self.made:
                found = True
            else:
                # Both parts come up by themselves, and nothing else across their border before they merge.
                left, right, rank = self.made[token]
                found = self.whole(left) and self.whole(right) and self._first_across(left, right) == rank
            self._whole[token] = found
        return found

    def _first_across(self, left: int, right: int) -> int | None:
        """Rank of the first merge across the border of two tokens that are built side by side."""
        ranks = []
        for x, made_x, until_x in self._edge(left, 1):
            for y, made_y, until_y in self._edge(right, 0):
                rank = self.merge.get((x, y))
                if rank is not None and max(made_x, made_y) < min(until_x, until_y) and rank < until_x and rank <= until_y:
                    ranks.append(rank)
        return min(ranks, default=None)

    def compatible(self, left: int, right: int) -> bool:
        """True if the encoding of both tokens' bytes is these two tokens; ``left`` is known to encode itself."""
        found = self._pairs.get(left << 32 | right)
        if found is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            found = self._pairs[left << 32 | right] = self.whole(right) and self._touch(left, right)
        return found

    def word_ids(self, word: bytes) -> bytes:
        """Ids of one word: the last token of every prefix, then back from the end."""
        last, sizes, state = [-1], [0], 0
        for end, byte in enumerate(word, 1):
            state = self._step(state, byte)
            for token, size in self._ends[state]:
                if self.whole(token) if size == end else self.compatible(last[end - size], token):
                    last.append(token)
                    sizes.append(size)
                    break
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= sizes[at]
        return np.array(out[::-1], "<i4").tobytes()

    def _steps(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """``_step`` of many states at once."""
        out, open_ = np.zeros(len(states), np.int64), np.arange(len(states))
        states = states.copy()
        while len(open_):
            keys = states[open_] << 8 | letters[open_]
            at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            hit = self._keys[at] == keys
            out[open_[hit]] = self._next[at[hit]]
            open_ = open_[~hit & (states[open_] > 0)]
            states[open_] = self._suffixes[states[open_]]
        return out

    def _fit(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Which tokens can follow the ones before them (-1: none is before)."""
        known = self._pairs.get
        found = [known(b << 32 | t) if b >= 0 else self.whole(t) for b, t in zip(before.tolist(), tokens.tolist())]
        for i, verdict in enumerate(found):
            if verdict is None:
                found[i] = self.compatible(int(before[i]), int(tokens[i]))
        return np.array(found, bool)

    def many_word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of sorted, different words of at most ``TOGETHER`` bytes: one step of the walk for all of them."""
        sizes = np.array([len(w) for w in words])
        letters = np.frombuffer(b"".join(w.ljust(TOGETHER, b"\0") for w in words), np.uint8).reshape(-1, TOGETHER)
        new = np.ones(letters.shape, bool)  # the first word with this prefix
        new[1:] = np.logical_or.accumulate(letters[1:] != letters[:-1], axis=1)
        last = np.full((len(words), int(sizes.max(initial=0)) + 1), -1, np.int64)
        states = np.zeros(len(words), np.int64)
        for end in range(1, last.shape[1]):
            rows = np.flatnonzero(sizes >= end)
            heads = new[rows, end - 1]
            heads[1:] |= np.diff(rows) > 1
            heads[0] = True
            firsts, group = rows[heads], np.cumsum(heads) - 1
            state = self._steps(states[firsts], letters[firsts, end - 1].astype(np.int64))
            token = np.full(len(firsts), -1, np.int64)
            open_, nth = np.arange(len(firsts)), 0
            while len(open_):
                at = self._first[state[open_]] + nth
                tokens = self._end_token[at]
                fits = self._fit(last[firsts[open_], end - self._end_size[at]], tokens)
                token[open_[fits]] = tokens[fits]
                open_, nth = open_[~fits], nth + 1
            last[rows, end], states[rows] = token[group], state[group]
        backwards, at = [], sizes.copy()
        while (left := np.flatnonzero(at)).size:
            token = np.full(len(words), -1, np.int64)
            token[left] = last[left, at[left]]
            at[left] -= self._size[token[left]]
            backwards.append(token)
        table = np.array(backwards[::-1] or [[]], "<i4").T
        flat = table[table >= 0].tobytes()
        ends = np.cumsum(4 * (table >= 0).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: set[str]) -> None:
        """Ids of words not seen yet."""
        new = sorted([(w.encode(), w) for w in words if w not in self._seen])
        short = [x for x in new if len(x[0]) <= TOGETHER]
        self._seen.update(zip([w for _, w in short], self.many_word_ids([b for b, _ in short])))
        self._seen.update((w, self.word_ids(b)) for b, w in new if len(b) > TOGETHER)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        cut = []  # of each text: added tokens as ids, the rest as words, and as pieces that follow a blank
        between, words = set(), set()
        for text in texts:
            parts, at = [], 0
            for token in [*self._added.finditer(text), None]:
                plain = text[at:token.start() if token else len(text)]
                if self._apart.search(plain):
                    found, rest = self._words.findall(plain), []
                else:
                    # No word reaches across a blank between two other characters: it is the first one of the next word.
                    first, *rest = plain.split(" ")
                    found = self._words.findall(first)
                    between.update(rest)
                words.update(found)
                parts += [(self._seen, found), (self._after, rest)]
                if token:
                    parts.append(({None: np.array([self.added[token[0]]], "<i4").tobytes()}, [None]))
                    at = token.end()
            cut.append(parts)
        split = {p: self._words.findall(" " + p) for p in between.difference(self._after)}
        for found in split.values():
            words.update(found)
        self._learn(words)
        ids = self._seen.__getitem__
        self._after.update((piece, ids(found[0]) if len(found) == 1 else b"".join(map(ids, found))) for piece, found in split.items())
        out = [b"".join([b"".join(map(known.__getitem__, found)) for known, found in parts]) for parts in cut]
        for cache, new in ((self._seen, words), (self._after, between)):
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            for long in [w for w in new if len(w) > LONGEST_CACHED]:
                cache.pop(long, None)
        return out

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of any ids, those of one text up to its end. Added tokens are text like
        others; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        known = (ids >= 0) & (ids < len(self._size))
        ids = np.where(known, ids, 0)
        sizes = np.where(known, self._size[ids], 0)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        flat = self._flat[np.repeat(self._place[ids] - upto[:-1], sizes) + np.arange(upto[-1])].tobytes()
        stops = upto[ends].tolist()
        return [flat[a:b].decode("utf-8", "replace") for a, b in zip([0, *stops], stops)]


@lru_cache(maxsize=4)
def vocabulary(path: str | None) -> Vocabulary:
    """The vocabulary at ``path``, or that of the installed public tokenizers, wherever this machine has it."""
    return Vocabulary(path or public_tokenizers.path(VOCABULARY))


def _runs(sizes: list[int | None], most: int) -> Iterator[slice]:
    """Slices of rows whose sizes add up to about ``most``."""
    begin, total, stop = 0, 0, 0
    for stop, size in enumerate(sizes, 1):
        total += size or 0
        if total >= most:
            yield slice(begin, stop)
            begin, total = stop, 0
    if stop > begin:
        yield slice(begin, stop)


def _encoder(path: str | None):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for rows in _runs(pc.binary_length(batch.column(1)).to_pylist(), BATCH_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                ids = words.ids([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    return encode


def _decoder(path: str | None):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for rows in _runs(pc.list_value_length(batch.column(1)).to_pylist(), BATCH_BYTES // 4):
                part = batch.slice(rows.start, rows.stop - rows.start)
                sizes = pc.list_value_length(part.column(1)).fill_null(0)
                flat = part.column(1).flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = words.texts(flat, np.cumsum(sizes.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return decode


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(doc_id, ids)``, one row for each row, ids as the ``tokenizers`` library gives them without special tokens.

    A null or empty text has no ids. The text of an added token is that token,
    as in the library. Null ids of documents are kept, repeated rows stay
    repeated, other columns are not read.
    """
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _encoder(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids, text)`` of rows of ``encode``. Null ids give an empty text; null or unknown ids inside add nothing."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path), "doc_id long, ids array<int>, text string")


def encode_decode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``decode(encode(documents))`` with one Python worker a task: texts are made from the ids."""
    there, back = _encoder(path), _decoder(path)
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lambda batches: back(there(batches)), "doc_id long, ids array<int>, text string")
