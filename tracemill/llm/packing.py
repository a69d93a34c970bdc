"""Packing documents into token sequences by hierarchical residual best fit.

Documents are tokenized and cut into pieces of at most ``LENGTH`` tokens; all
pieces of a long document but the first are full and are sequences of their
own. The others are dealt to groups of bounded size by a hash, and each group
packs its own by best fit, longest first. Sequences that are nearly full are
done. Underfull ones become items: groups are merged, eight into one, and
best fit runs again over the underfull sequences, up the tree, until one
group is left or a round saves next to nothing. A sequence that no item of its
group can join goes on; one that is as long as it can get is never opened again.

Token ids come from a byte-level BPE vocabulary file that the caller names. The
fast path reads the same vocabulary as ranks; word by word, with a cache. Added
tokens of the vocabulary are cut out of a text first: their strings are these
tokens, as the ``tokenizers`` library has it.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace

LENGTH = 1024
END_ID = 2
NEARLY_FULL = 4          # free tokens with which a sequence is done
GROUP = 20_000           # items of a group, about
MERGED = 8               # groups that become one
CACHE_WORDS = 300_000    # words that a task keeps ids of
RANKS_FILE = "byte_bpe_50k.tiktoken"  # the vocabulary of VOCABULARY, as ranks
VOCABULARY = "byte_bpe_50k.json"      # names the added tokens


@lru_cache(maxsize=4)
def encoding(path: str | None) -> tiktoken.Encoding:
    """The vocabulary at ``path``, or that of the installed public tokenizers, wherever this machine has it."""
    ranks = {}
    with open(path or public_tokenizers.path(RANKS_FILE), "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def added_tokens(path: str | None) -> dict[str, int]:
    """Added tokens of the vocabulary at ``path``, or of the installed one."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Words(dict):
    """Little-endian ids of a word and of the one blank before it. Words never
    share a token across a single blank between two other characters."""

    _double = regex.compile(r"\s\s| $")

    def __init__(self, path: str | None = None, added: str | None = None):
        super().__init__()
        self.encoding = encoding(path)
        self._added = {} if path and not added else added_tokens(added)
        self._cut = regex.compile("|".join(map(regex.escape, sorted(self._added, key=len, reverse=True))) or "(?!)")

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = np.array(self.encoding.encode_ordinary(" " + word), "<u4").tobytes()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        out, at = [], 0
        for token in self._cut.finditer(text):
            out += [self._plain(text[at:token.start()]), np.array([self._added[token[0]]], "<u4").tobytes()]
            at = token.end()
        return b"".join([*out, self._plain(text[at:])]) if out else self._plain(text)

    def _plain(self, text: str) -> bytes:
        if self._double.search(text):
            return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encoding.encode_ordinary(first), "<u4").tobytes() + b"".join(map(self.__getitem__, rest))


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(path: str | None, added: str | None, length: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path, added)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.ids(text or "") + end
                total = len(ids) // 4
                head = total % length or min(total, length)
                begin, piece = 0, 0
                while begin < total:
                    stop = head if piece == 0 else begin + length
                    rows.append((doc, piece, begin, stop - begin, zlib.crc32(ids[4 * begin:4 * stop])))
                    begin, piece = stop, piece + 1
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)

    return cut


def pieces(documents: DataFrame, id_col: str, text_col: str, vocabulary: str | None, length: int, end_id: int,
           added: str | None = None) -> DataFrame:
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(
        _pieces(vocabulary, added, length, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of item positions: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms: list[int] = []  # rooms of open bins, rising
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
        else:
            room, b = length, len(bins)
            bins.append([i])
        room -= size
        if room > 0:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins


def _pack(length: int, nearly: int):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "item"], kind="stable").reset_index(drop=True)
        sizes, items, members = frame["size"].to_numpy(), frame["item"].to_numpy(), frame["members"].to_numpy()
        rows = []
        for b in best_fit(sizes, length):
            total = int(sizes[b].sum())
            rows.append((int(items[b].min()), total, np.concatenate([members[i] for i in b]), length - total <= nearly))
        return pd.DataFrame(rows, columns=["item", "size", "members", "done"]).assign(group=frame["group"].iloc[0])

    return pack


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         length: int = LENGTH, end_id: int = END_ID, added: str | None = None) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32, sequence_id, offset)``, one row for each piece.

    A null text is empty: its one piece holds the end id alone. Repeated rows
    are packed as often as they come; null ids are kept. Ties are broken by
    position in the written table of pieces. An empty table gives an empty
    result. Other columns are not read. ``vocabulary`` is a file of ranks,
    ``added`` the file that names its added tokens (none for another vocabulary
    without one).
    """
    ws = Workspace(documents.sparkSession)
    cut = ws.save(pieces(documents, id_col, text_col, vocabulary, length, end_id, added), "pieces")
    # The table is written, so its row numbers hold.
    numbered = ws.save(cut.withColumn("item", F.monotonically_increasing_id()), "numbered")
    ws.drop("pieces")
    full = numbered.filter(F.col("length") == length)
    open_ = numbered.filter(F.col("length") < length)
    count = open_.count()
    groups = max(1, -(-count // GROUP))
    items = open_.select(
        F.pmod(F.xxhash64("item"), F.lit(groups)).cast("long").alias("group"), "item", F.col("length").alias("size"), F.array("item").alias("members"))
    done, level, before = [], 0, count
    while True:
        packed = ws.save(
            items.groupBy("group").applyInPandas(
                _pack(length, NEARLY_FULL), "item long, size long, members array<long>, done boolean, group long"),
            f"level{level}")
        done.append(packed.filter("done").select("item", "members"))
        under = packed.filter("not done")
        left = under.count()
        level += 1
        if groups == 1 or not left or left > 0.999 * before:
            done.append(under.select("item", "members"))
            break
        # Fewer groups where fewer items are left, and never larger ones than at the start.
        groups, before = max(1, -(-groups // MERGED), -(-left // GROUP)), left
        items = under.select(
            F.pmod(F.xxhash64("item"), F.lit(groups)).cast("long").alias("group"), "item", "size", "members")
    sequences = reduce(DataFrame.unionByName, done).select(
        F.col("item").alias("sequence"), F.posexplode("members").alias("nth", "item"))
    at = sequences.join(open_, "item")
    # A sequence has at most ``length`` members: offsets are sums inside it.
    member = F.struct("nth", "doc_id", "piece", "start", "length", "ids_crc32")
    walked = F.aggregate(
        F.array_sort(F.collect_list(member)),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(
            "array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>").alias("out")),
        lambda s, m: F.struct(
            (s["at"] + m["length"]).alias("at"),
            F.array_append(s["out"], F.struct(
                m["doc_id"].alias("doc_id"), m["piece"].alias("piece"), m["start"].alias("start"), m["length"].alias("length"),
                m["ids_crc32"].alias("ids_crc32"), s["at"].alias("offset"))).alias("out")),
        lambda s: s["out"])
    packed_rows = at.groupBy("sequence").agg(walked.alias("o")).select(
        (F.col("sequence")).alias("sequence_id"), F.explode("o").alias("o")).select("o.*", "sequence_id")
    # Every sequence is named after one of its pieces, so names don't clash.
    whole = full.select("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"), F.col("item").alias("sequence_id"))
    return whole.unionByName(packed_rows).select(
        F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
