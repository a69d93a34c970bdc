from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracemill.llm import bpe, queries

TEXTS = [
    None, "", " ", "  ", "a", " lead", "trail ", "trail  ", "two  blanks", "line\nbreak it's 12 3", "\n\n a\n b", "é ü ß 漢字 😀  x",
    "tab\there", "x\r\n y", "don't we'll 'tis '' 's", "a" * 5000, "ab" * 3000, "repeat me", "repeat me", "　wide  em",
    "1 2 3.5 %%% $$$ a%%% b***", "<|endoftext|>", "hello <|endoftext|> world", "<|endoftext|><|endoftext|>x", "x<|endoftext|>",
    "<|endoftext", "a <|endoftext|>  b", "0123456789abcdef" * 64, "=" * 333, "\x00\x01", "ȩ́", "﻿bom",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary(None)


def ids(words, text):
    return np.frombuffer(words.ids([text])[0], "<i4").tolist()


@lru_cache
def tables(words):
    return {b: i for i, b in words.bytes.items() if len(b) == 1 and i not in words.made}, {
        (a, b): i for i, (a, b, _) in words.made.items()}


def text_of(words, some):
    return words.texts(np.array(some, np.int64), np.array([len(some)]))[0]


def merged(words, word):
    """Plain merging: the lowest rank first, of these the leftmost."""
    byte, makes = tables(words)
    found = [byte[bytes([b])] for b in word]
    while len(found) > 1:
        rank, at = min((words.merge.get(p, 10**9), i) for i, p in enumerate(zip(found, found[1:])))
        if rank == 10**9:
            break
        found[at:at + 2] = [makes[found[at], found[at + 1]]]
    return found


def test_ids_and_texts_of_the_library(words, library):
    for text in TEXTS:
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert ids(words, text or "") == wanted, text
        assert text_of(words, wanted) == library.decode(wanted, skip_special_tokens=False)
    for some in ([50256, 220, 50256], [447, 247], [447], [97, 447, 98]):
        assert text_of(words, some) == library.decode(some, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcdehinorst ABC'’\n\t  .,-_=019éß漢😀"), max_size=60))
def test_any_text(words, library, text):
    assert ids(words, text) == library.encode(text, add_special_tokens=False).ids


def test_last_tokens_are_those_of_plain_merging(words):
    rng = np.random.default_rng(0)
    alphabet = [*"aaabbcdeerstin-=\0", "é"]
    some = {"".join(rng.choice(alphabet, int(rng.integers(1, 40)))).encode()[:bpe.TOGETHER] for _ in range(200)}
    some = sorted({*some, b"a", b"ab", b"ab\0", b"ab\0\0", b"\0"})
    for word, together in zip(some, words.many_word_ids(some), strict=True):
        assert words.word_ids(word) == together
        assert np.frombuffer(together, "<i4").tolist() == merged(words, word)


def test_pairs_by_their_own_bytes(words):
    rng = np.random.default_rng(1)
    tokens = [i for i in words.bytes if i not in words.added.values()]
    text = lambda *i: b"".join(words.bytes[x] for x in i)
    makes = {i: (a, b) for i, (a, b, _) in words.made.items()}
    pairs = [*rng.choice(tokens, (400, 2)).tolist(), *(makes[int(i)] for i in rng.choice(list(makes), 100))]
    for a, b in pairs:
        if words.whole(a):
            assert words.compatible(a, b) == (merged(words, text(a, b)) == [a, b])
    for i in rng.choice(tokens, 200).tolist():
        assert words.whole(i) == (merged(words, text(i)) == [i])


def test_rows(spark, docs, library):
    rows = [*enumerate(TEXTS), (3, "again"), (None, "no id"), (99, "word " * 200_000)]
    frame = docs(rows)
    coded = bpe.encode(frame)
    assert coded.columns == ["doc_id", "ids"]
    back = bpe.decode(coded).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    wanted = sorted(((i, t or "") for i, t in rows), key=key)
    got = sorted(((r["doc_id"], r["text"]) for r in back), key=key)
    assert got == wanted
    assert sorted(((r["doc_id"], r["text"]) for r in bpe.encode_decode(frame).collect()), key=key) == wanted
    by_text = {r["text"]: r["ids"] for r in back}
    for _, text in rows:
        assert by_text[text or ""] == library.encode(text or "", add_special_tokens=False).ids
    assert bpe.decode(bpe.encode(docs([]))).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [10**9, None, 64])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(odd).collect()} == {1: "", 2: words_of(64)}


def words_of(*some):
    return text_of(bpe.vocabulary(None), some)


def test_the_query_on_the_given_documents(spark, library):
    found = {r["doc_id"]: r for r in queries.op12_bpe_codec(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(found)
    for r in rows:
        wanted = library.encode(r["text"] or "", add_special_tokens=False).ids
        got = found[r["doc_id"]]
        assert (got["n_tokens"], got["ids_sha256"], got["decoded_sha256"]) == (
            len(wanted), sha(",".join(map(str, wanted))), sha(library.decode(wanted, skip_special_tokens=False)))


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
