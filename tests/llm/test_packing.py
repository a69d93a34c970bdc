from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tracemill.llm import packing

TEXTS = [
    None, "", " ", "a", " lead", "trail ", "two  blanks", "line\nbreak it's 12 3", "é ü ß 漢字 😀 \u00a0x", "tab\there", "word " * 3000,
    "x\r\n y", "don't we'll 'tis", "a" * 5000, "repeat me", "repeat me", "\u3000wide \u2003em", "1 2 3.5 %%% $$$ a%%% b***",
    "hello <|endoftext|> world", "<|endoftext|>start", "end <|endoftext|>", "<|endoftext|><|endoftext|> twice",
    "word " * 1022 + "<|endoftext|>" + " and" * 1023 + "<|endoftext|>", "<|endoftext",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_give_the_ids_of_the_tokenizer(tokenizer):
    words = packing.Words()
    for text in TEXTS:
        assert np.frombuffer(words.ids(text or ""), "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_pieces_and_places(docs, tokenizer):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (None, "no id")]
    out = packing.pack(docs(rows)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == {i for i, _ in rows} and len(by_doc[3]) == 2
    for i, text in rows:
        ids = ids_of(tokenizer, text)
        pieces = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i]})
        assert pieces[0][1] == 0 and sum(p[2] for p in pieces) == len(ids)
        assert all(p[2] == 1024 for p in pieces[1:]) and (len(pieces) > 1) == (len(ids) > 1024)
        for _, start, length, crc in pieces:
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
    for places in by_sequence.values():
        at = 0
        for r in sorted(places, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


def test_groups_merge_up_the_tree(docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 300)
    rng = np.random.default_rng(1)
    rows = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(1, 900, 1500))]
    out = packing.pack(docs(rows)).collect()
    used, total = len({r["sequence_id"] for r in out}), sum(r["length"] for r in out)
    assert len(out) == 1500 and used <= 1.02 * -(-total // 1024)


def test_best_fit_is_close_to_the_bound_and_large_items_stay_alone():
    sizes = np.random.default_rng(2).integers(1, 1000, 3000)
    bins = packing.best_fit(sizes, 1024)
    assert sorted(i for b in bins for i in b) == list(range(3000)) and all(sizes[b].sum() <= 1024 for b in bins)
    assert len(bins) <= 1.01 * -(-int(sizes.sum()) // 1024)
    assert len(packing.best_fit(np.full(50, 600), 1024)) == 50


def test_empty_table(docs):
    assert packing.pack(docs([])).count() == 0
