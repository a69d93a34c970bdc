from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from tracemill.llm import secrets

HEX = "0123456789abcdef01234567"
ROWS = [
    (1, None), (2, ""), (3, f'token = "{HEX}" and é {HEX}'), (4, "token=token:abcdefgh"), (5, "PassWord: abcdef api_key=1234567"),
    (6, "AKIA" + "A" * 15), (7, "x AKIA" + "A" * 16 + "b"), (8, f'token = "{HEX}" and é {HEX}'), (9, "secret='a'" * 3000 + "passwd=123456"),
    (10, "tokens = abcdefg, apikey:abc=defg\nsecret\n=abcdefg"), (11, "\U0001f600 token=abcdefgh"), (None, "apiKey='Zz9999'"),
]


def plain(text):
    text = text or ""
    found = []
    rules = [
        ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for rank, (kind, pattern, ok) in enumerate(rules):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text) if ok(m)]
    spans = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))
    return tuple(sum(f[3] == k for f in found) for k in ("assign", "access", "hex")) + (hashlib.sha256(spans.encode()).hexdigest(), spans)


def test_spans_equal_those_of_plain_code(docs):
    out = secrets.digest(secrets.scan(docs(ROWS))[0]).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(repr((i, *plain(t))) for i, t in ROWS)


def test_repeated_rows_and_empty_table(docs):
    assert secrets.scan(docs([]))[0].count() == 0
    out = secrets.digest(secrets.scan(docs([(1, "token=abcdef")] * 3))[0]).collect()
    assert len(out) == 3 and {r["spans"] for r in out} == {"assign:0:12"}


def test_the_ledger_spares_what_was_scanned(docs):
    first, entries = secrets.scan(docs(ROWS))
    assert entries.count() == len({t or "" for _, t in ROWS})
    again, none = secrets.scan(docs(ROWS + [(20, "token=zzzzzz")]), ledger=entries)
    assert none.count() == 1
    rows = lambda df: sorted(repr(tuple(r)) for r in secrets.digest(df).collect())
    assert set(rows(first)) < set(rows(again)) and len(rows(again)) == len(ROWS) + 1


def test_a_new_rule_version_scans_every_blob_under_that_rule(docs):
    _, entries = secrets.scan(docs(ROWS))
    rules = (*secrets.RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]{30,}", 30))
    found, more = secrets.scan(docs(ROWS), rules=rules, ledger=entries)
    assert {tuple(r["scanned"]) for r in more.collect()} == {("hex@2",)}
    assert found.filter(F.exists("spans", lambda s: s["kind"] == "hex")).count() == 0
    assert found.filter(F.exists("spans", lambda s: s["kind"] == "assign")).count() > 0


def test_redaction_masks_overlaps_once(docs):
    found, _ = secrets.scan(docs(ROWS))
    out = {r["doc_id"]: r["t"] for r in found.join(docs(ROWS).select("doc_id", "text"), "doc_id").select(
        "doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert out[3] == '[REDACTED]" and é [REDACTED]'
    assert out[4] == "token=token:abcdefgh" and out[1] is None
    assert out[11] == "\U0001f600 [REDACTED]"
