"""Secret scans over a ledger of blobs.

Every version of every text is a blob, named by the SHA-256 of its content. The
ledger says which (blob, rule version) pairs have been scanned and what was
found. A run scans the pairs that the ledger lacks, once for each distinct
blob, appends them to the ledger, and joins the findings back to all rows
(paths, versions, copies) that hold the blob. A new rule version scans every
blob again under that rule alone; a second run over the same texts scans
nothing.

All of it is column expressions; offsets are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace


def either_case(word: str) -> str:
    """A pattern of the word with its ASCII letters in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters.
    ``hint`` matches every text that may have a finding, and is cheaper."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", 1, f"({_NAMES})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", 1, "AKIA[A-Z0-9]+", 20, 0, "AKIA[A-Z0-9]{16}"),
    # Runs are taken whole, so those of 24 and more are found alone just as well.
    Rule("hex", 1, "[0-9a-f]{24,}", 24),
)

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,version:int>>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost non-overlapping matches of one rule that are long enough, as spans.

    The text between matches comes from ``split`` and the matches from
    ``regexp_extract_all``; running sums of their lengths give the offsets.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("size"),
        F.transform(judged, F.char_length).alias("judged"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + F.coalesce(part["size"], F.lit(0))
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"))
        # The last gap has no match after it: its judged length is null.
        found = F.when(part["judged"] >= rule.least, F.array_append(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    scanned = F.aggregate(parts, start, step, lambda s: s["found"])
    return F.when(text.rlike(rule.hint or rule.pattern), scanned).otherwise(F.array().cast(_SPAN))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
         ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(findings, entries)``.

    findings: ``(id_col, blob, spans)``, one row for each row of documents;
    spans are ordered by start, then by the order of the rules. entries: what
    this run adds to the ledger, ``(blob, scanned array<string>, spans)``; pass
    the union of all entries as ``ledger`` next time. With a ledger, findings
    hold those of earlier runs under the current rule versions as well.

    A null text is an empty one. Rows with equal id and text share a scan and
    keep their rows; null ids are kept. Other columns are not read.
    """
    ws = Workspace(documents.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.select(F.col(id_col).alias("id"), text.alias("text"))
    blobs = ws.save(docs.select("id", F.unhex(F.sha2("text", 256)).alias("blob")), "blobs")
    reader = blobs.groupBy("blob").agg(F.count("*").alias("copies"), F.min("id").alias("id"))
    names = F.array(*(F.lit(r.name) for r in rules))
    if ledger is None:
        todo = reader.withColumn("pending", names)
        known = None
    else:
        known = (
            ledger.groupBy("blob").agg(
                F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"),
                F.flatten(F.collect_list("spans")).alias("spans")))
        todo = (
            reader.join(known.select("blob", "scanned"), "blob", "left")
            .withColumn("pending", F.array_except(names, F.coalesce("scanned", F.array().cast("array<string>"))))
            .filter(F.size("pending") > 0))
    todo = todo.select("blob", F.col("id").alias("reader"), "pending")
    texts = docs.withColumn("blob", F.unhex(F.sha2("text", 256)))
    once = texts.join(todo, (texts["blob"] == todo["blob"]) & texts["id"].eqNullSafe(todo["reader"])).select(
        texts["blob"], "pending", "text")
    per_rule = [
        F.when(F.array_contains("pending", r.name), spans(F.col("text"), r, k)).otherwise(F.array().cast(_SPAN))
        for k, r in enumerate(rules)]
    entries = ws.save(once.select("blob", F.col("pending").alias("scanned"), F.concat(*per_rule).alias("spans")), "entries")
    current = entries.filter(F.size("spans") > 0).select("blob", "spans").distinct()
    if known is not None:
        earlier = known.select("blob", F.filter("spans", _under(rules)).alias("spans"))
        current = current.unionByName(earlier.filter(F.size("spans") > 0)).groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    found = blobs.join(current, "blob", "left").select(
        F.col("id").alias(id_col), "blob",
        F.array_sort(F.coalesce("spans", F.array().cast(_SPAN))).alias("spans"))
    return found, entries


def _under(rules: tuple[Rule, ...]):
    """Keeps what was found under the current version of a rule."""
    return lambda s: reduce(
        lambda a, b: a | b, ((s["kind"] == r.kind) & (s["version"] == r.version) for r in rules), F.lit(False))


def joined(spans_col: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str):
    # A second parameter would get the position of the span.
    return lambda s: s["kind"] == kind


def digest(found: DataFrame, id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by kind, the hash of the spans of ``rules`` and all spans as text."""
    base = [r.kind for r in rules]
    of = F.filter("spans", lambda s: s["kind"].isin(*base))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        id_col, *counts, F.sha2(joined(of), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(text: Column, spans_col: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span replaced by the mask; overlapping and touching spans are masked as one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(fresh & ((s["start"] > state["at"]) | (state["at"] == 0)), F.concat(state["out"], between, F.lit(mask)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    tail = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans_col) == 0, text).otherwise(F.aggregate(spans_col, start, step, tail))
