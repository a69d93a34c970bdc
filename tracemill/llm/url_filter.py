"""URL filters: longest-rule verdicts, and gradient-boosted trees for the rest.

A rule names a host and a path; it fits its host and all subdomains where the
path of the URL starts with the path of the rule, and the longest fitting rule
decides. The URLs that a rule decides are the labelled ones: trees are boosted
on their lexical features and judge the URLs that no rule fits.

Column expressions and the DataFrame-based tree trainer only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)
FIT_ROWS = 200_000  # labelled URLs that the trees are fitted on, at most (by hash); all URLs are judged
TREES, DEPTH = 12, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the URL text alone."""
    url = F.coalesce(url, F.lit(""))
    n = F.char_length(url)
    some = F.greatest(n, F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.char_length(F.replace(url, c, F.lit("")))) / some
    entropy = F.aggregate(letters, F.lit(0.0), lambda s, c: s - F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return {
        "length": n.cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "host_labels": count(host, "[^.]+"),
        "depth": count(path, "[^/]+"),
        "digit_ratio": count(url, "[0-9]") / some,
        "host_hyphens": count(host, "-"),
        "entropy": entropy,
        "parameters": F.when(F.char_length(query) > 0, count(query, "[^&]+")).otherwise(0.0),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "has_extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "secure": url.startswith("https://").cast("double"),
    }


def _suffixes(host: Column) -> dict[str, Column]:
    return {"last": F.substring_index(host, ".", -1), "last_two": F.substring_index(host, ".", -2)}


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[UrlRule, ...] = RULES,
          labelled: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(id_col, host, path, rule, verdict, block_score)``, one row for each row of pages.

    labelled: ``(url, blocked)`` of other labelled URLs to learn from; by
    default the URLs of ``pages`` that a rule decides. Suffix statistics are
    counted over all pages: how common a host suffix is, and its share of
    blocked labels, shrunk towards the overall share. Where only one label is
    known the method gives that one, and without any label it allows. A null
    URL, or one without ``://``, has an empty host and path; it is judged like
    any other. Repeated rows are judged alike; other columns are not read.
    """
    ws = Workspace(pages.sparkSession)
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", name).withColumn("ruled", verdict)
    features = lexical(F.col("url"), F.col("host"), F.col("path"))
    known = (F.col("ruled") == "block").cast("int") if labelled is None else F.lit(None).cast("int")
    rows = base.select(
        "*", known.alias("blocked"),
        *(c.alias(k) for k, c in features.items()), *(c.alias(k) for k, c in _suffixes(F.col("host")).items()))
    rows = ws.save(rows, "features")
    if labelled is not None:
        u = F.col("url").cast("string")
        marked = labelled.select(u.alias("url"), F.col("blocked").cast("int").alias("blocked"))
        marked = marked.withColumn("host", host_of(u)).withColumn("path", path_of(u))
        marked = marked.select(
            "*", *(c.alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path")).items()),
            *(c.alias(k) for k, c in _suffixes(F.col("host")).items()))
    else:
        marked = rows
    marked = marked.filter("blocked is not null")
    overall = marked.agg(F.count("*").alias("n"), F.avg("blocked").alias("rate")).first()
    if not overall["n"] or overall["rate"] in (0.0, 1.0):
        score = F.lit(float(overall["rate"] or 0.0))
        return _named(rows.withColumn("block_score", score), id_col)

    inputs = list(features)
    for suffix in ("last", "last_two"):
        seen = rows.groupBy(suffix).agg(F.count("*").alias("n"))
        rated = marked.groupBy(suffix).agg(F.count("*").alias("m"), F.sum("blocked").alias("bad"))
        stats = ws.save(seen.join(rated, suffix, "left").select(
            suffix, F.log1p(F.col("n").cast("double")).alias(f"{suffix}_common"),
            ((F.coalesce("bad", F.lit(0)) + 10.0 * overall["rate"]) / (F.coalesce("m", F.lit(0)) + 10.0)).alias(f"{suffix}_rate")),
            f"stats_{suffix}")
        defaults = {f"{suffix}_common": 0.0, f"{suffix}_rate": float(overall["rate"])}
        rows = rows.join(stats, suffix, "left").fillna(defaults)
        marked = marked.join(stats, suffix, "left").fillna(defaults)
        inputs += list(defaults)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    share = min(1.0, fit_rows / overall["n"])
    sample = marked.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < int(share * (1 << 20)))
    fit = ws.save(assembler.transform(sample).select("features", F.col("blocked").cast("double").alias("blocked")), "fit")
    if fit.select("blocked").distinct().count() < 2:
        return _named(rows.withColumn("block_score", F.lit(float(overall["rate"]))), id_col)
    trees = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=11).fit(fit)
    scored = trees.transform(assembler.transform(rows)).withColumn("block_score", vector_to_array("probability")[1])
    return _named(scored, id_col)


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    verdict = F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "block_score")
