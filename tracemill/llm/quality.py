"""Document quality by hierarchical empirical Bayes.

Evidence. Each document is described by a few surface measures, cut at fixed
edges. From labelled documents every (measure, bin) gets the log ratio of its
smoothed frequency in good and in bad documents; the mean of a document's
ratios, scaled by a slope fitted to the labels, is its classifier evidence.

Hierarchy. The global rate of good documents is the prior of each host, and
the posterior rate of a host is the prior of each of its paths. A labelled
document counts in full, any other by the probability that its evidence alone
gives. How strongly a level shrinks towards the one above is estimated from
the spread of the rates at that level (method of moments), so sparse sites stay
near their prior. A document is left out of the counts that judge it.

The score is the posterior odds: prior odds of the path times the evidence.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.storage import Workspace

EDGES = {
    "junk": (0.002, 0.01, 0.03, 0.08),         # symbols that prose hardly uses, of all characters
    "shouting": (0.05, 0.1, 0.2, 0.4),         # capitals among letters
    "exclaiming": (0.002, 0.01, 0.05),
    "barred": (0.002, 0.01, 0.05),             # table bars
    "digits": (0.02, 0.08, 0.2),
    "word_length": (3.0, 4.0, 5.5, 7.0, 9.0),
    "line_length": (12.0, 30.0, 60.0, 200.0),
    "lines_repeat": (0.05, 0.2, 0.5),          # repeated lines among all
    "words_repeat": (0.02, 0.1, 0.3),          # words that repeat the one before
    "words_log": (3.0, 4.5, 6.0, 8.0),
}
REJECT_BELOW = 0.1  # odds of nine to one against a document
FIT_ROWS = 50_000   # labelled documents that the slope is fitted on, at most
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1e4


def measures(text: Column) -> dict[str, Column]:
    """Surface measures; 0 for what an empty text has no measure of."""
    n = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    without = lambda chars: F.char_length(F.translate(text, chars, ""))
    share = lambda chars: (F.char_length(text) - without(chars)) / n
    upper = F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}", ""))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("double")
    each = F.split(text, "[\\x20\\x09-\\x0D]+")
    pairs = F.zip_with(F.slice(each, 2, F.greatest(F.size(each), F.lit(1))), each, lambda a, b: a == b)
    lines = F.filter(F.split(text, "\n"), lambda s: F.trim(s) != "")
    n_lines = F.size(lines).cast("double")
    return {
        "junk": share("%$#&*^~@<>{}[]\\=_"),
        "shouting": upper / n,
        "exclaiming": share("!"),
        "barred": share("|"),
        "digits": share("0123456789"),
        "word_length": without(" \t\n\r\x0b\x0c") / F.greatest(words, F.lit(1.0)),
        "line_length": F.char_length(text) / F.greatest(n_lines, F.lit(1.0)),
        "lines_repeat": (n_lines - F.size(F.array_distinct(lines))) / F.greatest(n_lines, F.lit(1.0)),
        "words_repeat": F.size(F.filter(pairs, lambda same: same)) / F.greatest(words, F.lit(1.0)),
        "words_log": F.log1p(words),
    }


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    return reduce(lambda a, e: a + F.when(value >= e, 1).otherwise(0), edges, F.lit(0))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _slope(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of y on one variable, a little ridge, by Newton steps."""
    w = np.zeros(2)
    design = np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.eye(2) * 1e-2, design.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _strength(counts: DataFrame, prior: Column) -> float:
    """Beta strength of a level by moments: counts has ``n`` and ``good`` of each site."""
    rate = F.col("good") / F.col("n")
    at = counts.filter("n >= 1").agg(
        F.sum("n").alias("n"), F.count("*").alias("sites"),
        F.sum(F.col("n") * (rate - prior) ** 2).alias("spread"), F.sum(prior * (1 - prior)).alias("noise")).first()
    if not at["sites"] or at["sites"] < 2:
        return LEAST_STRENGTH
    within = at["noise"] / at["sites"]
    # E[sum n (rate - prior)^2] = sites * within + between * (n - sites)
    between = max(0.0, (at["spread"] - at["noise"]) / max(at["n"] - at["sites"], 1.0))
    strength = within / between - 1 if between > 0 else MOST_STRENGTH
    return float(min(max(strength, LEAST_STRENGTH), MOST_STRENGTH))


def score(documents: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", reject_below: float = REJECT_BELOW) -> DataFrame:
    """``(id_col, host, path, evidence, host_rate, path_rate, score, keep)``, one row for each row of documents.

    labels: ``(id_col, label_col)`` with 1 for good and 0 for bad; null labels
    are left out, and an id with several labels counts by their mean. A null
    text is empty; a null host or path is a site of its own. Without any label,
    or with one kind only, the evidence is 0 and every document is kept. Rows
    with a null id have no label; repeated rows are scored alike. An empty table
    gives an empty result. Other columns are not read.
    """
    ws = Workspace(documents.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = measures(text)
    rows = documents.select(
        F.col(id_col).alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.array(*(_bin(found[k], e) for k, e in EDGES.items())).alias("bins"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).dropna().groupBy("id").agg(
        F.avg("label").alias("label"))
    rows = ws.save(rows.join(marks, "id", "left"), "binned")
    known = rows.filter("label is not null")

    # At most len(EDGES) * 6 rows.
    counted = known.select(F.posexplode("bins").alias("measure", "bin"), "label").groupBy("measure", "bin").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).collect()
    total = {m: [sum(r[k] for r in counted if r["measure"] == m) for k in ("good", "bad")] for m in range(len(EDGES))}
    if not counted or min(total[0]) == 0:
        return rows.select(
            F.col("id").alias(id_col), "host", "path", F.lit(0.0).alias("evidence"), F.lit(1.0).alias("host_rate"),
            F.lit(1.0).alias("path_rate"), F.lit(1.0).alias("score"), F.lit(True).alias("keep"))
    table = {}
    for r in counted:
        k = len(list(EDGES.values())[r["measure"]]) + 1
        good, bad = total[r["measure"]]
        table[(r["measure"], r["bin"])] = float(np.log((r["good"] + 0.5) / (good + 0.5 * k)) - np.log((r["bad"] + 0.5) / (bad + 0.5 * k)))
    lookup = F.array(*(
        F.array(*(F.lit(table.get((m, b), 0.0)) for b in range(len(edges) + 1))) for m, edges in enumerate(EDGES.values())))
    raw = F.aggregate(
        F.arrays_zip(F.col("bins").alias("b"), lookup.alias("t")), F.lit(0.0), lambda s, x: s + F.get(x["t"], x["b"]))
    n_known = known.count()
    sample = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(min(1.0, FIT_ROWS / n_known) * (1 << 20)))
    fit = sample.select(raw.alias("x"), "label").groupBy("x").agg(F.sum("label").alias("g"), F.count("*").alias("n")).toPandas()
    x = np.repeat(fit["x"].to_numpy(), 2)
    y = np.tile([1.0, 0.0], len(fit))
    weight = np.stack([fit["g"], fit["n"] - fit["g"]], 1).ravel()
    cut, slope = _slope(np.repeat(x, np.round(weight).astype(int)), np.repeat(y, np.round(weight).astype(int)))
    rate = float(total[0][0] / sum(total[0]))
    # The evidence is what the labels say beyond the global odds.
    evidence = F.lit(cut - float(np.log(rate / (1 - rate)))) + F.lit(max(slope, 0.0)) * raw
    own = F.coalesce("label", _sigmoid(F.lit(float(np.log(rate / (1 - rate)))) + F.col("evidence")))
    judged = ws.save(rows.withColumn("evidence", evidence).withColumn("own", own).drop("bins"), "judged")

    sites = ws.save(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("good")), "sites")
    hosts = sites.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    top = float((overall["good"] + rate) / (overall["n"] + 1)) if overall["n"] else rate
    strength = _strength(hosts, F.lit(top))
    shrunk = hosts.withColumn("host_mean", (F.col("good") + strength * top) / (F.col("n") + strength))
    below = sites.join(shrunk.select("host", "host_mean"), "host")
    path_strength = _strength(below, F.col("host_mean"))
    prior = sites.withColumnsRenamed({"n": "path_n", "good": "path_good"}).join(
        hosts.withColumnsRenamed({"n": "host_n", "good": "host_good"}), "host")
    out = judged.join(ws.save(prior, "prior"), ["host", "path"])
    out = out.withColumn("host_rate", (F.col("host_good") - F.col("own") + strength * top) / (F.col("host_n") - 1 + strength))
    out = out.withColumn(
        "path_rate", (F.col("path_good") - F.col("own") + path_strength * F.col("host_rate")) / (F.col("path_n") - 1 + path_strength))
    out = out.withColumn("score", _sigmoid(_logit(F.col("path_rate")) + F.col("evidence")))
    return out.select(
        F.col("id").alias(id_col), "host", "path", "evidence", "host_rate", "path_rate", "score",
        (F.col("score") >= reject_below).alias("keep"))
