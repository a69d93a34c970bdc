"""Feature vectors, baselines, linear and boosted models, scoring, serving queries."""

from __future__ import annotations

import hashlib
import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.text import nonempty
from tracemill.operators import boosting, linear
from tracemill.operators.boosting import BoostedTrees
from tracemill.operators.features import TARGET, leakage_check
from tracemill.operators.linear import LinearModel
from tracemill.settings import ModelRules
from tracemill.sources.writers import sink_document

# Names of the compared models.
MAJORITY = "majority_baseline"
LOGISTIC_TABULAR = "logistic_tabular"
LOGISTIC_ALL = "logistic_all_features"
BOOSTED_TABULAR = "boosted_tabular"
BOOSTED_ALL = "boosted_all_features"
OVERVIEW_COLUMNS = [
    "repo", "pr_number", "top_language", "changed_files", "diff_lines", "source_patch_token_count_capped",
    "pred_probability", "pred_label", "review_concern", "accepted_quality",
]


def load_matrices(rows: DataFrame, tabular: list[str], embedding: str | None = "diff_emb") -> DataFrame:
    """Labelled rows with two vectors: ``tabular`` and ``all`` (tabular + embedding)."""
    leakage_check(tabular)
    labelled = rows.filter(F.col(TARGET).isNotNull()).withColumn("y", F.col(TARGET).cast("double"))
    inputs = [F.col(c).cast("double").alias(c) for c in tabular]
    keep = [c for c in rows.columns if c not in tabular]
    flat = labelled.select(*keep, "y", *inputs)
    tab = VectorAssembler(inputCols=tabular, outputCol="tabular", handleInvalid="keep").transform(flat)
    if embedding is None:
        return tab
    wide = tab.withColumn("__emb", array_to_vector(F.col(embedding).cast("array<double>")))
    return VectorAssembler(inputCols=["tabular", "__emb"], outputCol="all").transform(wide).drop("__emb")


def balanced_weights(rows: DataFrame, label: str = "y") -> DataFrame:
    """``weight`` = n / (2 * rows of the class); the class table has two rows."""
    classes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    weights = classes.select(label, (total.cast("double") / (2 * F.col("__n"))).alias("weight"))
    return rows.join(weights, label)


def majority_baseline(train: DataFrame, rows: DataFrame, label: str = "y") -> DataFrame:
    """The most frequent training class as a constant score; ties go to the lower class."""
    classes = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # A two-row table: the class with most rows.
    top = classes.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("top"))
    return rows.withColumn("score", top.scalar().cast("double"))


@dataclass
class FittedModel:
    """A model, the vector column it reads, the names of its inputs in order, and its decision threshold."""

    name: str
    features: str
    body: LinearModel | BoostedTrees
    inputs: list[str] | None = None
    threshold: float = 0.5


def fit_model(name: str, train: DataFrame, rules: ModelRules = ModelRules(),
              inputs: list[str] | None = None) -> tuple[FittedModel, float]:
    """Fit one of the four trained models on weighted rows; returns it and the seconds."""
    features = "tabular" if name in (LOGISTIC_TABULAR, BOOSTED_TABULAR) else "all"
    began = time.perf_counter()
    if name in (LOGISTIC_TABULAR, LOGISTIC_ALL):
        body = linear.fit(train, features)
    else:
        body = boosting.fit(train, features, rules)
    return FittedModel(name, features, body, inputs), time.perf_counter() - began


def fit_models(names: list[str], train: DataFrame, rules: ModelRules = ModelRules(),
               inputs: dict[str, list[str]] | None = None) -> dict[str, tuple[FittedModel, float]]:
    """Several models side by side: their many short jobs fill each other's gaps."""
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        fit = lambda name: fit_model(name, train, rules, (inputs or {}).get("tabular" if name in (LOGISTIC_TABULAR, BOOSTED_TABULAR) else "all"))
        return dict(zip(names, pool.map(fit, names)))


def score_rows(model: FittedModel, rows: DataFrame, threshold: float | None = None) -> DataFrame:
    """Positive-class probability as float32 ``score``; ``pred`` when a threshold is given."""
    out = rows.withColumn("score", model.body.score(F.col(model.features)))
    if threshold is not None:
        out = out.withColumn("pred", (F.col("score").cast("double") >= threshold).cast("int"))
    return out


def inputs_digest(inputs: list[str]) -> str:
    """One number for the names of a matrix's columns and their order."""
    return hashlib.sha256(json.dumps(inputs).encode()).hexdigest()


def save_model(spark: SparkSession, model: FittedModel, path: str) -> None:
    """The whole model as one document, and its numbers as a table for SQL."""
    names = model.inputs or []
    sink_document(spark, {
        "name": model.name, "features": model.features, "threshold": model.threshold, "inputs": model.inputs,
        "inputs_digest": inputs_digest(names), "kind": type(model.body).__name__, "body": model.body.to_dict()}, f"{path}/model")
    body = model.body
    if isinstance(body, LinearModel):
        rows = [(i, *map(float, x)) for i, x in enumerate(zip(body.coefficients, body.mean, body.scale))]
        table = spark.createDataFrame([*rows, (-1, body.intercept, 0.0, 1.0)], "position int, coefficient double, mean double, scale double")
    else:
        rows = [(t, n, s.feature, s.code, s.gain, None) for t, tree in enumerate(body.trees) for n, s in tree.splits.items()]
        rows += [(t, n, None, None, None, v) for t, tree in enumerate(body.trees) for n, v in tree.leaves.items()]
        table = spark.createDataFrame(
            [*rows, (-1, 0, None, None, None, body.base)], "tree int, node int, position int, code long, gain double, value double")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    found = json.loads(spark.read.text(f"{path}/model").first()["value"])
    kinds = {k.__name__: k for k in (LinearModel, BoostedTrees)}
    if inputs_digest(found["inputs"] or []) != found["inputs_digest"]:
        raise ValueError(f"{path}: the names of the inputs don't belong to this model")
    return FittedModel(found["name"], found["features"], kinds[found["kind"]].from_dict(found["body"]), found["inputs"], found["threshold"])


def score_saved(model: FittedModel, rows: DataFrame, inputs: list[str]) -> DataFrame:
    """Scores and decisions of a loaded model. A matrix with other columns, or in another order, is refused."""
    if inputs_digest(inputs) != inputs_digest(model.inputs or []):
        odd = sorted(set(inputs) ^ set(model.inputs or []))
        raise ValueError(f"{model.name} was fitted on other columns: {odd[:5] or 'another order'}")
    return score_rows(model, rows, model.threshold)


def sigmoid(decision: Column) -> Column:
    """Score of a model that only gives a decision value."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-decision))


def feature_importance(model: FittedModel, names: list[str] | None = None, limit: int = 20) -> DataFrame:
    """Most important inputs by mean gain of their splits or absolute coefficient.

    The model is already a small object on the driver.
    """
    pairs = [(n, float(v)) for n, v in zip(names or model.inputs, model.body.importance(), strict=True)]
    return (
        SparkSession.active().createDataFrame(pairs, "feature string, importance double")
        .orderBy(F.desc("importance"), F.asc("feature"))
        .limit(limit)
    )


def browse_scored(
    scored: DataFrame, label: str = "all", quality: str = "all", language: str = "all", search: str = "",
    sort: str = "highest probability", limit: int = 100,
) -> DataFrame:
    """Filtered, sorted first page of scored rows.

    ``search`` is a literal part of the lower-cased repository or id.
    """
    rows = scored
    if label in ("concern", "no concern"):
        rows = rows.filter(F.col("review_concern") == (1 if label == "concern" else 0))
    if quality in ("accepted", "rejected"):
        rows = rows.filter(F.col("accepted_quality") == (1 if quality == "accepted" else 0))
    if language != "all":
        rows = rows.filter(F.col("top_language") == language)
    text = search.strip().lower()
    if text:
        rows = rows.filter(F.lower("repo").contains(text) | F.lower("example_id").contains(text))
    tie = [F.asc("repo"), F.asc("pr_number")]
    order = {
        "highest probability": [F.desc("pred_probability"), *tie],
        "lowest probability": [F.asc("pred_probability"), *tie],
        "repository": tie,
    }[sort]
    return rows.orderBy(*order).limit(limit).select(
        *OVERVIEW_COLUMNS, display_label(F.col("review_concern")).alias("observed")
    )


def language_choices(scored: DataFrame) -> DataFrame:
    return scored.filter(nonempty(F.col("top_language"))).select("top_language").distinct()


def display_label(value: Column) -> Column:
    return F.when(value.isNull(), "unknown").when(value == 1, "concern").otherwise("no concern")


def what_if_score(rows: DataFrame, scenarios: dict[str, dict[str, float]], score) -> DataFrame:
    """Re-score every row under each scenario of overridden numbers.

    ``score`` maps a DataFrame to one with a ``score`` column. All scenarios run
    in one pass: each row is exploded over the given handful of overrides.
    """
    base = score(rows).withColumnRenamed("score", "base_score")
    touched = sorted({c for values in scenarios.values() for c in values})
    options = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"),
            *[F.lit(values.get(c)).cast("double").alias(c) for c in touched],
        )
        for name, values in scenarios.items()
    ])
    changed = base.withColumn("__o", F.explode(options))
    for c in touched:
        changed = changed.withColumn(c, F.coalesce(F.col("__o")[c], F.col(c).cast("double")))
    changed = changed.withColumn("scenario", F.col("__o.scenario")).drop("__o")
    return score(changed).withColumn("delta", F.col("score").cast("double") - F.col("base_score").cast("double"))
