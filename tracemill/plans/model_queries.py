"""Matrices, baselines, trained models, metrics and serving queries on the labelled frame."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators import boosting, browsing, features as ft, metrics as m, modeling as md, profiling, splits
from tracemill.operators.linear import LinearModel
from tracemill.plans import analogs as a
from tracemill.plans.analogs import FRAME_SQL
from tracemill.plans.registry import query
from tracemill.settings import DEFAULTS
from tracemill.sources import writers as w
from tracemill.storage import materialize, run_folder, scratch_path

TABULAR = ["diff_lines", "changed_files", "source_patch_token_count_capped"]
LANGS = ["de", "en", "es", "fr"]

_SPLIT_SQL = """,
repos AS (SELECT repo, row_number() OVER (ORDER BY md5('42:' || repo), repo) AS rk, count(*) OVER () AS n
  FROM (SELECT DISTINCT repo FROM frame)),
smap AS (SELECT repo, CASE WHEN rk <= floor(n * 0.8::DOUBLE) THEN 'train'
  WHEN rk <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM repos),
sp AS (SELECT frame.*, split FROM frame JOIN smap USING (repo))
"""
_FRAME_SPLIT_SQL = FRAME_SQL + _SPLIT_SQL


def split_frame(spark, sf_dir):
    return splits.split_labeled(a.labelled_frame(spark, sf_dir), "review_concern").filter("in_matrix")


def matrix(spark, sf_dir, width: int = DEFAULTS.model.embedding_width):
    """Labelled rows with the tabular and the full vector."""
    rows = ft.hashed_embedding(split_frame(spark, sf_dir), "text", DEFAULTS.model.token_cap, width).drop("text")
    flags = [F.coalesce(F.col("top_language") == v, F.lit(False)).cast("double").alias(f"lang_{v}") for v in LANGS]
    return md.load_matrices(rows.select("*", *flags), [*TABULAR, *[f"lang_{v}" for v in LANGS]])


def train_rows(rows):
    return md.balanced_weights(rows.filter(F.col("split") == "train"))


@query("load_matrices", _FRAME_SPLIT_SQL + """
SELECT split, count(*) AS n_rows, CAST(7 AS BIGINT) AS tabular_width, CAST(775 AS BIGINT) AS all_width,
  CAST(sum(diff_lines + changed_files + source_patch_token_count_capped) AS DOUBLE) AS tabular_sum
FROM sp GROUP BY ALL""")
def load_matrices(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    rows = matrix(spark, sf_dir)
    flat = vector_to_array("tabular")
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.size(flat)).cast("long").alias("tabular_width"),
        F.max(F.size(vector_to_array("all"))).cast("long").alias("all_width"),
        F.sum(F.get(flat, F.lit(0)) + F.get(flat, F.lit(1)) + F.get(flat, F.lit(2))).alias("tabular_sum"),
    )


@query("balanced_weights", _FRAME_SPLIT_SQL + """,
t AS (SELECT * FROM sp WHERE split = 'train')
SELECT example_id, review_concern AS y, (SELECT count(*) FROM t)::DOUBLE / (2 * count(*) OVER (PARTITION BY review_concern))
  AS weight FROM t""")
def balanced_weights(spark, sf_dir):
    rows = split_frame(spark, sf_dir).filter(F.col("split") == "train").withColumn("y", F.col("review_concern"))
    return md.balanced_weights(rows).select("example_id", "y", "weight")


@query("majority_baseline", _FRAME_SPLIT_SQL + """
SELECT example_id, split, (SELECT CASE WHEN 2 * sum(review_concern) > count(*) THEN 1.0 ELSE 0.0 END FROM sp
  WHERE split = 'train')::DOUBLE AS score FROM sp WHERE split <> 'train'""")
def majority_baseline(spark, sf_dir):
    rows = split_frame(spark, sf_dir).withColumn("y", F.col("review_concern"))
    train, rest = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") != "train")
    return md.majority_baseline(train, rest).select("example_id", "split", "score")


INPUTS = {"tabular": [*TABULAR, *[f"lang_{v}" for v in LANGS]]}
INPUTS["all"] = [*INPUTS["tabular"], *ft.embedding_names(DEFAULTS.model.embedding_width)]
_ONCE: dict[tuple[str, str, str], object] = {}


def written_matrix(spark, sf_dir):
    """The labelled matrix, written once for all queries of a run."""
    key = run_folder(spark), sf_dir, "matrix"
    if key not in _ONCE:
        _ONCE[key] = materialize(matrix(spark, sf_dir), "matrix")
    return _ONCE[key]


def saved_models(spark, sf_dir, names):
    """Models as loaded from where they are saved. What is not there yet is fitted on the train
    rows, gets its threshold on the validation rows and is saved; later queries of the run load it."""
    keys = {name: (run_folder(spark), sf_dir, name) for name in names}
    missing = [name for name, key in keys.items() if key not in _ONCE]
    if missing:
        rows = written_matrix(spark, sf_dir)
        train = materialize(train_rows(rows).select("example_id", "y", "weight", "tabular", "all"), "train")
        fitted = md.fit_models(missing, train, DEFAULTS.model, INPUTS)
        val = reduce(DataFrame.unionByName, (md.score_rows(model, rows.filter("split = 'val'")).select(
            F.lit(name).alias("model"), F.col("y").cast("long").alias("y"), "score") for name, (model, _) in fitted.items()))
        cuts = {r["model"]: r["threshold"] for r in m.best_threshold(materialize(val, "val"), ("model",)).collect()}
        for name, (model, _) in fitted.items():
            path = scratch_path(spark, f"model-{name}")
            md.save_model(spark, replace(model, threshold=cuts.get(name, 0.5)), path)
            _ONCE[keys[name]] = path
    return [md.load_model(spark, _ONCE[keys[name]]) for name in names]


def _fit_and_score(spark, sf_dir, names):
    """Validation scores of saved models."""
    val = written_matrix(spark, sf_dir).filter("split = 'val'")
    return reduce(DataFrame.unionByName, (
        md.score_saved(model, val, INPUTS[model.features]).select(
            F.lit(model.name).alias("model"), "example_id", F.col("y").cast("long").alias("y"), "score")
        for model in saved_models(spark, sf_dir, names)))


@query("logistic_models")
def logistic_models(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, [md.LOGISTIC_TABULAR, md.LOGISTIC_ALL])


@query("boosted_models")
def boosted_models(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, [md.BOOSTED_TABULAR, md.BOOSTED_ALL])


_BINS = DEFAULTS.model.bins
# Buckets, bins, and the sums left of each cut: gradients of the first tree are those of a constant score.
_ROOT_SQL = _FRAME_SPLIT_SQL + """,
t AS (SELECT *, (SELECT count(*) FROM sp WHERE split = 'train')::DOUBLE / (2 * count(*) OVER (PARTITION BY review_concern)) AS w
  FROM sp WHERE split = 'train'),
c AS (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS feature, CAST({value} AS DOUBLE) AS v, review_concern AS y, w FROM t"
    for name, value in [*((c, c) for c in TABULAR), *((f"lang_{v}", f"CASE WHEN top_language = '{v}' THEN 1 ELSE 0 END") for v in LANGS)]) + f"""),
b AS (SELECT feature, CASE WHEN v > 0 THEN CAST((floor(log2(v)) + 1100) * 4096
    + least(floor((v / pow(2, floor(log2(v))) - 1) * 4096), 4095) + 1 AS BIGINT) ELSE 0 END AS code, y, w FROM c),
k AS (SELECT feature, code, count(*) AS n, sum(w * (0.5 - y)) AS g, sum(w * 0.25) AS h FROM b GROUP BY ALL),
r AS (SELECT *, n * {_BINS} >= sum(n) OVER f AS alone, count(*) OVER f AS codes FROM k WINDOW f AS (PARTITION BY feature)),
s AS (SELECT *, coalesce(sum(CASE WHEN alone THEN 0 ELSE n END) OVER (PARTITION BY feature ORDER BY code ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    * greatest(1, {_BINS} - 2 * count(*) FILTER (alone) OVER f) // greatest(1, sum(CASE WHEN alone THEN 0 ELSE n END) OVER f) AS share
  FROM r WINDOW f AS (PARTITION BY feature)),
l AS (SELECT *, lag(share) OVER o AS share1, lag(alone) OVER o AS alone1, sum(g) OVER o - g AS lg, sum(h) OVER o - h AS lh,
    sum(g) OVER (PARTITION BY feature) AS tg, sum(h) OVER (PARTITION BY feature) AS th FROM s WINDOW o AS (PARTITION BY feature ORDER BY code))
SELECT feature, code AS cut, round(lg, 6) + 0.0 AS left_gradient, round(lh, 6) AS left_second,
  round(0.5 * (lg * lg / (lh + 2) + (tg - lg) * (tg - lg) / (th - lh + 2) - tg * tg / (th + 2)), 6) + 0.0 AS gain,
  round(-0.05 * lg / (lh + 2), 6) + 0.0 AS left_leaf
FROM l WHERE share1 IS NOT NULL AND (codes <= {_BINS} OR share <> share1 OR alone OR alone1) AND lh >= 1 AND th - lh >= 1"""


@query("boosted_first_split", _ROOT_SQL)
def boosted_first_split(spark, sf_dir):
    """Every cut that the first split of the tabular model can choose: sums, gain and leaf on its left."""
    found = boosting.root_cuts(train_rows(written_matrix(spark, sf_dir)), "tabular", INPUTS["tabular"], DEFAULTS.model)
    rows = spark.createDataFrame(found, "feature string, cut long, left_gradient double, left_second double, gain double, left_leaf double")
    return rows.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("left_gradient", "left_second", "gain", "left_leaf")})


@query("score_rows")
def score_rows(spark, sf_dir):
    """Every labelled row scored by the saved tabular linear model, with its decision."""
    model, = saved_models(spark, sf_dir, [md.LOGISTIC_TABULAR])
    return md.score_saved(model, written_matrix(spark, sf_dir), INPUTS["tabular"]).select("example_id", "split", "score", "pred")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    model, = saved_models(spark, sf_dir, [md.LOGISTIC_ALL])
    return md.feature_importance(model)


# --- metrics on deterministic scores ------------------------------------------

_THRESHOLD_SQL = FRAME_SQL + """,
qs AS (SELECT model, unnest(list_distinct(quantile_cont(s, [""" + ", ".join(f"{i / 100}" for i in range(1, 100)) + """])))
  AS cut FROM sc GROUP BY model),
tried AS (SELECT qs.model, cut, count(*) FILTER (WHERE y = 1 AND s >= cut) AS tp,
  count(*) FILTER (WHERE y = 0 AND s >= cut) AS fp, count(*) FILTER (WHERE y = 1 AND s < cut) AS fn,
  count(*) FILTER (WHERE y = 0 AND s < cut) AS tn FROM qs JOIN sc USING (model) GROUP BY ALL),
f AS (SELECT *, (CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END
  + CASE WHEN 2 * tn + fp + fn > 0 THEN 2.0 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2 AS f1 FROM tried),
best AS (SELECT model, CASE WHEN (SELECT count(DISTINCT s) FROM sc WHERE sc.model = f.model) = 1 THEN 0.5
  ELSE arg_min(cut, (-round(f1, 12), cut)) END AS threshold FROM f GROUP BY model)
"""


@query("best_threshold", _THRESHOLD_SQL + "SELECT model, round(threshold, 9) AS threshold FROM best")
def best_threshold(spark, sf_dir):
    return m.best_threshold(a.scored_frame(spark, sf_dir), ("model",)).withColumn(
        "threshold", F.round("threshold", 9))


# Ties share their mean rank; average precision steps over distinct scores.
_METRIC_SQL = """,
g AS (SELECT model, s, count(*) AS n, sum(y) AS pos FROM sc GROUP BY ALL),
w AS (SELECT *, sum(n - pos) OVER (PARTITION BY model ORDER BY s) - (n - pos) AS neg_below,
    sum(pos) OVER (PARTITION BY model ORDER BY s DESC) AS tp, sum(n) OVER (PARTITION BY model ORDER BY s DESC) AS pp,
    sum(pos) OVER (PARTITION BY model) AS p_all, sum(n) OVER (PARTITION BY model) AS n_all FROM g),
rk AS (SELECT model, CASE WHEN count(*) = 1 THEN 0.5
    ELSE sum(pos * (neg_below + (n - pos) / 2.0)) / max(p_all * (n_all - p_all)) END AS roc_auc,
    sum(pos * tp / pp::DOUBLE) / max(p_all) AS average_precision FROM w GROUP BY model),
cf AS (SELECT model, count(*) FILTER (WHERE y = 1 AND s >= t) AS tp, count(*) FILTER (WHERE y = 0 AND s >= t) AS fp,
    count(*) FILTER (WHERE y = 1 AND s < t) AS fn, count(*) FILTER (WHERE y = 0 AND s < t) AS tn,
    avg((s - y) * (s - y)) AS brier FROM sc, (SELECT 0.1::DOUBLE AS t) GROUP BY ALL),
met AS (SELECT model, round(roc_auc, 9) AS roc_auc, round(average_precision, 9) AS average_precision,
    0.1::DOUBLE AS threshold, round(brier, 9) AS brier, tn, fp, fn, tp,
    (CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END
      + CASE WHEN 2 * tn + fp + fn > 0 THEN 2.0 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2 AS macro_f1,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS positive_f1,
    (tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2 AS balanced_accuracy
  FROM rk JOIN cf USING (model))
"""
_MET_COLUMNS = """model, roc_auc, average_precision, threshold, brier, tn, fp, fn, tp, round(macro_f1, 9) AS macro_f1,
  round(positive_f1, 9) AS positive_f1, round(balanced_accuracy, 9) AS balanced_accuracy"""
_ROUNDED = ["roc_auc", "average_precision", "brier", "macro_f1", "positive_f1", "balanced_accuracy"]


def _metrics(spark, sf_dir):
    found = m.binary_metrics(a.scored_frame(spark, sf_dir), F.lit(0.1), ("model",))
    return found.withColumns({c: F.round(c, 9) for c in _ROUNDED})


@query("binary_metrics", FRAME_SQL + _METRIC_SQL + f"SELECT {_MET_COLUMNS} FROM met")
def binary_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query("curve_points", FRAME_SQL + _METRIC_SQL + """
SELECT model, CAST(s AS FLOAT) AS score, (pp - tp) / (n_all - p_all)::DOUBLE AS fpr, tp / p_all::DOUBLE AS tpr,
  tp / pp::DOUBLE AS precision, tp / p_all::DOUBLE AS recall FROM w""")
def curve_points(spark, sf_dir):
    return m.curve_points(a.scored_frame(spark, sf_dir), ("model",))


@query("classification_report", FRAME_SQL + _METRIC_SQL + """,
pr AS (SELECT *, CASE WHEN tn + fn > 0 THEN tn::DOUBLE / (tn + fn) ELSE 0 END AS p0, tn::DOUBLE / (tn + fp) AS r0,
    CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p1, tp::DOUBLE / (tp + fn) AS r1,
    CASE WHEN 2 * tn + fp + fn > 0 THEN 2.0 * tn / (2 * tn + fp + fn) ELSE 0 END AS f0,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1v,
    tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM cf),
u AS (
  SELECT model, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM pr UNION ALL
  SELECT model, '1', p1, r1, f1v, s1 FROM pr UNION ALL
  SELECT model, 'accuracy', (tp + tn)::DOUBLE / n, (tp + tn)::DOUBLE / n, (tp + tn)::DOUBLE / n, n FROM pr UNION ALL
  SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1v) / 2, n FROM pr UNION ALL
  SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1v * s1) / n, n FROM pr)
SELECT model, label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM u""")
def classification_report(spark, sf_dir):
    counts = m.confusion(a.scored_frame(spark, sf_dir), F.lit(0.1), ("model",))
    report = m.classification_report(counts, ("model",))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


def _split_metrics(spark, sf_dir):
    """Metrics of every model on the validation rows and on the test rows."""
    split = split_frame(spark, sf_dir).select("example_id", "split")
    scored = materialize(a.scored_frame(spark, sf_dir).join(split, "example_id"), "scored")
    of = lambda side: m.binary_metrics(scored.filter(F.col("split") == side), F.lit(0.1), ("model",)).withColumns(
        {c: F.round(c, 9) for c in _ROUNDED})
    return of("val"), of("test")


def _board(spark, sf_dir):
    """Validation metrics of every model, and the test metrics that the winner is shown with."""
    val, test = _split_metrics(spark, sf_dir)
    return val.select("model", *[F.col(c).alias(f"val_{c}") for c in _ROUNDED]), test.select(
        "model", *[F.col(c).alias(f"test_{c}") for c in ("roc_auc", "macro_f1")])


def _met_sql(side: str) -> str:
    return f"met_{side} AS (WITH sc AS (SELECT * FROM base WHERE split = '{side}')" + _METRIC_SQL + "SELECT * FROM met)"


_BOARD_SQL = _FRAME_SPLIT_SQL + f""",
base AS (SELECT sc.*, smap.split FROM sc JOIN smap USING (repo)),
{_met_sql("val")},
{_met_sql("test")},
board AS (SELECT model, roc_auc AS val_roc_auc, average_precision AS val_average_precision, brier AS val_brier,
    round(macro_f1, 9) AS val_macro_f1, round(positive_f1, 9) AS val_positive_f1,
    round(balanced_accuracy, 9) AS val_balanced_accuracy,
    row_number() OVER (ORDER BY roc_auc DESC, macro_f1 DESC, model) AS place FROM met_val),
led AS (SELECT board.* EXCLUDE (place), CASE WHEN place = 1 THEN t.roc_auc END AS test_roc_auc,
    CASE WHEN place = 1 THEN round(t.macro_f1, 9) END AS test_macro_f1 FROM board JOIN met_test t USING (model))
"""


@query("model_leaderboard", _BOARD_SQL + "SELECT * FROM led")
def model_leaderboard(spark, sf_dir):
    return m.model_leaderboard(*_board(spark, sf_dir))


@query("metrics_export", _BOARD_SQL + """
SELECT model, CASE WHEN model <> 'constant' THEN val_roc_auc END AS val_roc_auc,
  (SELECT count(*) FROM frame WHERE review_concern = 0) AS negatives,
  (SELECT count(*) FROM frame WHERE review_concern = 1) AS positives FROM led""")
def metrics_export(spark, sf_dir):
    """Leaderboard with class balance, written and read back; a non-finite number is exported as null."""
    val, _ = _board(spark, sf_dir)
    nan = F.when(F.col("model") == "constant", F.lit(float("nan"))).otherwise(F.col("val_roc_auc"))
    labels = a.labelled_frame(spark, sf_dir)
    count = lambda v: labels.agg(F.count_if(F.col("review_concern") == v).alias("n")).scalar()
    board = val.select("model", nan.alias("val_roc_auc")).withColumns({"negatives": count(0), "positives": count(1)})
    path = scratch_path(spark, "metrics")
    w.sink_csv(m.finite_or_null(board), path)
    return spark.read.schema(board.schema).option("header", True).csv(path)


_MELTED = ["val_roc_auc", "val_average_precision", "val_macro_f1", "val_balanced_accuracy"]


@query("metric_melt", _BOARD_SQL + " UNION ALL ".join(
    f"SELECT model, '{c}' AS metric, {c}::DOUBLE AS value FROM led" for c in _MELTED))
def metric_melt(spark, sf_dir):
    return m.metric_melt(_board(spark, sf_dir)[0], _MELTED)


@query("scorecard", _BOARD_SQL + """,
x AS (SELECT (SELECT count(*) FROM frame WHERE accepted_quality = 1)::DOUBLE AS acc,
  (SELECT count(DISTINCT repo) FROM frame)::DOUBLE AS repos,
  (SELECT roc_auc FROM met_test WHERE model = 'length') AS auc, (SELECT round(macro_f1, 9) FROM met_test WHERE model = 'length') AS f1,
  (SELECT round(macro_f1, 9) FROM met_test WHERE model = 'constant') AS base, (SELECT count(*) FROM frame)::DOUBLE AS rows_),
u AS (
  SELECT 'curated_volume' AS criterion, '>= 5000 rows' AS target, acc AS measured,
    acc >= 5000 AS ok, 'enough accepted rows to train on' AS interpretation FROM x UNION ALL
  SELECT 'repository_spread', '> 1 repository', repos, repos > 1,
    'rows come from more than one repository' FROM x UNION ALL
  SELECT 'ranking_above_chance', 'ROC-AUC > 0.500', auc, auc > 0.5,
    'scores order the test rows better than chance' FROM x UNION ALL
  SELECT 'better_than_majority', 'macro-F1 > ' || printf('%.3f', base), f1, f1 > base,
    'both classes are told apart better than by a constant' FROM x UNION ALL
  SELECT 'usable_output', '> 0 rows', rows_, rows_ > 0,
    'there are scored rows to look at' FROM x)
SELECT criterion, target, measured, CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status, interpretation FROM u""")
def scorecard(spark, sf_dir):
    """Criteria on the test rows, volumes on all."""
    _, found = _split_metrics(spark, sf_dir)
    pick = lambda model, c: F.max(F.when(F.col("model") == model, F.col(c)))
    frame = a.labelled_frame(spark, sf_dir)
    of_frame = lambda e: frame.agg(e.alias("v")).scalar()
    measured = found.agg(
        pick("length", "roc_auc").alias("test_roc_auc"), pick("length", "macro_f1").alias("test_macro_f1"),
        pick("constant", "macro_f1").alias("majority_macro_f1"),
    ).withColumns({
        "accepted_rows": of_frame(F.count_if(F.col("accepted_quality") == 1)),
        "repositories": of_frame(F.count_distinct("repo")),
        "artifact_rows": of_frame(F.count(F.lit(1))),
    })
    return profiling.scorecard(measured)


# --- serving -------------------------------------------------------------------

def _serving(spark, sf_dir):
    return a.scored_frame(spark, sf_dir).filter(F.col("model") == "length").select(
        "*", F.col("score").cast("double").alias("pred_probability"),
        (F.col("score").cast("double") >= 0.1).cast("long").alias("pred_label"),
    )


_BROWSE_SQL = FRAME_SQL + """
SELECT repo, pr_number, top_language, changed_files, diff_lines, source_patch_token_count_capped, s AS pred_probability,
  CAST(s >= 0.1 AS BIGINT) AS pred_label, review_concern, accepted_quality,
  CASE review_concern WHEN 1 THEN 'concern' ELSE 'no concern' END AS observed
FROM sc WHERE model = 'length' AND review_concern = 1 AND accepted_quality = 0 AND top_language = 'en'
  AND (contains(lower(repo), 'src1') OR contains(lower(example_id), 'src1'))
ORDER BY s DESC, repo, pr_number LIMIT 100"""


@query("browse_clustered", _BROWSE_SQL)
def browse_clustered(spark, sf_dir):
    """The same page from scores that are laid out for it, out of few files."""
    path = scratch_path(spark, "scores")
    browsing.sink_scores(_serving(spark, sf_dir), path, 16)
    return browsing.browse_saved(spark, path, label="concern", quality="rejected", language="en", search=" SRC1 ").rows


@query("browse_scored", _BROWSE_SQL)
def browse_scored(spark, sf_dir):
    return md.browse_scored(
        _serving(spark, sf_dir), label="concern", quality="rejected", language="en", search=" SRC1 "
    )


@query("browse_scored_by_repo", FRAME_SQL + """
SELECT repo, pr_number, top_language, changed_files, diff_lines, source_patch_token_count_capped, s AS pred_probability,
  CAST(s >= 0.1 AS BIGINT) AS pred_label, review_concern, accepted_quality,
  CASE review_concern WHEN 1 THEN 'concern' ELSE 'no concern' END AS observed
FROM sc WHERE model = 'length' ORDER BY repo, pr_number LIMIT 100""")
def browse_scored_by_repo(spark, sf_dir):
    return md.browse_scored(_serving(spark, sf_dir), sort="repository")


@query("language_choices", FRAME_SQL + "SELECT DISTINCT top_language FROM frame WHERE top_language <> ''")
def language_choices(spark, sf_dir):
    return md.language_choices(_serving(spark, sf_dir))


SCENARIOS = {
    "small change": {"diff_lines": 100.0}, "many files": {"changed_files": 500.0},
    "both": {"diff_lines": 100.0, "changed_files": 500.0},
}


def _what_if(rows, model, probability):
    """Rows under each scenario by a loaded model, whose inputs are columns of the rows."""
    def score(frame):
        vector = array_to_vector(F.array(*(F.col(c).cast("double") for c in model.inputs)))
        return frame.withColumn("__v", vector).withColumn("score", probability(F.col("__v"))).drop("__v")

    # Adding zero turns a rounded -0.0 into 0.0.
    return md.what_if_score(rows, SCENARIOS, score).select(
        "example_id", "scenario", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in ("base_score", "score", "delta")])


@query("what_if_score", FRAME_SQL + """,
o AS (SELECT 'small change' AS scenario, 100.0::DOUBLE AS d, NULL::DOUBLE AS c UNION ALL
  SELECT 'many files', NULL, 500.0 UNION ALL SELECT 'both', 100.0, 500.0),
e AS (SELECT example_id, scenario, 1 / (1 + exp(-(diff_lines / 1000.0::DOUBLE - changed_files / 100.0::DOUBLE - 1))) AS base_score,
  1 / (1 + exp(-(coalesce(d, diff_lines) / 1000.0::DOUBLE - coalesce(c, changed_files) / 100.0::DOUBLE - 1))) AS score FROM frame, o)
SELECT example_id, scenario, round(base_score, 9) AS base_score, round(score, 9) AS score,
  round(score - base_score, 9) + 0.0 AS delta FROM e""")
def what_if_score(spark, sf_dir):
    """A linear model with known coefficients, saved and loaded like a fitted one."""
    known = md.FittedModel("known", "tabular", LinearModel(np.zeros(2), np.ones(2), np.array([0.001, -0.01]), -1.0), ["diff_lines", "changed_files"])
    path = scratch_path(spark, "model-known")
    md.save_model(spark, known, path)
    model = md.load_model(spark, path)
    return _what_if(a.labelled_frame(spark, sf_dir).drop("text"), model, model.body.probability)


@query("what_if_fitted")
def what_if_fitted(spark, sf_dir):
    """The same scenarios by the fitted tabular model."""
    model, = saved_models(spark, sf_dir, [md.LOGISTIC_TABULAR])
    flags = [F.coalesce(F.col("top_language") == v, F.lit(False)).cast("double").alias(f"lang_{v}") for v in LANGS]
    rows = a.labelled_frame(spark, sf_dir).select("example_id", *TABULAR, *flags)
    return _what_if(rows, model, model.body.probability)
