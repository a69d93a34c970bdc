"""Newton fits against a plain solve, and models that are saved, loaded and refused."""

from __future__ import annotations

import pickle

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tracemill.operators import linear, modeling as md
from tracemill.settings import ModelRules


def plain_newton(x, y, w, ridge=1.0):
    z = np.concatenate([(x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1), np.ones((len(x), 1))], axis=1)
    beta, penalty = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (w * (p - y)) + penalty * beta)
    return beta


def table(spark, x, y, w, parts=3):
    rows = [(f"e{i}", float(y[i]), float(w[i]), x[i].tolist()) for i in range(len(y))]
    made = spark.createDataFrame(rows, "example_id string, y double, weight double, a array<double>")
    return made.select("example_id", "y", "weight", array_to_vector("a").alias("all"), array_to_vector("a").alias("tabular")).repartition(parts)


def planted(n=1200, width=30, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)) * 10.0 ** rng.integers(-2, 4, width) + rng.integers(-5, 5, width)
    x[:, 3] = 7.0
    x[:, 4] = x[:, 5] * 2
    score = (x[:, 0] - x[:, 0].mean()) / x[:, 0].std() + rng.standard_normal(n)
    return x, (score > 0.5).astype(float), rng.choice([0.5, 2.0], n)


def test_coefficients_of_a_plain_solve(spark, monkeypatch):
    monkeypatch.setattr(linear, "LEAST_ROWS", 100)
    x, y, w = planted()
    model = linear.fit(table(spark, x, y, w), "all")
    wanted = plain_newton(x, y, w)
    assert np.abs(np.append(model.coefficients, model.intercept) - wanted).max() < 1e-6
    assert model.coefficients[3] == 0


def test_separable_labels_and_odd_tables(spark):
    x = np.arange(40.0)[:, None]
    y = (x[:, 0] > 20).astype(float)
    model = linear.fit(table(spark, x, y, np.ones(40)), "all")
    assert np.abs(np.append(model.coefficients, model.intercept) - plain_newton(x, y, np.ones(40))).max() < 1e-6
    one = linear.fit(table(spark, x, np.ones(40), np.ones(40)), "all")
    scored = table(spark, x, y, np.ones(40)).select(one.score(F.col("all")).alias("s")).collect()
    assert all(r["s"] > 0.99 for r in scored)
    assert linear.fit(table(spark, x, y, np.ones(40)).limit(0), "all").coefficients.size == 0


@pytest.mark.parametrize("name", [md.LOGISTIC_ALL, md.BOOSTED_ALL])
def test_a_loaded_model_scores_alike_and_refuses_other_columns(spark, tmp_path, name):
    x, y, w = planted(300, 6)
    rows, inputs = table(spark, x, y, w), [f"c{i}" for i in range(6)]
    model, _ = md.fit_model(name, rows, ModelRules(trees=5), inputs)
    md.save_model(spark, model, str(tmp_path / "m"))
    loaded = md.load_model(spark, str(tmp_path / "m"))
    assert (loaded.name, loaded.features, loaded.inputs, loaded.threshold) == (name, "all", inputs, 0.5)
    both = md.score_rows(model, rows).select("example_id", F.col("score").alias("s1")).join(
        md.score_saved(loaded, rows, inputs).select("example_id", F.col("score").alias("s2"), "pred"), "example_id").collect()
    assert len(both) == 300 and all(r["s1"] == r["s2"] and r["pred"] == (r["s2"] >= 0.5) for r in both)
    for other in ([*inputs[:-1], "other"], inputs[::-1], inputs[:-1], [*inputs, "more"]):
        with pytest.raises(ValueError, match="fitted on other columns"):
            md.score_saved(loaded, rows, other)
    found = md.feature_importance(loaded).collect()
    assert len(found) == 6 and {r["feature"] for r in found} == set(inputs)


def test_scores_follow_from_the_saved_numbers_in_sql(spark, tmp_path):
    x, y, w = planted(300, 6)
    rows = table(spark, x, y, w)
    model, _ = md.fit_model(md.LOGISTIC_ALL, rows, inputs=[f"c{i}" for i in range(6)])
    md.save_model(spark, model, str(tmp_path / "m"))
    md.score_rows(model, rows).select("example_id", "score").write.parquet(str(tmp_path / "scores"))
    con = duckdb.connect()
    con.register("cells", pd.DataFrame([(f"e{i}", j, v) for i, r in enumerate(x) for j, v in enumerate(r)], columns=["id", "position", "v"]))
    worst = con.execute(f"""
        WITH n AS (SELECT * FROM '{tmp_path}/m/numbers/*.parquet'),
        s AS (SELECT id, 1 / (1 + exp(-sum(coefficient * (v - mean) / scale) - (SELECT coefficient FROM n WHERE position = -1))) AS s
          FROM cells JOIN n USING (position) GROUP BY id)
        SELECT max(abs(s - score)), count(*) FROM s JOIN '{tmp_path}/scores/*.parquet' ON id = example_id""").fetchone()
    assert worst[1] == 300 and worst[0] < 1e-6


def test_blocks_are_bounded_and_sums_come_once(spark):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[float(i), 1.0] for i in range(2500)]), pa.array(np.ones(2500)), pa.array(np.ones(2500))], names=["x", "y", "weight"])
    blocks = [pickle.loads(b.column("block")[0].as_py()) for b in linear._blocks(iter([batch]))]
    assert [len(b[0]) for b in blocks] == [1024, 1024, 452]
    total, = linear._summed(spark.sparkContext.parallelize(blocks, 5), lambda b: (b[0].sum(axis=0),))
    assert total.tolist() == [2500 * 2499 / 2, 2500.0]
