from __future__ import annotations

import os

import corpus_pipeline
import oracle
import pytest
from pyspark.sql import functions as F

from tracemill.llm import queries
from tracemill.storage import Workspace

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    if name in queries.ORACLES:
        result = oracle.compare(spark, con, SF, queries.QUERIES[name], queries.ORACLES[name])
        assert result.startswith("ok"), result
    else:
        assert queries.QUERIES[name](spark, SF).count() > 0


def test_stages_keep_columns_and_take_effect(spark):
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = ws.save(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns
    first = spark.read.parquet(f"{SF}/documents.parquet")
    judged = queries.op1_quality_classifier(spark, SF)
    assert kept["quality_classifier"].count() == judged.filter("keep").count() < first.count()
    linked = kept["ngram_jaccard_join"]
    assert linked.count() == linked.select("doc_id").distinct().count() < kept["quality_classifier"].count()
    assert kept["secret_scans"].count() == linked.count()
    assert kept["secret_scans"].filter(F.col("text").rlike("[0-9a-f]{24}")).count() == 0
    assert kept["secret_scans"].filter(F.col("n_chars") != F.char_length("text")).count() == 0
    packed = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n").alias("m")).first()["m"]
    assert packed <= 1024
    assert docs.select("doc_id").distinct().count() == kept["source_mixing"].select("doc_id").distinct().count()


def test_stages_take_empty_and_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(1, None, None, None, None), (None, "token=abcdefg", None, "s", 13), (2, "", "en", "s", 0), (3, "a b c", "en", None, 5),
           (3, "a b c", "en", None, 5), (4, "A B C", "en", "s", 5), (5, "z " * 40_000, "en", "s", 80_000)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        ids = {r[0] for r in rows}
        for name, stage in corpus_pipeline.STAGES:
            docs = Workspace(spark).save(stage(spark, docs, str(tmp_path)), name)
            if name == "ngram_jaccard_join" and rows:
                assert sorted(r["doc_id"] for r in docs.collect() if r["doc_id"]) == [1, 2, 3, 5]
            if name == "secret_scans" and rows:
                assert {r["text"] for r in docs.collect() if r["doc_id"] is None} == {"[REDACTED]"}
        assert {r["doc_id"] for r in docs.collect()} <= ids
