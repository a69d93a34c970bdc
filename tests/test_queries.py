"""Every named query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import oracle
import pytest

from tracemill.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Five fits on a matrix of 850 columns; see test_training for a small run.
SLOW = {"train_evaluate"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SLOW])
def test_query(spark, con, name):
    query = catalog.QUERIES[name]
    if name not in catalog.ORACLES:
        assert query(spark, SF).count() > 0
        return
    result = oracle.compare(spark, con, SF, query, catalog.ORACLES[name])
    assert result.startswith("ok"), result


def test_only_models_and_embeddings_have_no_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {
        "boosted_models", "logistic_models", "score_rows", "feature_importance", "what_if_fitted", "diff_embedding", "learned_embedding", "train_evaluate"}
