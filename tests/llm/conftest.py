from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents out of (doc_id, text[, source]) tuples, with columns whose names clash with inner ones."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else None, 7, "x", 1) for r in rows]
        return spark.createDataFrame(full, DOCS + ", id int, key string, label int")

    return make
