"""Tables that are laid out for their readers: buckets that join in place, scores that are browsed from few files."""

from __future__ import annotations

import numpy as np
import pytest

from tracemill.operators import browsing, modeling as md
from tracemill.sources import writers as w


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_buckets_join_without_an_exchange(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('r', id % 7) as repo", "id as pr_number", "id % 3 as label")
    one = w.sink_bucketed(rows, "t_one", str(tmp_path / "one"), ["repo", "pr_number"], 8)
    two = w.sink_bucketed(rows.selectExpr("repo", "pr_number", "label * 2 as double_label"), "t_two", str(tmp_path / "two"), ["repo", "pr_number"], 8)
    joined = one.hint("merge").join(two, ["repo", "pr_number"])
    grouped = joined.groupBy("repo", "pr_number").count()
    assert "Exchange" not in plan_of(joined) and "Exchange" not in plan_of(grouped)
    assert joined.filter("double_label = 2 * label").count() == 5000 == grouped.count()
    plain = rows.hint("merge").join(rows.selectExpr("repo", "pr_number", "label as l2"), ["repo", "pr_number"])
    assert "Exchange" in plan_of(plain)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(0)
    rows = [(f"org{i % 40}/proj{i % 97}", i, ["py", "go", None][i % 3], i % 9, i % 11, i % 13, float(np.round(rng.random(), 2)), 1,
             int(rng.integers(2)) if i % 10 else None, int(rng.integers(2)), f"org{i % 40}__proj{i % 97}__pull_{i}") for i in range(4000)]
    return spark.createDataFrame(rows, "repo string, pr_number long, top_language string, changed_files long, diff_lines long, "
        "source_patch_token_count_capped long, pred_probability double, pred_label int, review_concern int, accepted_quality int, example_id string")


@pytest.mark.parametrize("sort", ["highest probability", "lowest probability", "repository"])
def test_pages_are_those_of_all_rows_from_few_files(spark, scored, tmp_path, sort):
    path = str(tmp_path / "scores")
    browsing.sink_scores(scored, path, 16)
    for filters, most in [({}, 4), ({"label": "concern"}, 4), ({"language": "go", "quality": "accepted"}, 8), ({"search": "PROJ13"}, 16),
                          ({"search": "pull_777"}, 16), ({"search": "p"}, 4), ({"search": "nothing like it"}, 0), ({"language": "none"}, 0)]:
        page = browsing.browse_saved(spark, path, sort=sort, **filters)
        wanted = md.browse_scored(scored, sort=sort, **filters).collect()
        assert page.rows.collect() == wanted, (sort, filters)
        assert page.files == 16 and page.files_read <= most
    one = browsing.browse_saved(spark, path, sort=sort, search="pull_3999", limit=5)
    assert one.rows.count() == 1 and one.files_read < 16
