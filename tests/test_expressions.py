"""Edge cases of the column expressions, with values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracemill.functions import paths, text
from tracemill.operators import features, traces


def evaluate(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, v string").select("i", expression(F.col("v")).alias("r"))
    return [r["r"] for r in out.orderBy("i").collect()]


def test_file_ext(spark):
    cases = {
        "a.py": ".py", ".py": "", "dir.d/x": "", "..a.b": ".b", "a.b.TS": ".ts", "x.tar.gz": ".gz", "a.": ".", "": "",
        "...": "", "d/.gitignore": "", "noext": "", "/": "",
    }
    assert evaluate(spark, cases, paths.file_ext) == list(cases.values())


def test_other_extensions(spark):
    assert evaluate(spark, ["a.b/c", "x.PY", "none", None, "a/.env"], paths.tail_extension) == [
        ".b/c", ".PY", "", "", ".env"]
    assert evaluate(spark, ["a.b/c", "x.PY", "none", None, "a/.env", "b."], paths.path_suffix) == [
        "[none]", ".py", "[none]", "[none]", "[none]", "[none]"]


def test_path_kinds(spark):
    assert evaluate(spark, ["x/Pipfile.lock", "pipfile.lock", "go.sum", "a/go.sum.txt"], paths.is_lockfile) == [
        True, False, True, False]
    assert evaluate(spark, ["oxygen/a.py", "src/a.pb.go", "a/Vendor/b.c", "src/a.py"], paths.is_generated_or_vendor) == [
        True, True, True, False]
    assert evaluate(spark, ["Docs/a.py", "README.MD", "a/CHANGELOG", "src/a.py", "doc.py"], paths.is_doc_file) == [
        True, True, True, False, False]
    assert evaluate(spark, ["a.h", "a.hpp", "a.cs", "a.tsx", "a.md"], paths.source_language) == [
        "c/c++", "c++", "c#", "typescript", None]


def test_bot_login(spark):
    logins = ["renovate-x", "my[bot]", "DependaBot", "human", None, "", "bot"]
    assert evaluate(spark, logins, text.is_bot_login) == [True, True, True, False, False, False, False]


def test_meaningful_comment(spark):
    bodies = [
        "x" * 30, "x" * 29, " " * 40 + "lgtm" + "\n" * 9, " " * 10 + "x" * 30, None, "",
        "　" + "x" * 29, "\x1c" + "y" * 30, "İ" * 15, "İ" * 14,
    ]
    # A dotted capital I lower-cases to two code points.
    expected = [len((b or "").strip().lower()) >= 30 for b in bodies]
    assert evaluate(spark, bodies, text.is_meaningful_comment) == expected
    assert expected[8] is True and expected[9] is False


def test_linked_issue(spark):
    rows = {
        "Fixes #12": 12, "prefixes #1": None, "fix: #3": None, "closes  #4 fixes #5": 4, "RESOLVED\n#6": 6, "nothing": None,
    }
    assert evaluate(spark, rows, lambda c: text.linked_issue_number(F.lit(None), c)) == list(rows.values())


def test_keys_and_names(spark):
    assert evaluate(spark, ["o/r/x"], lambda c: text.example_id(c, F.lit(7))) == ["o__r__x__pull_7"]
    assert evaluate(spark, ["o/r/x"], text.repo_short_name) == ["r/x"]
    assert evaluate(spark, ["c++", "c/c++", "c#", "--", "A B"], text.safe_name) == [
        "cplusplus", "c_cplusplus", "csharp", "unknown", "a_b"]
    assert evaluate(spark, list(features.LANGUAGE_NAMES), text.safe_name) == list(features.LANGUAGE_NAMES.values())


def test_date_keys(spark):
    cases = {
        "2025-03-01T10:00:00Z": "2025-03-01", "2025-03-01": "2025-03-01", "bad": None, "": None, None: None,
        "2026-01-01T00:30:00+02:00": "2026-01-01", "2025-12-31 23:59:59.5-11:00": "2025-12-31", "2026": None, "2026-01": None,
        "2026-02-30": None, "20260201": "2026-02-01", "2026-0201": None, "2026-01-01T25": None, "2026-01-01T05": "2026-01-01", "x2026-01-01": None,
    }
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert evaluate(spark, list(cases), text.day_key) == list(cases.values())
        assert evaluate(spark, list(cases), text.month_key) == [v and v[:7] for v in cases.values()]
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("names,expected", [
    (["a.go", "b.py", "c.py", "d.go"], "go"), (["x.md"], "unknown"), ([], "unknown"), (["a.py", "b.go", "c.go"], "go"),
])
def test_top_language_of_array(spark, names, expected):
    schema = "files array<struct<filename:string>>"
    row = spark.createDataFrame([([(n,) for n in names],)], schema)
    assert row.select(features.top_language_of(F.col("files")).alias("l")).first()["l"] == expected


def test_source_patch_text(spark):
    files = [("a.py", "p1"), ("b.md", "p2"), ("c.go", None), ("d.go", ""), (None, "x"), ("e.go", "p3")]
    row = spark.createDataFrame([(files,)], "files array<struct<filename:string,patch:string>>")
    got = row.select(traces.source_patch_text(F.col("files")).alias("t")).first()["t"]
    assert got == "diff -- a.py\np1\ndiff -- e.go\np3"


def test_meaningful_comment_is_told_by_its_head_as_by_the_whole(spark):
    pads = ["", " ", " \n", " " * 29, "\t" * 31, " " * 59, " " * 60, "\xa0" * 61, " " * 200]
    cores = ["", "ok", "LGTM", "x" * 29, "x" * 30, "İ" * 14, "İ" * 15, "İ" * 29, "Σ" * 30, "a" + " " * 27 + "b",
             "a" + " " * 28 + "b", "a" + " " * 100 + "b", "\U0001f600" * 29, "\U0001f600" * 30, "y" * 500]
    bodies = [None, *(p + c + q for p in pads for c in cores for q in ("", " \n", " " * 70))]
    whole = lambda body: F.coalesce(
        (F.length(F.lower(text.strip(body))) >= 30) & ~F.lower(text.strip(body)).isin(text.TRIVIAL_PHRASES), F.lit(False))
    assert evaluate(spark, bodies, text.is_meaningful_comment) == evaluate(spark, bodies, whole)
    assert max(map(len, text.TRIVIAL_PHRASES)) < text.MEANINGFUL_LENGTH
