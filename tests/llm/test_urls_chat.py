from __future__ import annotations

import re

from tracemill.llm import chat, url_filter

URLS = [
    "https://a.example.net/en/1", "http://EXAMPLE.net/en/", "http://x.net/", "http://x.net", "http://net/x?y=1", "http://xnet/a",
    "https://example.com/de/1#f", "https://www.example.com/fr/2", "http://b.org/fr/", "http://b.org/FR/", "no scheme", "", None,
    "ftp://h/p://q/", "http://É.Example.COM:80/de/é?x#y", "://h/de/", "http://notexample.net/en/1", "http://a?b/en/", "x" * 3000 + "://" + "y" * 3000,
]
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits, key=len, default=None)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "html", "h", 1.0) for i, u in enumerate(urls)], "page_id long, url string, html string, host string, length double")


def test_rules_and_parts(spark):
    out = url_filter.judge(pages(spark, URLS * 3)).collect()
    assert len(out) == 3 * len(URLS)
    for r in out:
        host, path, rule = plain((URLS * 3)[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == RULES[rule])
    assert len({(r["host"], r["path"], r["verdict"]) for r in out}) <= len(URLS)


def test_trees_learn_lexical_labels(spark):
    bad = [f"http://win-{i}-free-{i * 37 % 1000}.biz/a/b/{i}?x={i}&y=2&z=3" for i in range(150)]
    good = [f"https://site{i % 7}.info/page" for i in range(150)]
    labelled = spark.createDataFrame([(u, 1) for u in bad[::2]] + [(u, 0) for u in good[::2]] + [(None, 1), ("x", None)], "url string, blocked int")
    out = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages(spark, bad + good), labelled=labelled).collect()}
    right = sum(out[i] == ("block" if i < 150 else "allow") for i in out)
    assert right >= 295


def test_without_labels_and_empty(spark):
    assert {r["verdict"] for r in url_filter.judge(pages(spark, ["http://b.com/x", None])).collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge(pages(spark, ["http://b.com/x", "http://c.net/"])).collect()} == {"block"}
    assert url_filter.judge(pages(spark, [])).count() == 0


def turns(spark, rows):
    return spark.createDataFrame([(*r, 9, "clash") for r in rows], "pair_id long, side string, turn long, role string, text string, at int, rest string")


def test_prefix_completions_and_masks(spark):
    rows = [(1, s, i, r, t) for s, last in (("chosen", "yes"), ("rejected", "no é")) for i, (r, t) in enumerate(
        [("user", "hi"), ("assistant", "hello"), ("user", "ok?"), ("assistant", last), ("user", "bye"), ("assistant", last * 2)])]
    r, = chat.preference_pairs(turns(spark, rows)).collect()
    assert r["common_turns"] == 3
    assert r["prompt"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nok?<|im_end|>\n"
    for side, last in (("chosen", "yes"), ("rejected", "no é")):
        spans = [tuple(map(int, s.split(":"))) for s in r[f"{side}_mask"].split(",")]
        assert [r[side][a:b] for a, b in spans] == [last, last * 2]


def test_chat_edges(spark):
    rows = [
        (1, "chosen", 0, "user", "a"), (1, "rejected", 5, "user", "a"),                                  # equal sides, other numbers
        (2, "chosen", 0, "user", "a"), (2, "rejected", 0, "user", "a"), (2, "rejected", 1, "assistant", "b"),
        (3, "chosen", 0, None, None), (3, "chosen", None, "assistant", "x"), (4, "rejected", 0, "user", "a"),
        (5, "chosen", 0, "user", "a"), (None, "chosen", 0, "user", "a"), (6, "other", 0, "user", "a"), (5, "chosen", 0, "user", "a"),
        (7, "chosen", 0, "user", "z" * 100_000), (7, "rejected", 0, "assistant", "z" * 100_000)]
    out = {r["pair_id"]: r for r in chat.preference_pairs(turns(spark, rows)).collect()}
    assert set(out) == {1, 2, 3, 5, 7}
    assert (out[1]["common_turns"], out[1]["chosen"], out[1]["rejected"]) == (1, "", "")
    assert (out[2]["common_turns"], out[2]["chosen"], out[2]["rejected_mask"]) == (1, "", "22:23")
    assert out[3]["chosen"].startswith("<|im_start|>assistant\nx") and "unknown\n<|im_end|>" in out[3]["chosen"]
    assert (out[5]["common_turns"], out[5]["prompt"], out[5]["rejected"]) == (0, "", "")
    assert out[7]["common_turns"] == 0
    assert chat.preference_pairs(turns(spark, [])).count() == 0
