from __future__ import annotations

import re

import pytest

from opinara.llm import urls

CASES = [
    ("HTTP://A.Example.NET/en/1?x=/#y", "a.example.net", "/en/1", "example.net/en/"),
    ("http://example.net/de/", "example.net", "/de/", "net/"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/"),
    ("http://net/", "net", "/", "net/"),
    ("http://a.net", "a.net", "", None),
    ("http://planet/", "planet", "/", None),
    ("https://x.example.com/de", "x.example.com", "/de", None),
    ("https://x.example.com/de/#f", "x.example.com", "/de/", "example.com/de/"),
    ("http://w.org/fr/a://b/", "w.org", "/fr/a://b/", "org/fr/"),
    ("http://w.org?/fr/", "w.org", "", None),
    ("mailto:x", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("a://B\u00c9.org/fr/", "b\u00c9.org", "/fr/", "org/fr/"),
    ("x://" + "long" * 3000 + "/p", "long" * 3000, "/p", None),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, c[0], "h", "s") for i, c in enumerate(CASES)] + [(None, "http://e.org/en/", "h", "s")]
    return urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, text string")).collect()


def test_hosts_paths_and_rules(judged):
    got = {r.page_id: (r.host, r.path, r.rule) for r in judged if r.page_id is not None}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}
    for r in judged:
        assert r.verdict == urls.RULES.get(r.rule, r.verdict) and r.verdict in ("allow", "block")
    assert len(judged) == len(CASES) + 1


def test_model_tells_kinds_apart(spark):
    """Urls without a rule follow the kind whose characters they share."""
    rows = []
    for i in range(300):
        rows.append((i, f"http://s{i}.example.net/en/garden-flowers-{i}"))
        rows.append((1000 + i, f"http://s{i}.example.net/de/casino-win-{i}"))
    rows += [(5000, "http://q.example.org/xx/garden-flowers-7"), (5001, "http://q.example.org/xx/casino-win-7")]
    found = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (found[5000], found[5001]) == ("allow", "block")


def test_strings_of_long_texts(spark):
    text = "".join(chr(97 + i * 7 % 26) for i in range(1000)) + "é"
    found = urls.strings(spark.createDataFrame([(text,), ("",)], "text string"), "text").collect()
    whole = urls.START * urls.ORDER + text + urls.END
    want = sorted(whole[i : i + urls.ORDER + 1] for i in range(len(text) + 1))
    assert sorted(r.string for r in found if r.text) == want
    assert [r.string for r in found if not r.text] == [urls.START * urls.ORDER + urls.END]


def test_only_dataframe_functions(spark):
    frame = spark.createDataFrame([(1, "http://a.org/en/")], "page_id long, url string")
    plan = urls.judge(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_without_taught_urls_and_empty(spark):
    frame = spark.createDataFrame([(1, "http://a.example.com/en/")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(frame).collect()] == ["allow"]
    assert urls.judge(frame.limit(0)).count() == 0
