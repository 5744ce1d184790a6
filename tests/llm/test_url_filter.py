from __future__ import annotations

import numpy as np
import pytest

from ledgerlark.llm import url_filter
from ledgerlark.llm.url_filter import RULES, DigestArray, candidates, filter_urls

RULE_SCHEMA = "host string, path string, verdict string"
URLS = {
    "http://example.net/x": ("example.net", "/x", "net/", "block"),
    "http://example.net/en/x?q#f": ("example.net", "/en/x", "example.net/en/", "allow"),
    "https://A.B.Example.NET/en/": ("a.b.example.net", "/en/", "example.net/en/", "allow"),
    "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
    "http://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
    "http://example.com/DE/1": ("example.com", "/DE/1", None, "allow"),
    "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
    "http://net": ("net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://a.net:80/": ("a.net:80", "/", None, "allow"),
    "http://a.net?x=http://b.net/": ("a.net", "", None, "allow"),
    "mailto:a@b.net": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "http://ÄB.net/\nx": ("Äb.net", "/\nx", "net/", "block"),
    "http://" + "a." * 500 + "net/" + "p" * 5000: ("a." * 500 + "net", "/" + "p" * 5000, "net/", "block"),
}


def pages(spark, urls):
    rows = [(i, u, "h", "clash") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")


@pytest.mark.parametrize("most", [url_filter.MAX_SENT_RULES, 0])
def test_verdicts(spark, most):
    urls = [*URLS, None, "http://net/", "http://net/"]
    rules = spark.createDataFrame([*RULES, ("net", "/", "allow")], RULE_SCHEMA)
    got = sorted(map(tuple, filter_urls(pages(spark, urls), rules, max_sent_rules=most).collect()))
    want = [(i, *URLS.get(u, ("", "", None, "allow"))) for i, u in enumerate(urls)]
    assert got == want


@pytest.mark.parametrize("most", [url_filter.MAX_SENT_RULES, 0])
def test_empty_tables(spark, most):
    rules = spark.createDataFrame([], RULE_SCHEMA)
    some = pages(spark, ["http://net/"])
    assert [r.verdict for r in filter_urls(some, rules, max_sent_rules=most).collect()] == ["allow"]
    assert filter_urls(some.limit(0), rules, max_sent_rules=most).collect() == []


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(url_filter, "digests", lambda strings: np.full(len(strings), 7, np.uint64))
    array = DigestArray(["a/", "b/", "c/"])
    assert [array.strings[i] if i >= 0 else None for i in array.probe(["c/", "x/", "a/"])] == ["c/", None, "a/"]


def test_candidates():
    assert candidates("a.b", "/x", [1, 2, 3]) == ["a.b/", "a.b/x", "b/", "b/x"]
    assert candidates("", "/x", [1]) == []
