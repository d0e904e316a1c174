"""URL rules against plain Python, by file and by join."""

import pytest

from starloom.llm import url_filter
from starloom.llm.queries import BLOCKED_HOSTS, URL_RULES

URLS = [
    "http://example.com/en/1", "http://www.example.com/en/1", "https://a.www.EXAMPLE.com/en/", "http://example.com",
    "http://example.com/", "http://xexample.com/en/", "http://x.net/es/", "http://net/es/", "http://x.net/ES/",
    "https://x.net/fr/?q=://y.com/", "no scheme", "", None, "://", "://com/", "a://b://com/en/", "http://.com/x",
    "http://com./x", "http://spam-farm.example.org/", "https://m.spam-farm.example.org?x", "http://x.org:80/en/#f",
    "http://spam-farm.example.org", "http://é.com/é", "http://x.net/es/\nhttp://y", "http://example.com/en/1",
]


def judge(url, rules, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]

    def best(entries):
        fit = [(len(e), len(h), e, v) for e, v in entries for h in [e[: e.index("/")]]
               if (host == h or host.endswith("." + h)) and path.startswith(e[e.index("/"):])]
        return max(fit)[2:] if fit and host else (None, None)

    rule, verdict = best(rules)
    return host, path, rule, verdict or best(listed)[1] or "allow"


@pytest.mark.parametrize("most", [url_filter.MOST_ENTRIES, 0])
def test_against_python(spark, monkeypatch, most):
    lookup = url_filter.looked_up
    monkeypatch.setattr(url_filter, "looked_up", lambda df, entries, url="url": lookup(df, entries, url, most_entries=most))
    df = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(URLS)], "page_id int, url string, rule string, host string")
    rules = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    listed = [(f"{h}/", "block") for h in BLOCKED_HOSTS]
    got = url_filter.judged(df, rules, spark.createDataFrame(listed, "entry string, verdict string"))
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert found == {i: judge(u, URL_RULES, listed) for i, u in enumerate(URLS)}


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda text: len(text) % 2)
    data = url_filter.pack([("a.b/", "allow"), ("c.d/", "block"), ("e.fg/", "block")])
    assert url_filter.DigestList(data).find(["c.d/", "a.b/", "x.y/", "e.fg/"]) == ["block", "allow", None, "block"]


def test_empty_list_and_table(spark):
    none = spark.createDataFrame([], "entry string, verdict string")
    df = spark.createDataFrame([("http://x.com/",)], "url string")
    assert url_filter.judged(df, none, none).select("rule", "verdict").collect() == [(None, "allow")]
    assert url_filter.judged(df.limit(0), none, none).count() == 0
