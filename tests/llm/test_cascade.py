from __future__ import annotations

import pytest
from fairgauge.llm import cascade
from fairgauge.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://net", "http://net/", "http://NET/x", "https://a.Net:80/x", "http://xnet/", "ftp://example.net/en/x?y",
        "http://a.example.net/en", "http://a.example.net/en/", "http://a.example.com/de/1#x", "http://example.com/fr/", "x://org/fr/a",
        "http://deep.er.org/fr/?q", "http://org?fr/", "http://org#/fr/", "http://a.org/fr/://net/", "://net/en/", "http:///en/", "http://net//",
        "http://.net/", "http://..net/x", "http://" + "a." * 20_000 + "net/" + "p" * 50_000, "http://net/\u00e9\U0001f600/en/", "HTTP://ORG/FR/"]


def brute_force(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "h", "v") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in cascade.filter_urls(pages, URL_RULES).collect()}
    assert len(got) == 2 * len(URLS)
    for i, u in enumerate([*URLS, *URLS]):
        assert got[i] == brute_force(u), u


def test_no_rules_and_empty(spark):
    pages = spark.createDataFrame([(None, "http://net/"), (1, None)], "page_id long, url string")
    assert {r.verdict for r in cascade.filter_urls(pages, ()).collect()} == {"allow"}
    assert cascade.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_membership_is_exact_at_every_level(spark, monkeypatch):
    monkeypatch.setattr(cascade, "BITS_PER_KEY", 6.0)  # weak filters: many levels
    universe = spark.range(4000).selectExpr("concat('k', id) AS key")
    listed = spark.range(0, 5000, 7).selectExpr("concat('k', id) AS key")
    built = cascade.Cascade.build(listed, universe)
    assert len(built.levels) > 2
    got = {r.key for r in universe.unionByName(listed).where(built.lists(universe["key"])).collect()}
    assert got == {r.key for r in listed.collect()}


def test_size_is_checked(spark):
    keys = spark.range(1000).selectExpr("cast(id AS string) AS key")
    with pytest.raises(ValueError):
        cascade.Cascade.build(keys, keys, max_words=10)
