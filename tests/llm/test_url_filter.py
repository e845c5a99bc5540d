"""Page verdicts against a loop over the list, and what the Bloom filter lets through."""

import re

import pytest

from sideline.llm import bloom, url_filter
from tests.llm.brute import lower

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    "http://a.example.net/en/1", "https://B.Example.NET/fr/?q=://x", "http://example.net", "http://example.net?x=/en/", "http://example.net/en", "ftp://x.org/fr/#a",
    "http://notexample.com/de/", "http://example.com/de/", "http://EXAMPLE.com/DE/", "http://example.com/de/x?y#z", "no scheme", "", None, "://", "://net/", "http:///path",
    "a://b.net/c://d.org/fr/", "http://xnet/", "http://net/", "http://.net/", "http://a\nb.net/\n?", "http://ÄB.net/é", "http://example.com./de/", "http://" + "x." * 5000 + "net/" + "p" * 100_000,
]


def _judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = lower(re.split("[/?#]", rest, maxsplit=1)[0])
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def _run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "h", "k") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string, key string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge(pages, listed)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()), key=lambda r: r[0])


MANY = [(f"{'a.' * (i % 7)}example.net", "/" + "en/" * (i % 3) + "p" * (i // 3), ("block", "allow")[i % 2]) for i in range(3000)]


@pytest.mark.parametrize("rules", [RULES, [], [("", "", "block")], [("", "/x", "block"), ("net", "", "block")], RULES + [("b.example.net", "/fr", "allow"), ("a.example.net", "/en/1", "block"), ("net", "/", "allow")]])
def test_verdicts(spark, rules):
    strict = {(h, p): min(v for a, b, v in rules if (a, b) == (h, p)) for h, p, _ in rules}
    want = [(i, *_judge(u, [(h, p, v) for (h, p), v in strict.items()])) for i, u in enumerate(URLS + URLS[:3])]
    assert _run(spark, URLS + URLS[:3], rules) == want


def test_a_list_of_any_shape(spark):
    """Thousands of path lengths and host labels: nothing is refused."""
    urls = [f"http://{'a.' * (i % 9)}example.net/{'en/' * (i % 3)}{'p' * (i * 7 % 1100)}/x" for i in range(60)] + [None, "", "http://b.net/"]
    strict = {(h, p): min(v for a, b, v in MANY if (a, b) == (h, p)) for h, p, _ in MANY}
    assert len({(h.count("."), len(p)) for h, p, _ in MANY}) > 1000
    assert _run(spark, urls, MANY) == [(i, *_judge(u, [(h, p, v) for (h, p), v in strict.items()])) for i, u in enumerate(urls)]


def test_empty_pages(spark):
    assert _run(spark, [], RULES) == []


def test_filter_lets_every_listed_key_through_and_few_others(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    words = 500
    made = bloom.bloom_words(keys, "key", words)
    assert len(made.first()[0]) == words
    view = spark.range(30_000).selectExpr("id", "concat('k', id) AS key").withColumn("w", made.scalar())
    passed = {r.id for r in view.filter(bloom.may_contain("w", "key", words)).select("id").collect()}
    assert set(range(3000)) <= passed and len(passed) < 3000 + 0.1 * 27_000
