from __future__ import annotations

import random

import pytest

from ledgerloom.llm import url_filter


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path


def brute(url, rules, default="allow"):
    host, path = place(url)
    best = {}
    for h, p, v in rules:
        h, p = "".join(c.lower() if "A" <= c <= "Z" else c for c in h or ""), p or ""
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), h + p)
            best[key] = max(best.get(key, v), v)
    if not best:
        return host, path, None, default
    key = max(best)
    return host, path, key[2], best[key]


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "k", "h") for i, u in enumerate(urls)], "page_id bigint, url string, key string, host string")
    df = url_filter.judge_urls(pages.repartition(4), spark.createDataFrame(rules, "host string, path string, verdict string"), **options)
    assert df.columns[:4] == pages.columns
    return {r.page_id: (r["__host"], r["__path"], r["__rule"], r["__verdict"]) for r in df.collect()}


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block")]


def test_named_cases(spark):
    urls = ["http://WWW.Example.com/en/1?q#f", "http://a.example.com/en/1", "http://example.com/EN/", "http://example.com", "x", None, "",
            "http://notexample.com/en/", "https://b.net/es/x", "https://b.net/es", "ftp://net/fr/", "http://c.net?/es/", "://com/", "a://b://com/",
            "http://www.example.com.evil.org/en/", "http://com./", "http://.com/", "http://example.com\n/en/\n", "http://u@example.com:80/en/",
            "http://" + "a." * 5000 + "example.com/en/" + "p" * 100_000, "http://www.example.com/en/1"]
    got = judged(spark, urls, RULES)
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}
    assert got[0][2:] == ("www.example.com/en/", "allow") and got[1][2:] == ("example.com/en/", "block") and got[4] == ("", "", None, "allow")


@pytest.mark.parametrize("seed", range(3))
def test_random_rules_equal_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(url_filter, "RANGES", 40)  # many ranges: rules reach over their ends
    host = lambda n: ".".join(rng.choice(["a", "b", "c-d", "aa", "a!", "é", ""]) for _ in range(rng.randint(1, n)))
    path = lambda n: "".join(rng.choice(["/", "/a", "/b", "é", "/A/"]) for _ in range(rng.randint(0, n)))
    rules = [(host(4), path(3), rng.choice(["allow", "block"])) for _ in range(150)] + [("", "/a", "block"), (None, "", "allow"), ("A.b", None, "block")]
    urls = [rng.choice(["http://", "HTTPS://", ""]) + host(6) + path(5) + rng.choice(["", "?x=/a", "#/b"]) for _ in range(600)]
    urls += ["http://a.b/a/b"] * 300  # a hot url
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}
    few = [r for r in rules if r[0]][:5]
    assert judged(spark, urls, few, default="block") == {i: brute(u, few, "block") for i, u in enumerate(urls)}


def test_without_rules_and_without_pages(spark):
    assert judged(spark, ["http://a.com/", None], []) == {0: ("a.com", "/", None, "allow"), 1: ("", "", None, "allow")}
    pages = spark.createDataFrame([], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge_urls(pages, rules).count() == 0


def test_wide_rules_are_copied_once_a_range(spark):
    rules = spark.createDataFrame([("", "", "allow"), ("com", "/", "block")], "host string, path string, verdict string")
    urls = spark.createDataFrame([(f"h{i}.com", "/x") for i in range(500)], "host string, path string")
    found = url_filter.match_places(urls, rules).collect()
    assert len(found) == 500 and {r.rule for r in found} == {"com/"}
