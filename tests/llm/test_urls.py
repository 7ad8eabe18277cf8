"""URL filter: rules against brute force, both ways to look them up, the model on words it has not seen in their place."""

import random

import numpy as np
import pytest

from loomstat.llm import queries, url_filter
from loomstat.llm.queries_urls import RULES

SCHEMA = "page_id bigint, url string, html string, host string, path string, rule string, score string, verdict string, n int, said string, widths string"
RULE_SCHEMA = "host string, path string, verdict string, note string"
ODD = [None, "", "no scheme", "://", "http://", "HTTP://ExAmple.NET/en/x", "a://B.example.com?q=/de/", "a://b.example.com#x", "x://y://z/w", "http://net", "http://net/"]
ODD += ["http://org/fr/", "http://evilnet/", "http://a.org/fr", "http://x.example.net/EN/", "http://É.net/é?", "line\nbreak://h.net/a\nb#c", "http://.net/", "http://a..net/", "http://net./"]


def brute(url, rules):
    """(host, path, rule, verdict) by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else None


def made_rules(seed, n):
    rng = random.Random(seed)
    hosts = ["net", "example.net", "a.example.net", "org", "b.org", "h.com", "com"]
    keys = {(rng.choice(hosts), rng.choice(["", "/", "/a", "/a/b", "/ab/c", "/a/b/c"])) for _ in range(n)}
    return [(h, p, rng.choice(["allow", "block"])) for h, p in sorted(keys)]


def made_urls(seed, n):
    rng = random.Random(seed)
    hosts = ["net", "x.net", "www.example.net", "A.example.net", "q.a.example.net", "b.org", "c.b.org", "h.com", "other.de", "xnet"]
    return ODD + [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/a/b/c/d', '/ab/c', '/abc', '?a', '/a#b'])}" for _ in range(n)]


def frame(spark, urls):
    rows = [(i if i % 7 else None, u, None, "h", "p", None, "s", None, 1, "x", "y") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("in_task", [1000, 0])
def test_rules_equal_brute_force(spark, in_task):
    rules, urls = made_rules(1, 25), made_urls(2, 300)
    table = spark.createDataFrame([(h.upper(), p, v, "n") for h, p, v in rules] + [("", "/", "block", None), (None, "/", "block", None), ("net", "/", None, None)], RULE_SCHEMA)
    found = url_filter.judge(frame(spark, urls + urls[:50]), table, None, rules_in_task=in_task).collect()
    want = [(*brute(u, rules)[:3], brute(u, rules)[3] or "allow") for u in urls + urls[:50]]
    assert sorted((r.host, r.path, r.rule or "", r.verdict) for r in found) == sorted((h, p, r or "", v) for h, p, r, v in want)
    assert sum(r.page_id is None for r in found) == len([i for i in range(len(want)) if i % 7 == 0])


def test_contract_rules(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = url_filter.judge(frame(spark, ["http://casino-bets.example.com/"] + ODD), rules, model).collect()
    assert sorted((r.host, r.path, r.rule or "") for r in found) == sorted((*brute(u, RULES)[:2], brute(u, RULES)[2] or "") for u in ["http://casino-bets.example.com/"] + ODD)
    got = {r.host: r for r in found if r.rule is None}
    assert got["casino-bets.example.com"].verdict == "block" and got["a.org"].verdict == "allow" and got[""].verdict == "allow"


def test_rules_said_twice_allow_and_empty_tables(spark):
    rules = spark.createDataFrame([("net", None, "block"), ("NET", "", "allow")], "host string, path string, verdict string")
    found = url_filter.judge(frame(spark, ["http://a.net/x"]), rules, None).collect()
    assert [(r.rule, r.verdict) for r in found] == [("net", "allow")]
    for in_task in (1000, 0):
        assert url_filter.judge(frame(spark, []), rules, None, rules_in_task=in_task).collect() == []
        none = url_filter.judge(frame(spark, ODD), rules.limit(0), None, rules_in_task=in_task).collect()
        assert len(none) == len(ODD) and {r.rule for r in none} == {None}


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES["op11_url_filter"](spark, folder).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert sorted(r.page_id for r in found) == sorted(urls)
    for r in found:
        host, path, rule, verdict = brute(urls[r.page_id], RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
        assert rule is not None or r.verdict == ("block" if r.score >= url_filter.BLOCK_FROM else "allow")


def test_model_on_urls_it_has_not_seen(spark):
    """Blocked words in new places, and new ordinary hosts."""
    model = url_filter.fit(url_filter.labelled_urls(spark))
    bad = [f"https://{h}.example.org/x/{i}" for i, h in enumerate(["best-casino", "mypokersite", "online-viagra", "adserver-eu", "torrent-hub", "payday-now", "xxxvideos"])]
    good = [f"https://{h}.example.org/x/{i}" for i, h in enumerate(["m.morning-tea", "thinkers", "blog.oldbarn", "lakeside-walks", "quietstones", "ththre", "tionble"])]
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    found = {r.page_id: r.score for r in url_filter.judge(spark.createDataFrame(list(enumerate(bad + good)), "page_id bigint, url string"), rules, model).collect()}
    blocked = [found[i] >= url_filter.BLOCK_FROM for i in range(len(bad + good))]
    assert sum(blocked[: len(bad)]) >= len(bad) - 1 and sum(blocked[len(bad) :]) == 0
    held = {r.url for r in url_filter.labelled_urls(spark).collect()}
    assert not held & set(bad + good)


def test_fit_needs_both_classes_and_keeps_its_bound(spark):
    one = spark.createDataFrame([("http://a.com/", 1), (None, 1), ("x", None), ("y", 7)], "url string, label int")
    assert url_filter.fit(one) is None
    assert url_filter.fit(url_filter.labelled_urls(spark), per_class=3) is not None


def test_features_do_not_cross_rows_or_parts():
    code, row = url_filter.features(["ab", "", "ab"], ["/c", "", "/c"])
    sets = [code[row == i].tolist() for i in range(3)]
    assert sets[0] == sets[2] and len(sets[1]) == 0 and len(sets[0]) == len(set(sets[0])) == 2 * (2 + 1)
    long = url_filter.features(["a" * 3_000_000], ["/"])[0]
    assert len(np.unique(long)) < 12
