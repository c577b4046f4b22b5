import re

import pytest

from loanlake.llm import url_rules as ur
from loanlake.llm.queries import LISTED_RULES

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/en/1", "https://example.net/EN/1",
    "http://example.net/en", "http://a.example.com/de/x?y=1", "http://notexample.com/de/", "http://x.org/fr/1#t",
    "http://x.org?q=/fr/", "http://net/", "http://net", "http://a.net#/x", "ftp://u.example.com/de/://b.net/en/",
    "http://É.NET/ÀB", "http://x.org/fr/" + "a/" * 20_000, "http://x.org/\n/fr/",
]


def brute(url):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3 :]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest)[0])
    path = re.match("[^?#]*", rest[len(host) :])[0]
    fits = [r for r in LISTED_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, n string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bad boolean")


def test_listed_rules(spark):
    rows = [*enumerate(URLS), (None, "http://x.net/"), (5, URLS[5])]
    found = ur.filter_urls(pages(spark, rows), labels(spark, []), LISTED_RULES).collect()
    want = []
    for i, url in rows:
        host, path, rule, verdict = brute(url)
        want.append((i, host, path, rule, verdict or "allow"))
    assert sorted([tuple(r)[:5] for r in found], key=str) == sorted(want, key=str)


def mined_corpus():
    rows, marks = [], []
    for i in range(600):
        bad = i % 3 == 0
        host = "casino.example.org" if bad and i % 2 else f"site{chr(97 + i % 20)}.example.org"
        part = "win" if bad and not i % 2 else "news"
        rows.append((i, f"http://{host}/{part}/{i}"))
        if i % 4:
            marks.append((i, bad and i % 30 != 9))
    return rows, [*marks, (None, True), (700, True), (1, None)]


def test_mined_rules(spark):
    rows, marks = mined_corpus()
    found = ur.filter_urls(pages(spark, rows), labels(spark, marks), []).collect()
    assert {r["page_id"] for r in found if r["verdict"] == "block"} == {i for i in range(600) if i % 3 == 0}
    tokens = {x for r in found if r["mined_rule"] for x in r["mined_rule"]}
    assert {"h:casino", "p:win"} <= tokens
    assert all(r["confidence"] >= 0.6 for r in found if r["mined_rule"])


def test_rules_match_as_by_brute_force(spark):
    rows, marks = mined_corpus()
    kept = pages(spark, rows).select("page_id", ur.url_tokens(ur.F.col("url")).alias("tokens"))
    train = kept.join(labels(spark, marks), "page_id")
    rules = ur.mine_rules(train)
    known = [(set(r["tokens"]), r["confidence"], r["support"]) for r in rules.collect()]
    baskets = [(set(r["tokens"]), bool(r["bad"])) for r in train.collect()]
    for tokens, confidence, support in known:
        holds = [bad for own, bad in baskets if tokens <= own]
        assert confidence == pytest.approx(sum(holds) / len(holds)) and support == pytest.approx(sum(holds) / len(baskets))
    patterns = kept.select("tokens").distinct()
    matched = {tuple(r["tokens"]): r["confidence"] for r in ur.match_rules(patterns, rules).collect()}
    for (own,) in patterns.collect():
        best = max((c for tokens, c, _ in known if tokens <= set(own)), default=None)
        assert matched.get(tuple(own)) == best


def test_empty(spark):
    assert ur.filter_urls(pages(spark, []), labels(spark, []), LISTED_RULES).count() == 0


def test_no_python_in_the_plan(spark):
    rows, marks = mined_corpus()
    plan = ur.filter_urls(pages(spark, rows), labels(spark, marks), LISTED_RULES)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
