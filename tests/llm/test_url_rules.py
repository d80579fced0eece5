"""Verdicts beside trying every rule, and the SQL."""

import random

from oracle_check import compare, connect

from plumbline.llm import queries, url_rules as U


def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0] or [len(path)])]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_verdicts_equal_trying_every_rule(spark):
    rng = random.Random(7)
    hosts = ["org", "example.org", "a.example.org", "com", "b.com", "x", "example.orgs"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/é/", "/a/b/c"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.5]
    urls = [f"http://{rng.choice(['', 'www.', 'A.', 'b.c.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '/q', '?x=/a', '#t', chr(0x10FFFF)])}" for _ in range(600)]
    urls += [None, "", "no scheme/a", "http://", "://org/", "http://org", "HTTP://ORG/A", "http://a..org/a", "x\ny://org/a\nb", "http://b.com:80/a", "http://org//a://org/b", "http://org/" + "a/" * 50_000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    rule_rows = spark.createDataFrame([*rules, (None, "/", "block"), ("org", None, "block")], "host string, path string, action string")
    want = {(i, *judge(u, rules)) for i, u in enumerate(urls)}
    for per_part in (5, 10_000):
        assert {tuple(r) for r in U.judge(pages, rule_rows, keys_per_part=per_part).collect()} == want
    assert {r.rule for r in U.judge(pages, rule_rows.limit(0)).collect()} == {None}
    assert U.judge(pages.limit(0), rule_rows).count() == 0


def test_block_wins_between_rules_alike(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c")], "page_id bigint, url string")
    rules = spark.createDataFrame([("a.b", "/c", "allow"), ("A.b", "/c", "block")], "host string, path string, action string")
    assert [(r.rule, r.verdict) for r in U.judge(pages, rules).collect()] == [("a.b/c", "block")] * 2


def test_queries_equal_sql(spark, sf):
    con = connect(sf)
    for name, sql in queries.ORACLES.items():
        assert compare(queries.QUERIES[name](spark, sf), con, sql) is None


def test_plan_has_no_python(spark, sf):
    plan = queries.QUERIES["op9_url_rules"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
