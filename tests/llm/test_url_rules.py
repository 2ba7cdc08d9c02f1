import random

from lorebase.llm.url_rules import Rule, judge_urls

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def parts(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return host.translate(UPPER), path


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block"))
    return host, path, best.host + best.path, best.verdict


def check(spark, urls, rules, default="allow", table=False):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "'x' AS key", "1 AS task", "'y' AS verdict"
    )
    given = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string") if table else rules
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, given, default).collect()}
    assert got == {i: brute(u, rules, default) for i, u in enumerate(urls)}


def test_odd_urls(spark):
    rules = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "b.example.net", ""), Rule("allow", "net", "/en/")]
    urls = [
        None, "", "example.net/en/", "http://", "http://EXAMPLE.net/en/a?x#y", "https://a.b.example.net", "x://netnet/en/", "x://.net/",
        "http://a..example.net/en/", "http://example.net?u=http://org/", "http://example.net:80/en/", "http://é.example.net/en/é", "ftp://net#/x", "a://b://net/",
        "http://" + "a." * 3000 + "example.net/" + "p" * 50000,
    ]
    check(spark, urls + urls, rules)


def test_many_nested_rules_and_one_hot_host(spark):
    rnd = random.Random(3)
    hosts = ["c", "b.c", "a.b.c", "x.a.b.c", "ab.c", "b.cc", "d"]
    paths = ["", "/", "/p", "/p/", "/p/q", "/q"]
    rules = list({(h, p): Rule(rnd.choice(["allow", "block"]), h, p) for h in hosts for p in paths if rnd.random() < 0.6}.values())
    urls = [f"http://{rnd.choice(hosts + ['w.d', 'zz'])}{rnd.choice(paths)}{rnd.choice(['', 'x', '?q', '#f'])}" for _ in range(600)]
    check(spark, urls + ["http://a.b.c/p/q1"] * 400, rules, "block", table=True)


def test_ties_and_nothing(spark):
    check(spark, ["http://ab.c/de/x", "http://ab.c/"], [Rule("block", "c", "/de/"), Rule("allow", "ab.c", "/")])
    check(spark, ["http://ab.c/x"], [Rule("allow", "ab.c", "/"), Rule("block", "ab.c", "/")])
    check(spark, ["http://ab.c/x"], [])
    check(spark, ["http://ab.c/x"], [Rule("block", None, "/")] and [])
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(empty, [Rule("block", "net", "/")]).count() == 0
