import random
import re

from pyspark.sql import functions as F

from cartlake.llm import urls

SCHEMA = "page_id long, url string, html string, rule string, part int, host string"


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def addresses():
    rng = random.Random(8)
    hosts = ["net", "example.net", "a.example.net", "EXAMPLE.com", "x.org", "org", "xorg", "", "net.", "example.net:80", "b.a.example.net", ".net"]
    paths = ["", "/", "/en/", "/en", "/en/x/y", "/de/1", "/fr/", "/fr/a?b", "?q=/en/", "#f", "/en/#x"]
    out = [None, "", "net/", "http:/net/", "http://", "://net/a", "x://y://net/"]
    return out + [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + ["https://example.net/en/hot"] * 200


def check(spark, rules, ranges):
    rows = [((1 << 60) + i, u, "h", "r", 1, "h") for i, u in enumerate(addresses())]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    listed = spark.createDataFrame([*rules, (None, "org", "/"), ("block", None, "/")], "verdict string, host string, path string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(table, listed, ranges=ranges).collect()}
    assert got == {r[0]: brute(r[1], rules) for r in rows}


def test_fixed_rules(spark):
    for ranges in (1, 7):
        check(spark, urls.RULES, ranges)


def test_nested_rules(spark):
    rng = random.Random(9)
    rules = {}
    for _ in range(60):
        host = rng.choice(["net", "example.net", "a.example.net", "org", "x.org", "com"])
        path = rng.choice(["/", "/e", "/en", "/en/", "/en/x", "/en/x/", "/d", "/de/", "/fr", ""])
        rules[host, path] = rng.choice(["allow", "block"])
    # among rules of one length the tests want one winner
    check(spark, [(v, h, p) for (h, p), v in rules.items() if h != "x.org"], 5)


def test_odd_rows_and_no_rows(spark):
    rules = urls.fixed_rules(spark)
    odd = spark.createDataFrame([(None, None), (1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    assert sorted((r["verdict"] for r in urls.judge(odd, rules).collect())) == ["allow", "block", "block"]
    assert urls.judge(odd.limit(0), rules).collect() == []


def test_a_hot_url_is_spread(spark):
    others = [(i, f"https://h{i % 97}.example.org/p{i}") for i in range(2000)]
    hot = "https://www.example.net/en/start"
    for ids in (range(5000, 6000), [5000] * 1000):  # own ids; exact copies
        pages = spark.createDataFrame(others + [(i, hot) for i in ids], "page_id long, url string").repartition(4)
        judged = urls.judge(pages, urls.fixed_rules(spark), ranges=20)
        counts = [r["count"] for r in judged.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(counts) == 3000
        assert max(counts) < 400 and len(counts) >= 18, counts
