"""Operator 12 against plain sets and plain string handling."""

import re

from pyspark.sql import functions as F

from quillstone.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def verdict(url, listed):
    host, path = parts(url)
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, key=lambda r: len(r[0]), default=(None, None))
    return host, path, rule[0], rule[1] or ("block" if host + path in listed else "allow"), host + path in listed


URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://WWW.Example.ORG/es/a?b#c", "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/", "http://example.org?x=/es/", "http://org/", "http://org", "http://xorg/", "x://a.com/fr/1#:",
    "http://a.com/fr", "http://com/de/", "http://b.com/de/?q", "http://a.net//x//", "http://a.net/ü\n/z?y", "http://Ä.NET/q", "a://b://c.com/fr/", "http://spam-farm.net/1", "http://spamfarm.net/1", "http://www.casino.com/x", "http://casino.org/x", "http://long.net/" + "a/" * 100_000,
]


def test_rules_and_parts(spark):
    rows = [(i, u, "h", "p", "k", 1) for i, u in enumerate([*URLS, URLS[5], URLS[21]])]
    pages = spark.createDataFrame([*rows, (None, "http://a.net/", "h", "p", "k", 1)], "page_id long, url string, host string, path string, key string, listed int")
    listed = {"a.net//x//", "b.com/de/", "long.net/" + "a/" * 100_000, "nowhere.net/"}
    got = U.judge_urls(pages, spark.createDataFrame([(k,) for k in [*listed, *listed, None]], "key string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *verdict(r[1], listed))) for r in [*rows, (None, "http://a.net/")])


def test_empty_table_and_empty_list(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(none, U.junk_list(none)).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert [r.verdict for r in U.judge_urls(some, none.select(F.lit("").alias("key"))).collect()] == ["allow"]
    assert [r.verdict for r in U.judge_urls(some, some.select(F.lit("a.net/x").alias("key"))).collect()] == ["block"]


def test_cascade_is_exact_and_small(spark):
    """200,000 keys, of which every 40th is listed: no key is wrong, though the first level alone lets some through; the filter is far smaller than the list."""
    keys = U.materialize(spark.range(200_000).select(F.concat(F.lit("host"), F.col("id").cast("string"), F.lit("/p")).alias("key"), (F.col("id") % 40 == 0).alias("listed")))
    cascade = U.build_cascade(keys)
    wrong = keys.filter(cascade.listed(F.col("key")) != F.col("listed")).count()
    first = keys.filter(cascade.levels[0].holds(F.col("key")) & ~F.col("listed")).count()
    assert wrong == 0 and first > 500 and len(cascade.levels) > 2
    assert cascade.size_bytes < 5_000 * 3


def test_cascade_of_none_and_all(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    for flag in (True, False):
        cascade = U.build_cascade(keys.withColumn("listed", F.lit(flag)))
        assert keys.filter(cascade.listed(F.col("key")) != F.lit(flag)).count() == 0


def test_a_list_beyond_the_bound_is_joined(spark, monkeypatch):
    rows = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("key"), F.lit(1).alias("_found"))
    listed = spark.range(0, 6000, 5).select(F.col("id").cast("string").alias("key"))
    one = sorted(map(repr, U.with_membership(rows.drop("_found"), "key", listed).collect()))
    monkeypatch.setattr(U, "MAX_BYTES", 100)
    assert sorted(map(repr, U.with_membership(rows.drop("_found"), "key", listed).collect())) == one
    assert sum("listed=True" in x for x in one) == sum(i % 7 > 0 and i % 5 == 0 for i in range(3000))


def test_no_python_and_no_join(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    plan = U.judge_urls(pages, U.junk_list(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Subquery" in plan
