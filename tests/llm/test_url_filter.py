"""URL filter against plain Python on hand-made URLs."""

import pytest
from pyspark.sql import functions as F

from tabsieve.llm import url_filter as U
from tabsieve.llm.queries import URL_RULES

URLS = ["http://A.example.NET/en/1?x=1", "https://example.net/de/", "http://net/", "http://planet/", "http://x.org/fr",
        "http://x.org/fr/2#top", "http://example.com/de/x", "http://shop.com/a?b=2&a=1&utm_source=q#f",
        "https://WWW.shop.com:443/a/?a=1&b=2", "http://other.com", "http://other.com?x=/y", "no scheme", "", None,
        "a://b://c/d", "ftp://u@h.io:21/p", "http://", "http://e.net", "http://shop.com/%C3%A9?ü=1",
        "http://line\nbreak.net/en/"]


def plain(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(m) for m in "/?#" if m in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(m) for m in "?#" if m in rest] or [len(rest)])
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, rest[:cut]


def test_parts_rules_and_verdicts(spark):
    rows = [(i, u, "kept", "x") for i, u in enumerate(URLS)] + [(None, URLS[7], "kept", "x")] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    listed = U.listing(spark.createDataFrame([("https://shop.com/a?a=1&b=2",), (None,), ("nothing",)], "url string"))
    assert [r.canonical for r in listed.collect()] == ["shop.com/a?a=1&b=2"]
    got = U.judge(pages, listed, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = plain(r.row.url)
        assert (r.host, r.path) == (host, path)
        fitting = [x for x in URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fitting, key=lambda x: len(x.host + x.path), default=None)
        assert r.rule == (best.host + best.path if best else None)
        in_list = r.row.url in (URLS[7], URLS[8])
        assert r.verdict == (best.verdict if best else "block" if in_list else "allow"), r.row.url
        assert r.row.host == "kept"
    kept = U.keep_allowed(pages, listed, URL_RULES)
    assert kept.columns == pages.columns and kept.count() == sum(r.verdict == "allow" for r in got)


@pytest.mark.parametrize("blocks, share", [(1 << 18, 1_000), (1, 3)])
def test_filter_is_exact_at_every_size(spark, monkeypatch, blocks, share):
    """A filter of one block lets nearly everything through; the join still answers exactly."""
    monkeypatch.setattr(U, "MAX_BLOCKS", blocks)
    monkeypatch.setattr(U, "HOT_SHARE", share)
    listed = U.listing(spark.range(600).select(F.concat(F.lit("http://h/"), F.col("id") * 3).alias("url")))
    pages = (spark.range(900).select(F.concat(F.lit("https://www.h/"), "id", F.lit("/?utm_id=1")).alias("url"))
             .unionByName(spark.range(500).select(F.lit("http://h/3").alias("url")))
             .unionByName(spark.range(400).select(F.lit("http://h/4").alias("url"))))
    got = U.judge(pages, listed).select("row.url", "verdict").collect()
    assert len(got) == 1_800
    for url, verdict in got:
        number = int(url.split("/")[3])
        assert verdict == ("block" if number % 3 == 0 and number < 1_800 else "allow")
    filter_table, n = U.bloom(listed)
    assert filter_table.count() <= n <= blocks


def test_few_false_positives(spark):
    listed = U.listing(spark.range(5_000).select(F.concat(F.lit("http://h/"), "id").alias("url")))
    table, n = U.bloom(listed)
    others = spark.range(5_000, 25_000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    probed = others.withColumn("block", U._block(F.col("canonical"), n)).join(F.broadcast(table), "block")
    hit = F.lit(True)
    for i, bit in enumerate(U._lane_bits(F.col("canonical"))):
        hit = hit & (F.col(f"lane{i}").bitwiseAND(bit) == bit)
    assert probed.filter(hit).count() < 20_000 * 0.01


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    listed = U.listing(U.junk_urls(nothing))
    assert U.judge(nothing, listed, URL_RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.b/c", None), (2, "http://a.b/d", "")], "page_id long, url string, html string")
    assert U.junk_urls(some).count() == 0
    assert [r.verdict for r in U.judge(some, listed).collect()] == ["allow", "allow"]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "x")], "page_id long, url string, html string")
    out = U.judge(pages, U.listing(U.junk_urls(pages)), URL_RULES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
