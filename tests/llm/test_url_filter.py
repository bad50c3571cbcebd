from pyspark.sql import functions as F

import pytest

from staylens.llm import text as tx
from staylens.llm.bloom import block_count, build_bloom, probe_bloom
from staylens.llm.url_filter import canonical_url, filter_urls, marked_pages, url_parts

URLS = [
    "http://WWW.Example.com/a/b.html?utm_source=x&b=2&a=1#top",
    "https://m.example.com/a/b/?a=1&b=2",
    "example.com/a",
    None,
    "",
    "://",
    "http://x.net",
    "http://a.net/",
    "http://sub.example.net/en/x",
    "http://example.netx/en/",
    "http://example.com/de/1?x",
    "http://a.b.org/fr/",
    "http://org/fr/x",
    "http://notorg/fr/x",
    "http://x/a://b",
    "http://x.com" + "/" * 100_000 + "a",
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    rows = sorted(filter_urls(pages, pages.limit(0)).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path) for r in rows[:7]] == [
        ("www.example.com", "/a/b.html"), ("m.example.com", "/a/b/"), ("", ""), ("", ""), ("", ""), ("", ""), ("x.net", "")
    ]
    assert [(r.rule, r.verdict) for r in rows[6:15]] == [
        (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), (None, "allow"), ("example.com/de/", "block"),
        ("org/fr/", "allow"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"),
    ]


def test_forms_of_one_page_are_one(spark):
    rows = spark.createDataFrame([(u,) for u in URLS[:4]], "url string").select(canonical_url(F.col("url"))).collect()
    assert rows[0][0] == rows[1][0] == "example.com/a/b?a=1&b=2" and rows[2][0] == "" and rows[3][0] == ""


def test_bloom_never_misses_and_seldom_errs(spark):
    listed = spark.range(5000).selectExpr("concat('u', id) AS key")
    blocks = block_count(5000)
    bloom = build_bloom(listed, "key", blocks)
    assert probe_bloom(listed, "key", bloom, blocks).filter("not possible").count() == 0
    others = spark.range(20000).selectExpr("concat('v', id) AS key")
    assert probe_bloom(others, "key", bloom, blocks).filter("possible").count() < 20000 * 0.03


@pytest.mark.parametrize("bound", [tx.BROADCAST_BYTES, 0])
def test_list_is_exact_and_rows_are_whole(spark, monkeypatch, bound):
    monkeypatch.setattr(tx, "BROADCAST_BYTES", bound)
    pages = spark.createDataFrame(
        [(1, "http://a.com/x?ref=1", "k"), (1, "http://a.com/x?ref=1", "k"), (2, "http://a.com/y", "k"), (None, "http://www.a.com/x/", "k"), (3, None, "k")],
        "page_id int, url string, key string",
    )
    listed = spark.createDataFrame([("https://m.a.com/x",), ("https://m.a.com/x",), (None,), ("nothing",)], "url string")
    found = sorted(((r.page_id or 0, r.verdict, r.listed) for r in filter_urls(pages, listed).collect()))
    assert found == [(0, "block", True), (1, "block", True), (1, "block", True), (2, "allow", False), (3, "allow", False)]
    assert filter_urls(pages.limit(0), listed).count() == 0
    host, _, _ = url_parts(F.col("url"))
    assert pages.select(host).count() == 5


@pytest.mark.parametrize("bound", [tx.BROADCAST_BYTES, 0])
def test_other_addresses_of_marked_pages_are_caught(spark, monkeypatch, bound):
    monkeypatch.setattr(tx, "BROADCAST_BYTES", bound)
    pages = spark.createDataFrame(
        [
            (1, "http://plain.example.com/buy?ref=a", "<title>win $$$ now</title>"),
            (2, "https://m.plain.example.com/buy/#top", "<title>other words</title>"),
            (3, "https://plain.example.com:443/buy.html?utm_source=x", None),
            (4, "https://plain.example.com/other", "<title>fine</title> $$$"),
            (5, None, "<title>###</title>"),
            (6, "https://casino.example.com/", "<title>fine</title>"),
        ],
        "page_id int, url string, html string",
    ).selectExpr("*", "'z' AS host", "'z' AS rule", "'z' AS block", "'z' AS listed", "'z' AS hash", "'z' AS row")
    rows = filter_urls(pages, marked_pages(pages)).collect()
    assert {r.page_id: (r.listed, r.verdict) for r in rows} == {i: (i < 4, "block" if i < 4 else "allow") for i in range(1, 7)}


def test_registered_list_reaches_hosts_without_a_mark(spark):
    """On the given pages the list comes from titles, and some listed hosts hold unlisted pages too."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = filter_urls(pages, marked_pages(pages)).cache()
    listed = rows.filter("listed")
    assert 0 < listed.count() < 0.5 * rows.count()
    assert listed.join(rows.filter("not listed"), "host").count() > 0
    rows.unpersist()
