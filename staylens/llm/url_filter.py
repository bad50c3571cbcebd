"""URL filtering: host rules, and a list of URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks (``bloom.py``). Only URLs that pass it go on
to the exact join with the list, which removes false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.bloom import BLOCK_BYTES, block_count, build_bloom, probe_bloom
from staylens.llm.text import fits_broadcast, lookup_join, lower_ascii, text_bytes
from staylens.session import keep

# Verdict, host, path; a rule also holds for all subdomains and longer paths.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Runs of symbols in a page's title put its URL on the list.
TITLE_MARKS = r"<title>[^<]*(#{3}|[*]{3}|[$]{3}|%{3}|&{3})"

# Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|\z)"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query; all empty for NULL or without ://."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    after = F.coalesce(after, F.lit(""))
    host = lower_ascii(F.regexp_extract(after, r"(?s)^[^/?#]*", 0))
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(after, r"(?s)^[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical_url(url: Column) -> Column:
    """One form for the addresses of a page: no scheme, mobile or www label, default
    port, fragment, tracking parameters, closing slash or .html; parameters sorted.
    Empty for NULL or without ://.
    """
    host, path, query = url_parts(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^(www|m|mobile|amp)\.(?=[^.]+\.)", ""), r":(80|443)$", "")
    path = F.rtrim(F.regexp_replace(F.rtrim(path, F.lit("/")), r"(/index)?(\.html?)?\z", ""), F.lit("/"))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.concat(host, path, tail)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Wording and verdict of the longest rule that fits; NULL without one."""
    name = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        wording = F.lit(rule_host + rule_path)
        name = F.when(fits, wording) if name is None else name.when(fits, wording)
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def marked_pages(pages: DataFrame, url: str = "url", html: str = "html", marks: str = TITLE_MARKS) -> DataFrame:
    """URLs (column ``url``) of the pages whose text has spam marks; hosts are not looked at.

    NULL texts have none. Other addresses of such a page meet the list by their
    canonical form, whatever their own text is.
    """
    return pages.filter(F.coalesce(F.col(html).rlike(marks), F.lit(False))).select(F.col(url).alias("url"))


def filter_urls(
    pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", listed_url: str = "url", rules=RULES
) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, listed; one row per row of ``pages``.

    The longest rule decides; without one, a page is blocked if its canonical URL
    is on the list. NULL URLs and such without :// have empty host and path, are
    never listed and allowed. An empty list blocks nothing, repeated list rows
    count once, repeated pages repeat, other columns are not read.
    """
    host, path, _ = url_parts(F.col(url))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), canonical_url(F.col(url)).alias("key")
    )
    keys = listed.select(canonical_url(F.col(listed_url)).alias("key")).filter("key <> ''").distinct()
    keys = keep(keys.withColumn("hash", F.xxhash64("key")), "listed-urls")
    n = keys.count()
    blocks = block_count(n)
    bloom = build_bloom(keys, "hash", blocks)
    keys = keys.select("key", F.lit(True).alias("listed"))
    width = text_bytes(keys, F.col("key"), 48) // max(n, 1) + 1
    hashed = rows.withColumn("hash", F.xxhash64("key"))
    if fits_broadcast(blocks * BLOCK_BYTES):
        tested = keep(probe_bloom(hashed, "hash", bloom, blocks).drop("hash"), "tested-urls")
    else:
        # Only row numbers and hashes shuffle to a large filter; what passes finds its row again.
        hashed = keep(hashed.withColumn("row", F.monotonically_increasing_id()), "hashed-urls")
        passed = keep(probe_bloom(hashed.select("row", "hash"), "hash", bloom, blocks).filter("possible").select("row", "possible"), "possible-urls")
        tested = lookup_join(hashed, passed, "row", "left", passed.count(), 32).drop("row", "hash")
        tested = keep(tested.withColumn("possible", F.coalesce("possible", F.lit(False))), "tested-urls")
    exact = lookup_join(tested.filter("possible"), keys, "key", "left", n, width)
    exact = exact.withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = tested.filter("not possible").withColumn("listed", F.lit(False))
    judged = exact.unionByName(rest).withColumn("rule", rule).withColumn("ruled", verdict)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "listed")
