"""Secret scan with corpus-wide ownership frequency.

Patterns find candidate secrets in every text. The hash of each candidate's value
is then counted over the whole corpus by distinct repositories (documents) and
distinct owners (sources): a value that many owners or very many repositories hold
was copied from some example, a value of few that looks random may be live. The patterns give
the base spans; live tokens that no pattern covers are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.text import lookup_join
from staylens.session import keep

# Kind, pattern, group that holds the value, least length of the value. The first
# three are the base, in the order in which they are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs are greedy, so a least length inside the pattern changes no match.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# A whole token of at least 20 characters with four digits and a letter.
TOKEN = r"(?<![A-Za-z0-9_-])(?=(?:[A-Za-z_-]*+[0-9]){4})(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}"
KINDS = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32), ("token", TOKEN, 0, 20))
BASE_KINDS = 3

# Values held by this many owners or more, or by this many repositories of whatever
# owner or none, are widely copied examples.
EXAMPLE_OWNERS = 4
EXAMPLE_REPOSITORIES = 16
# A live-looking value has this many different characters.
RANDOM_CHARACTERS = 10
# A token without a pattern of its own changes this often between letters and digits.
TOKEN_BORDERS = 3
SPARED = r"(?i)example|sample|changeme|placeholder|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"


def _matches(text: Column, number: int) -> Column:
    """Struct (kind, gaps, hits, values): lengths of the text between the matches."""
    _, pattern, group, _ = KINDS[number]
    gaps = F.transform(F.split(text, pattern), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.struct(F.lit(number).alias("kind"), gaps.alias("gaps"), hits.alias("hits"), values.alias("values"))
    return F.when(text.rlike(pattern), found)


def candidates(docs: DataFrame, doc_id: str, text: str, owner: str) -> DataFrame:
    """Rows (row, doc_id, owner, found): all matches of a text, by kind; no text."""
    found = F.array_compact(F.array(*[_matches(F.coalesce(F.col(text), F.lit("")), n) for n in range(len(KINDS))]))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        found.alias("found"),
    )


def place_spans(found: DataFrame) -> DataFrame:
    """Rows (row, doc_id, owner, kind, start, stop, value), the length test applied."""
    kinds = found.select("row", "doc_id", "owner", F.explode("found").alias("k"))
    pairs = F.arrays_zip(F.slice("k.gaps", 1, F.size("k.hits")).alias("gap"), F.col("k.hits").alias("hit"), F.col("k.values").alias("value"))
    rows = kinds.select("row", "doc_id", "owner", F.col("k.kind").alias("kind"), F.posexplode(pairs).alias("at", "m"))
    so_far = Window.partitionBy("row", "kind").orderBy("at")
    stop = F.sum(F.col("m.gap") + F.col("m.hit")).over(so_far)
    least = F.create_map(*[F.lit(x) for n, k in enumerate(KINDS) for x in (n, k[3])])
    return (
        rows.withColumn("stop", stop)
        .select("row", "doc_id", "owner", "kind", (F.col("stop") - F.col("m.hit")).alias("start"), "stop", F.col("m.value").alias("value"))
        .filter(F.length("value") >= least[F.col("kind")])
    )


def uncovered(spans: DataFrame) -> DataFrame:
    """All base spans and those tokens that touch none of them."""
    order = Window.partitionBy("row").orderBy("start", "stop", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    base = F.col("kind") < BASE_KINDS
    ended = F.coalesce(F.max(F.when(base, F.col("stop"))).over(before), F.lit(0))
    begun = F.min(F.when(base, F.col("start"))).over(after)
    free = (ended <= F.col("start")) & (begun.isNull() | (begun >= F.col("stop")))
    return spans.withColumn("free", free).filter(base | F.col("free")).drop("free")


def ownership(spans: DataFrame) -> DataFrame:
    """Columns value_hash, repositories, owners over the whole corpus."""
    return spans.groupBy("value_hash").agg(
        F.countDistinct("doc_id").alias("repositories"), F.countDistinct("owner").alias("owners")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(texts, ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, held, n_live, n_example.

    Counts and digest cover the base spans, ``spans`` also added tokens, by start
    and then kind, as kind:start:end in code points, and ``held`` for each of these
    the corpus counts of its value as repositories:owners. n_example counts base spans
    whose value is widely copied or names itself an example, n_live the others and
    the added ones that look random. NULL and empty texts have none; a NULL owner
    or id is not counted as one, so values of documents without an owner are judged
    by their repositories. Repeated rows repeat and count once in ownership; other
    columns are not read.
    """
    rows = keep(candidates(docs, doc_id, text, owner), "matches")
    spans = uncovered(place_spans(rows.filter(F.size("found") > 0)))
    varied = F.size(F.array_distinct(F.split("value", ""))) >= RANDOM_CHARACTERS
    borders = F.size(F.regexp_extract_all("value", F.lit(r"[A-Za-z][0-9]|[0-9][A-Za-z]"), F.lit(0)))
    varied = varied & ((F.col("kind") < BASE_KINDS) | (borders >= TOKEN_BORDERS))
    spans = keep(
        spans.select(
            "row", "doc_id", "owner", "kind", "start", "stop",
            F.sha2(F.col("value").cast("binary"), 256).alias("value_hash"),
            (varied & ~F.col("value").rlike(SPARED)).alias("random"),
        ),
        "spans",
    )
    owners = keep(ownership(spans), "ownership")
    judged = lookup_join(spans, owners, "value_hash", "inner", owners.count(), 160)
    copied = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    judged = judged.withColumn("live", F.col("random") & ~copied)
    judged = judged.filter((F.col("kind") < BASE_KINDS) | F.col("live"))
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "live", "repositories", "owners"))).alias("all")
    )
    joined = rows.select("row", "doc_id").join(per_row, "row", "left")
    span = "struct<start:bigint,kind:int,stop:bigint,live:boolean,repositories:bigint,owners:bigint>"
    every = F.coalesce("all", F.array().cast(f"array<{span}>"))
    held = F.transform("all", lambda s: F.concat_ws(":", s["repositories"].cast("string"), s["owners"].cast("string")))
    joined = joined.select("doc_id", every.alias("all"), F.filter(every, lambda s: s["kind"] < BASE_KINDS).alias("base"))
    counts = [_count(n).alias(f"n_{KINDS[n][0]}") for n in range(BASE_KINDS)]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.array_join(held, ",").alias("held"),
        F.size(F.filter("all", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("base", lambda s: ~s["live"])).cast("bigint").alias("n_example"),
    )
