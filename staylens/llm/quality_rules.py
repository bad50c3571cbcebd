"""Quality rules whose thresholds follow each language and source.

Every text gets a few exact counts and three positive rates. Their distribution per
language and source is kept as a quantile sketch: logarithmic buckets of fixed
relative width with counts, which merge by addition, so partial counts combine in any
order and a repeated task changes nothing. Quartile buckets read off the sketches give
a fence per group and rate, and texts are filtered by a join with the fences. A
group's sketch is blended with a small share of its language's, and that one with a
small share of all texts', so few texts say little and no size is a border.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.text import BLANKS, count_matching, let, lookup_join, split_words
from staylens.session import keep

RUN_WORDS = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
# Buckets grow by this factor; a quantile is right to about a twentieth.
GROWTH = 1.1
# A fence lies this many quartile distances, in buckets, and one bucket beyond the quartiles.
REACH, SLACK = 2, 1
# As many texts of the wider sketch are blended into each sketch.
PRIOR = 50

# Rates that are bad when high only, and one that is bad on both sides.
RULES = {"symbol_rate": False, "line_ratio": False, "mean_chars": True}


def _windows(words: Column) -> Column:
    """Hash of every run of RUN_WORDS words."""
    last = F.size(words) - RUN_WORDS
    runs = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN_WORDS)])
    )
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def _words_in_repeated(words: Column) -> Column:
    """Words covered by windows whose words occur at least twice; compares the words."""
    at = F.sequence(F.lit(0), F.size(words) - RUN_WORDS)
    texts = F.transform(at, lambda i: F.struct(F.array_join(F.slice(words, i + 1, RUN_WORDS), " ").alias("t"), i.alias("i")))
    repeated = let(
        F.array_sort(texts),
        lambda a: F.array_sort(
            F.transform(
                F.filter(
                    F.transform(
                        a,
                        lambda x, k: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(F.get(a, k - 1)["t"] == x["t"], F.lit(False))
                                | F.coalesce(F.get(a, k + 1)["t"] == x["t"], F.lit(False))
                            ).alias("twice"),
                        ),
                    ),
                    lambda x: x["twice"],
                ),
                lambda x: x["i"],
            )
        ),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    merged = F.aggregate(
        repeated,
        start,
        lambda acc, i: F.struct(
            (acc["n"] + i + RUN_WORDS - F.greatest(i, acc["upto"])).alias("n"), (i + RUN_WORDS).alias("upto")
        ),
    )
    return merged["n"]


def text_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (bigint).

    n_lines counts the lines with a word; the others are the base counts.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_words", split_words(full, BLANKS)).withColumn("_runs", _windows(F.col("_words")))
    lines = let(
        F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda a: F.struct(F.size(a).alias("all"), F.size(F.array_distinct(a)).alias("different")),
    )
    docs = docs.withColumn("_lines", lines)
    # Most texts repeat no window: then nothing is sorted.
    some = F.size("_runs") > F.size(F.array_distinct("_runs"))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.regexp_replace(full, BLANKS, "")),
        "n_symbols": count_matching(full, r"[#*$%&|<>]+"),
        "n_dup_lines": F.col("_lines.all") - F.col("_lines.different"),
        "n_repeat_words": F.when(some, _words_in_repeated(F.col("_words"))).otherwise(F.lit(0)),
        "n_lines": F.col("_lines.all"),
    }
    plain = [c for c in docs.columns if c not in ("_words", "_runs", "_lines", text)]
    return docs.select(*plain, *(c.cast("bigint").alias(n) for n, c in counts.items()))


def rate_buckets(counts: DataFrame) -> DataFrame:
    """``counts`` with a bucket number per rate of ``RULES``.

    The rates are never 0: one symbol more than there are, and half a line on both
    sides. So a short text has a higher rate than a long one with as little evidence,
    and quartiles tell groups apart also where most texts have no symbol at all.
    """
    rates = {
        "symbol_rate": (F.col("n_symbols") + 1) / (F.col("word_chars") + 2),
        "line_ratio": (F.col("n_dup_lines") + 0.5) / (F.col("n_lines") - F.col("n_dup_lines") + 0.5),
        "mean_chars": F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1)),
    }
    return counts.withColumns({n: F.floor(F.log(r) / F.log(F.lit(GROWTH))).cast("int") for n, r in rates.items()})


def sketch(rows: DataFrame, names: list[str], groups: list[str]) -> DataFrame:
    """Columns groups, name, bucket, n: mergeable quantile sketches of bucketed rates."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("bucket")) for n in names])
    return rows.select(*groups, F.explode(pairs).alias("p")).groupBy(*groups, "p.name", "p.bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, groups: list[str]) -> DataFrame:
    return sketches.groupBy(*groups, "name", "bucket").agg(F.sum("n").alias("n"))


def blend(sketches: DataFrame, groups: list[str], wider: DataFrame, on: list[str]) -> DataFrame:
    """Columns groups, name, bucket, n (weight), total: own counts plus ``PRIOR`` texts of ``wider``.

    ``wider`` has ``on``, name, bucket, n, total and every bucket of ``sketches``.
    """
    share = wider.select(*on, "name", "bucket", (F.col("n") / F.col("total")).alias("_share"))
    cells = sketches.select(*groups, "name").distinct().join(share, [*on, "name"])
    full = cells.join(sketches.select(*groups, "name", "bucket", "n"), [*groups, "name", "bucket"], "left")
    own = F.coalesce("n", F.lit(0))
    size = F.sum(own).over(Window.partitionBy(*groups, "name"))
    return full.select(*groups, "name", "bucket", (own + F.lit(PRIOR) * F.col("_share")).alias("n"), (size + PRIOR).alias("total"))


def fences(blended: DataFrame, groups: list[str]) -> DataFrame:
    """Columns groups and <rate>_low / _high: the buckets between which a rate may lie."""
    upto = F.sum("n").over(Window.partitionBy(*groups, "name").orderBy("bucket"))
    # Weights are fractions; rounding makes their sums independent of the order of addition.
    ranked = blended.withColumn("upto", F.round(upto / F.col("total"), 9))
    q1, q3 = (F.min(F.when(F.col("upto") >= share, F.col("bucket"))) for share in (0.25, 0.75))
    per_name = ranked.groupBy(*groups, "name").agg(q1.alias("q1"), q3.alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * REACH + SLACK
    sides = {"low": F.col("q1") - reach, "high": F.col("q3") + reach}
    cells = [F.max(F.when(F.col("name") == n, c)).alias(f"{n}_{side}") for n in RULES for side, c in sides.items()]
    return per_name.groupBy(*groups).agg(*cells)


def group_fences(rows: DataFrame) -> DataFrame:
    """Fences of every (_lang, _source) from the bucketed rates of ``rows``."""
    fine = keep(sketch(rows, list(RULES), ["_lang", "_source"]), "sketches")
    whole = merge_sketches(fine.withColumn("_all", F.lit(0)), ["_all"])
    whole = whole.withColumn("total", F.sum("n").over(Window.partitionBy("_all", "name")))
    by_lang = merge_sketches(fine, ["_lang"]).withColumn("_all", F.lit(0))
    by_lang = blend(by_lang, ["_all", "_lang"], whole, ["_all"]).drop("_all")
    return fences(blend(fine, ["_lang", "_source"], by_lang, ["_lang"]), ["_lang", "_source"])


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: counts, base_failed and kept.

    Columns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept. NULL and empty texts have no words and fail the base. A NULL
    language or source is a group of its own. Fences come from the texts that pass
    the base; where there are none, nothing more is dropped. Repeated rows repeat
    and count; other columns are not read.
    """
    # A missing group is marked by a character that no name holds.
    missing = F.lit("\x00")
    named = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), missing).alias("_lang"),
        F.coalesce(F.col(source).cast("string"), missing).alias("_source"),
        F.col(text).alias("_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    counts = text_counts(named, "_text").withColumn("base_failed", failed)
    rows = rate_buckets(keep(counts, "text-counts"))
    limits = keep(group_fences(rows.filter(~F.col("base_failed"))), "fences")
    joined = lookup_join(rows, limits, ["_lang", "_source"], "left", limits.count(), 160)
    inside = [F.col(n) <= F.col(f"{n}_high") for n in RULES] + [F.col(n) >= F.col(f"{n}_low") for n, both in RULES.items() if both]
    kept = ~F.col("base_failed") & F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(True))
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return joined.select(*shown, kept.alias("kept"))
