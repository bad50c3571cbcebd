import random
import re
from collections import Counter

from pyspark.sql import functions as F

from staylens.llm.quality_rules import RULES, blend, fences, group_fences, judge, merge_sketches, rate_buckets, sketch, text_counts
from staylens.session import keep

from .words import AWKWARD, awkward_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["a ", "b ", "c ", "é\t", "\n", "#", "| ", " \x0b"], k=rng.randint(0, 80))) for _ in range(150)]
    texts += [t for _, t in AWKWARD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in text_counts(docs, "text").collect():
        assert tuple(r[n] for n in names) == brute(texts[r.doc_id]), texts[r.doc_id][:80]


def test_sketches_merge_and_give_quartiles(spark):
    rows = spark.range(4000).selectExpr("id % 2 AS g", "0 AS _all", "id", "CAST(id % 100 AS INT) AS mean_chars", "CAST(id % 2 AS INT) AS line_ratio", "7 AS symbol_rate")
    names = list(RULES)
    whole = sketch(rows, names, ["_all", "g"])
    parts = merge_sketches(sketch(rows.filter("id % 3 = 0"), names, ["_all", "g"]).union(sketch(rows.filter("id % 3 <> 0"), names, ["_all", "g"])), ["_all", "g"])
    assert sorted(map(tuple, parts.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    wider = merge_sketches(whole, ["_all"]).withColumn("total", F.lit(4000))
    for r in fences(blend(whole, ["_all", "g"], wider, ["_all"]), ["g"]).collect():
        # Quartiles of even or odd numbers below 100, give or take the blended texts.
        assert abs(r.mean_chars_low - (25 - 2 * 50 - 1)) <= 6 and abs(r.mean_chars_high - (75 + 2 * 50 + 1)) <= 6
        assert (r.symbol_rate_low, r.symbol_rate_high) == (6, 8)
        assert (r.line_ratio_low, r.line_ratio_high) == (r.g - 1, r.g + 1)


def test_small_groups_lean_on_their_language(spark):
    """No border between sizes: a text more moves a quartile by a bucket at most, a limit by three."""
    found = []
    for size in (1, 20, 48, 49, 50, 51, 400):
        rows = spark.createDataFrame([("en", "own", 40 + i % 3) for i in range(size)] + [("en", "wide", i % 20) for i in range(3000)], "_lang string, _source string, b int")
        rows = rows.selectExpr("_lang", "_source", "b AS symbol_rate", "b AS line_ratio", "b AS mean_chars")
        found.append(group_fences(rows).filter("_source = 'own'").first().mean_chars_low)
    assert found[0] < 0 and found[-1] > 30
    assert max(found[2:6]) - min(found[2:6]) <= 3


def test_thresholds_follow_the_group(spark):
    text = "one two three four five six seven eight nine ten eleven twelve {}"
    rows = [(i, text.format(i) + " " + "#" * (12 + 3 * (i % 3)), "en", "code") for i in range(300)]
    rows += [(1000 + i, text.format(i), "en", "news") for i in range(300)]
    rows += [(2000, text.format("x") + " " + "#" * 15, "en", "news"), (2001, text.format("y") + " " + "#" * 15, "en", "code")]
    kept = {r.doc_id: r.kept for r in judge(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert not kept[2000] and kept[2001] and all(kept[i] and kept[1000 + i] for i in range(300))


def test_groups_without_symbols_get_different_limits_and_boilerplate_goes(spark):
    """Most texts have neither a symbol nor a repeated line, and still the limits differ."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))

    def prose(lines, words):
        return "\n".join(" ".join(word() for _ in range(words)) for _ in range(lines))

    rows = [(i, prose(rng.randint(5, 9), 4), "en", "notes") for i in range(250)]
    rows += [(1000 + i, prose(rng.randint(40, 90), 12), "en", "books") for i in range(250)]
    menu = "\n".join(f"{a}\n{b}" for a, b in (("home page", "log in"), ("about us", "sign up")))
    planted = "\n".join([menu] * 12) + "\n" + prose(6, 110)
    rows += [(5000, planted, "en", "notes"), (5001, planted, "en", "books"), (5002, prose(6, 4) + " $$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$$", "en", "notes")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    out = {r.doc_id: r for r in judge(docs).collect()}
    assert not any(out[i].base_failed for i in (5000, 5001, 5002))
    assert not out[5000].kept and not out[5001].kept and not out[5002].kept
    assert sum(r.kept for i, r in out.items() if i < 5000) > 0.97 * 500
    counts = text_counts(docs.select("doc_id", F.col("lang").alias("_lang"), F.col("source").alias("_source"), "text"), "text")
    limits = {r["_source"]: r for r in group_fences(rate_buckets(keep(counts, "counts"))).collect()}
    for name in ("symbol_rate_high", "line_ratio_high"):
        assert limits["notes"][name] != limits["books"][name]


def test_every_rule_has_limits_that_differ(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    named = docs.select("doc_id", F.col("lang").alias("_lang"), F.col("source").alias("_source"), "text")
    rows = rate_buckets(keep(text_counts(named, "text"), "counts")).filter("n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words")
    limits = keep(group_fences(rows), "limits")
    assert all(limits.select(f"{n}_high").distinct().count() > 2 for n in RULES)
    joined = rows.join(limits, ["_lang", "_source"])
    assert joined.filter("symbol_rate > symbol_rate_high").count() > 500
    assert joined.filter("mean_chars > mean_chars_high").count() > 0 and joined.filter("line_ratio > line_ratio_high").count() > 0


def test_awkward_rows_and_empty_table(spark):
    docs = awkward_docs(spark)
    rows = judge(docs).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id for r in rows if not r.base_failed} == {1, 8, None} and all(not r.kept for r in rows if r.base_failed)
    assert judge(docs.limit(0)).count() == 0


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1")
    rows = judge(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    passed = rows.filter(~F.col("base_failed"))
    assert passed.filter("kept").count() > 0.97 * passed.count()
