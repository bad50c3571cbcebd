import math
import random
import re
import unicodedata
import zlib

from pyspark.sql import functions as F

from staylens.llm.quality_model import drop_rejected, fit_rules, score_quality, text_statistics, tree_rules
from staylens.plans.splits import Tree

from .words import AWKWARD, awkward_docs


def test_rules_are_the_paths_of_the_trees():
    a, b = "ab"
    tree = Tree([1, 2, 3, 4, 5, 6, 7], [0, 1, 0, -1, -1, -1, -1], [0, 0, 1, 0, 0, 0, 0], [False] * 7, [0.0] * 7)
    assert set(tree_rules([tree, tree], [[0.5, 0.75], [2.0]], [a, b])) == {
        ((a, "<=", 0.5),),
        ((a, "<=", 0.5), (b, ">", 2.0)),
        ((a, "<=", 0.5), (b, "<=", 2.0)),
        ((a, ">", 0.5),),
        ((a, "<=", 0.75), (a, ">", 0.5)),
        ((a, ">", 0.75),),
    }


def plain_statistics(text):
    """The statistics again, by plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^ \t\x0b\f\r\n]", x)]
    chars, n, n_lines = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    twice = sum(len(m[0]) for m in re.finditer(r"(?<!\S)(\S++)(?=\s\1(?!\S))", text, re.ASCII))
    return {
        "log_words": math.log1p(len(words)),
        "word_chars": sum(map(len, words)) / n,
        "symbols": sum(c in "#*$%&|<>" for c in text) / n,
        "upper": sum(unicodedata.category(c) == "Lu" for c in text) / chars,
        "digits": sum(c in "0123456789" for c in text) / chars,
        "marks": sum(c in "!?" for c in text) / n,
        "stops": sum(c in ".,;:" for c in text) / n,
        "distinct_words": len(set(words)) / n,
        "short_words": sum(len(w) for w in words if len(w) <= 3) / chars,
        "line_words": len(words) / n_lines,
        "repeated_lines": (len(lines) - len(set(lines))) / n_lines,
        "repeated": twice / chars,
    }


def test_scores_equal_a_plain_evaluation(spark):
    """Statistics and rules of 200 random texts and the odd ones, evaluated one by one."""
    rng = random.Random(8)
    texts = ["".join(rng.choices(["word ", "Ab ", "ab ", "ab\n", "12 ", "#", "! ", "é. ", "\n", "longer, "], k=rng.randint(0, 120))) for _ in range(200)]
    texts += [t for _, t in AWKWARD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    sf = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    model = fit_rules(real.select(text_statistics(F.col("text")).alias("s"), F.col("quality").cast("double").alias("label")).select("s.*", "label"))
    assert model.rules
    found = docs.select("doc_id", text_statistics(F.col("text")).alias("s"), model.score_of(F.col("text")).alias("score")).collect()
    for r in found:
        plain = plain_statistics(texts[r.doc_id])
        for name, value in plain.items():
            assert abs(r.s[name] - value) < 1e-12, (name, texts[r.doc_id][:60])
        odds = model.intercept + sum(w for rule, w in model.rules if all(r.s[n] <= x if side == "<=" else r.s[n] > x for n, side, x in rule))
        assert abs(r.score - 1 / (1 + math.exp(-odds))) < 1e-12


def test_scores_do_not_depend_on_the_layout(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = [sorted(map(tuple, score_quality(docs.repartition(n), labels).collect())) for n in (1, 7, 32)]
    assert found[0] == found[1] == found[2]
    kept = sorted(r.doc_id for r in drop_rejected(docs, labels).select("doc_id").collect())
    assert kept == [r[0] for r in found[0] if r[3]]


def test_statistics_of_small_texts(spark):
    rows = spark.createDataFrame([(1, "Der Der Der ab."), (2, None), (3, "a\na\nB!# 12")], "doc_id int, text string")
    found = {r.doc_id: r.s for r in rows.select("doc_id", text_statistics(F.col("text")).alias("s")).collect()}
    assert found[1].repeated == 6 / 15 and found[1].distinct_words == 0.5 and found[1].stops == 0.25
    assert all(v == 0 for v in found[2])
    assert found[3].repeated_lines == 1 / 3 and found[3].symbols == 0.25 and found[3].digits == 2 / 10


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = score_quality(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.98
    kept = {r.doc_id for r in drop_rejected(docs, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in scored.filter("predicted = 1").collect()}


def test_awkward_rows_labels_and_empty_tables(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, None), (8, 1), (8, 0), (None, 1)], "doc_id bigint, quality int")
    assert score_quality(docs, labels).count() == docs.count()
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).count() == 0
    left = drop_rejected(docs, labels.limit(0))
    assert left.columns == docs.columns and left.count() == docs.count()
    one = spark.createDataFrame([(0.0,) * 12 + (1.0,)], "log_words double, word_chars double, symbols double, upper double, digits double, marks double, stops double, distinct_words double, repeated double, short_words double, line_words double, repeated_lines double, label double")
    assert fit_rules(one).intercept > 0 and fit_rules(one).rules == ()
