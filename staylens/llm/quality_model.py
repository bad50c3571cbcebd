"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees grown on labelled texts propose rules (every path from a root to a
node), a lasso logistic fit keeps few of them, and the kept rules become one
Spark column expression that scores any number of texts where they are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.plans.splits import Tree
from staylens.plans.trees import Forest, bin_rows, forest_model, plant
from staylens.schemas import FEATURES, STAY, TARGET
from staylens.llm.text import BLANKS, count_matching, crc_remainder, let, lookup_join, split_words
from staylens.session import keep

TREES = 24
DEPTH = 3
STATISTICS_SHARE = "0.34"
LEAST_ROWS = 2
LASSO = 3e-4
MAX_ITERATIONS = 60
SEED = 42
# Weights are cut to so many digits: the sums behind them depend on the order of addition.
DIGITS = 9
PATTERN_PARTS = 8
FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3

_REPEATED_WORD = r"(?<!\S)(\S++)(?=\s\1(?!\S))"
_SHORT_WORD = r"(?<!\S)\S{1,3}(?!\S)"


def text_statistics(text: Column) -> Column:
    """Struct of statistics of a whole text; all are 0 for a text without words."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"\S"))

    def fields(words: Column, lines: Column) -> Column:
        chars, n, n_lines = (F.greatest(c, F.lit(1)) for c in (F.length(full), F.size(words), F.size(lines)))
        values = {
            "log_words": F.log1p(F.size(words).cast("double")),
            "word_chars": F.length(F.regexp_replace(full, BLANKS, "")) / n,
            "symbols": count_matching(full, r"[#*$%&|<>]+") / n,
            "upper": count_matching(full, r"\p{Lu}+") / chars,
            "digits": count_matching(full, r"[0-9]+") / chars,
            "marks": count_matching(full, r"[!?]+") / n,
            "stops": count_matching(full, r"[.,;:]+") / n,
            "distinct_words": F.size(F.array_distinct(words)) / n,
            "repeated": count_matching(full, _REPEATED_WORD) / chars,
            "short_words": count_matching(full, _SHORT_WORD) / chars,
            "line_words": F.size(words) / n_lines,
            "repeated_lines": (F.size(lines) - F.size(F.array_distinct(lines))) / n_lines,
        }
        return F.struct(*[values[name].cast("double").alias(name) for name in STATISTICS])

    return let(split_words(full, BLANKS), lambda w: let(lines, lambda x: fields(w, x)))


STATISTICS = (
    "log_words word_chars symbols upper digits marks stops distinct_words repeated short_words line_words repeated_lines"
).split()

Rule = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """log odds = intercept + sum of the weights of the rules that hold."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self, value=F.col) -> Column:
        """``value`` gives the column of a statistic by its name."""
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            odds = odds + F.when(condition(rule, value), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def score_of(self, text: Column) -> Column:
        """Score of a text column; each statistic is computed once per text."""
        return let(text_statistics(text), lambda s: self.score(s.getField))


def condition(rule: Rule, value=F.col) -> Column:
    tests = [value(name) <= limit if side == "<=" else value(name) > limit for name, side, limit in rule]
    return reduce(lambda a, b: a & b, tests)


def tree_rules(trees: list[Tree], edges, names: list[str]) -> list[Rule]:
    """Every distinct path from a root to a node, as bounds of statistics."""
    rules: dict[Rule, None] = {}
    for tree in trees:
        at = {int(p): i for i, p in enumerate(tree.path)}
        for path in sorted(at)[1:]:
            tests = []
            for child in (path >> k for k in range(path.bit_length() - 1)):
                i = at[child >> 1]
                f = int(tree.feature[i])
                tests.append((names[f], ">" if child & 1 else "<=", float(edges[f][tree.bin[i]])))
            rules[tuple(sorted(tightest(tests)))] = None
    return list(rules)


def tightest(tests) -> list[tuple[str, str, float]]:
    """One bound per statistic and side."""
    best: dict[tuple[str, str], float] = {}
    for name, side, limit in tests:
        seen = best.get((name, side), limit)
        best[name, side] = min(seen, limit) if side == "<=" else max(seen, limit)
    return [(name, side, limit) for (name, side), limit in best.items()]


def fit_rules(rows: DataFrame, label: str = "label") -> RuleModel:
    """Fit on a table of statistics with a 0/1 label; distributed, all rows count.

    Bootstraps follow a hash of the statistics and tree sums are whole numbers, so the
    rules do not depend on how ``rows`` is laid out. The lasso sees each pattern of
    rules once, with its number of rows. With one class only the score is that class;
    without rows it is one half.
    """
    n, good = rows.agg(F.count(label), F.sum(F.col(label).cast("double"))).first()
    if not n:
        return RuleModel(0.0)
    if good in (0, n):
        return RuleModel(20.0 if good else -20.0)
    vectors = rows.select(
        F.xxhash64(*STATISTICS).alias(STAY), F.col(label).cast("double").alias(TARGET), array_to_vector(F.array(*STATISTICS)).alias(FEATURES)
    )
    binned = bin_rows(vectors)
    forest = Forest(trees=TREES, max_depth=DEPTH, min_leaf=LEAST_ROWS, subset=STATISTICS_SHARE, seed=SEED)
    trees = [t for part in forest_model(binned, plant(binned, forest)).parts() for t in part]
    rules = tree_rules(trees, binned.edges, STATISTICS)
    if not rules:
        share = good / n
        return RuleModel(math.log(share / (1 - share)))
    held = F.array(*[condition(r).cast("double") for r in rules]).alias("held")
    patterns = rows.select(held, F.col(label).cast("double").alias(label)).groupBy("held", label).agg(F.count(F.lit(1)).cast("double").alias("n"))
    patterns = keep(patterns.repartition(PATTERN_PARTS, "held", label).sortWithinPartitions("held", label), "patterns")
    lasso = LogisticRegression(
        labelCol=label, weightCol="n", elasticNetParam=1.0, regParam=LASSO, maxIter=MAX_ITERATIONS, standardization=False
    ).fit(patterns.select(array_to_vector("held").alias("features"), label, "n"))
    weights = [round(w, DIGITS) for w in lasso.coefficients.toArray().tolist()]
    return RuleModel(round(float(lasso.intercept), DIGITS), tuple((r, w) for r, w in zip(rules, weights) if w))


def training_rows(rows: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """``rows`` outside the held-out fifth that have a label, as 0.0 or 1.0 in ``_label``."""
    marks = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_labelled"))
    marks = keep(marks.agg((F.avg(label) >= 0.5).cast("double").alias("_label")), "labels")
    learn = rows.filter(crc_remainder(F.col(doc_id), FOLDS) != HELD_OUT)
    same = F.col(doc_id) == F.col("_labelled")
    return lookup_join(learn, marks, same, "inner", marks.count(), 40).drop("_labelled")


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Columns doc_id, held_out, score, predicted; a row per row of ``docs``.

    Learns only from labels of ids outside the held-out fifth; nothing but the
    text enters a score. NULL and empty texts have statistics 0 and a score like
    any other; NULL labels are ignored, an id labelled more than once counts with
    its average. Repeated rows repeat. Without labels every score is one half.
    """
    counted = docs.select(F.col(doc_id).alias("doc_id"), text_statistics(F.col(text)).alias("s"))
    table = keep(counted.select("doc_id", "s.*"), "statistics")
    train = training_rows(table, labels.withColumnRenamed(doc_id, "doc_id"), "doc_id", label)
    model = fit_rules(keep(train.select(*STATISTICS, F.col("_label").alias("label")), "labelled"))
    held_out = crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    out = table.select("doc_id", held_out.alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_rejected(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; all columns stay.

    Learns like ``score_quality``. Scores are computed where a text is read, so no
    text is shuffled.
    """
    train = training_rows(docs.select(doc_id, text), labels, doc_id, label)
    train = train.select(text_statistics(F.col(text)).alias("s"), F.col("_label").alias("label"))
    model = fit_rules(keep(train, "labelled").select("s.*", "label"))
    return docs.filter(model.score_of(F.col(text)) >= threshold)
