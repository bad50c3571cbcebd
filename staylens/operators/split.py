"""Patient-grouped split, folds and leakage checks."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.operators.joins import left_join
from staylens.operators.quality import constant_rows, metric_rows
from staylens.schemas import ID_COLUMNS, LEAKING_COLUMNS, STAY, SUBJECT, TARGET
from staylens.session import keep
from staylens.settings import JoinLimits

FOLD = "fold"


def group_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test sets without a shared patient.

    The side is a hash of the patient, so it needs no shuffle, is the same in
    every run and also holds for stays that arrive later. The test share is
    ``test_size`` of the patients up to sampling error.
    """
    is_test = fn.hash_fraction(F.col(SUBJECT), seed) < test_size
    return df.filter(~is_test), df.filter(is_test)


def with_folds(df: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds the validation fold of each row; a patient stays within one fold."""
    return df.withColumn(FOLD, fn.hash_bucket(F.col(SUBJECT), seed, folds))


def _patients(df: DataFrame, salt: str) -> DataFrame:
    """One row per patient: key, stays and a draw from the hash; a NULL patient is one too."""
    counted = df.groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("stays"))
    return counted.select(_who().alias("_who"), "stays", fn.hash_fraction(_who(), salt).alias("_draw"))


def _who():
    return F.coalesce(F.col(SUBJECT).cast("string"), F.lit(""))


def _ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds the rank from 0 in a total order; ranges are sorted apart, their sizes shift the places."""
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    placed = keep(sorted_rows.withColumns({"_row": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}), "ranked")
    parts = placed.groupBy("_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per range: a single partition is all these few rows need.
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_n")
    shifts = parts.select("_part", (before - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(shifts), "_part").withColumn("_rank", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def exact_group_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Like ``group_split`` with exactly ``ceil(test_size * patients)`` test patients.

    The patients with the lowest draws go to test. Only the draw of the last of them
    is looked for, so the rows themselves are filtered and neither join nor move. An
    empty table gives two empty sides.
    """
    patients = _ranked(_patients(df, str(seed)), ["_draw", "_who"])
    # Without the rounding 0.2 * 35 would come to more than 7.
    last = math.ceil(round(test_size * patients.count(), 9)) - 1
    edge = patients.filter(F.col("_rank") == last).first()
    if edge is None:
        return df, df.filter(F.lit(False))
    draw = fn.hash_fraction(_who(), seed)
    at_edge = (draw == edge["_draw"]) & (_who() <= edge["_who"])
    is_test = (draw < edge["_draw"]) | at_edge
    return df.filter(~is_test), df.filter(is_test)


def deal_classes(classes: Mapping[int, int], folds: int) -> dict[int, list[int]]:
    """How many patients of each size every fold gets.

    The largest go first, each to the lightest fold (the lower one on a tie), as if
    dealt one by one; a level all folds reach is found by bisection instead.
    """
    loads, shares = [0] * folds, {}
    for size in sorted(classes, reverse=True):
        def reaching(level, size=size):
            return [max(0, -((load - level) // size)) for load in loads]

        low, high = min(loads), max(loads) + size * (classes[size] // folds + 1)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if sum(reaching(middle)) <= classes[size] else (low, middle)
        share = reaching(low)
        after = [load + size * n for load, n in zip(loads, share)]
        for _ in range(classes[size] - sum(share)):
            lightest = after.index(min(after))
            share[lightest] += 1
            after[lightest] += size
        loads, shares[size] = after, share
    return shares


def with_balanced_folds(
    df: DataFrame, folds: int = 5, seed: int = 42, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Adds validation folds with as equal numbers of rows as whole patients allow.

    Patients with equally many stays form a class; each fold takes its share of every
    class in the order of the draws. One count per class returns to the driver.
    """
    patients = _ranked(_patients(df, f"{seed}:fold"), ["stays", "_draw", "_who"])
    classes = {r["stays"]: r["count"] for r in patients.groupBy("stays").count().collect()}
    shares = deal_classes(classes, folds)
    rows, first = [], 0
    for size in sorted(classes):
        ends = list(itertools.accumulate(shares[size], initial=first))[1:]
        rows.append((size, ends))
        first = ends[-1]
    bounds = df.sparkSession.createDataFrame(rows, "stays bigint, ends array<bigint>")
    placed = patients.join(F.broadcast(bounds), "stays").select(
        "_who", F.size(F.filter("ends", lambda end: end <= F.col("_rank"))).alias(FOLD)
    )
    placed = keep(placed, "folds")
    return left_join(df.withColumn("_who", _who()), placed, "_who", sum(classes.values()), limits).select(*df.columns, FOLD)


def shared_subjects(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.select(SUBJECT).distinct().join(test.select(SUBJECT).distinct(), SUBJECT, "left_semi")


def fold_preview(df: DataFrame, folds: int = 5, seed: int = 42, balanced: bool = False) -> DataFrame:
    """Rows, patients and patient overlap of every fold, from one grouping.

    The training side of a fold is the total minus the fold, because no patient
    is in two folds; the overlap counts patients for whom that failed.
    """
    assign = with_balanced_folds if balanced else with_folds
    per_patient = (
        assign(df, folds, seed)
        .groupBy(SUBJECT)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(FOLD).alias(FOLD), F.max(FOLD).alias("_last"))
    )
    per_fold = per_patient.groupBy(FOLD).agg(
        F.sum("rows").alias("valid_rows"),
        F.count(F.lit(1)).alias("valid_subjects"),
        F.count_if(F.col(FOLD) != F.col("_last")).alias("subject_overlap"),
    )
    # One row per fold: a single partition is all these few rows need.
    everything = Window.partitionBy(F.lit(0))
    return per_fold.select(
        FOLD,
        (F.sum("valid_rows").over(everything) - F.col("valid_rows")).alias("train_rows"),
        "valid_rows",
        (F.sum("valid_subjects").over(everything) - F.col("valid_subjects")).alias("train_subjects"),
        "valid_subjects",
        "subject_overlap",
    )


def model_columns(columns: list[str], exclude: tuple[str, ...] = ()) -> list[str]:
    """Feature columns: neither identifier nor target nor excluded.

    Raises when a column that is only known after the stay is present.
    """
    leaking = sorted(set(columns) & set(LEAKING_COLUMNS))
    if leaking:
        raise ValueError(f"columns known only after the stay: {leaking}")
    return [c for c in columns if c not in (*ID_COLUMNS, TARGET) and c not in exclude]


def leakage_check(train: DataFrame, test: DataFrame) -> DataFrame:
    """Patients per side, shared patients and forbidden columns as metrics."""
    forbidden = (set(train.columns) | set(test.columns)) & set(LEAKING_COLUMNS)
    parts = [
        metric_rows(train, {"train_subjects": F.countDistinct(SUBJECT), "train_stays": F.countDistinct(STAY)}),
        metric_rows(test, {"test_subjects": F.countDistinct(SUBJECT), "test_stays": F.countDistinct(STAY)}),
        metric_rows(shared_subjects(train, test), {"subject_overlap": F.count(F.lit(1))}),
        constant_rows(train, {"leaking_columns": len(forbidden)}),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
