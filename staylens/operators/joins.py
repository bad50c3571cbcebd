"""Equi joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.settings import JoinLimits


def hot_keys(facts: DataFrame, key: str, share: float) -> list:
    """Every key holding at least ``share`` of the rows, plus possibly a few others.

    One mergeable pass over a single column; at most ``1 / share`` keys return.
    Extra keys are harmless because salting never changes the result.
    """
    row = facts.select(key).stat.freqItems([key], share).first()
    return [k for k in row[0] if k is not None]


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a NULL key meets a NULL key."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, same, "inner").drop(*(f"_right_{k}" for k in keys))


def keyed_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    lookup_rows: int,
    limits: JoinLimits,
) -> DataFrame:
    """Inner join of a long fact table with a narrow fixed-width lookup table.

    A lookup counted below the limit is broadcast, so facts are filtered where
    they are scanned. Above it both sides shuffle, with hot values of the first
    key spread over as many salts as there are shuffle partitions. The salt
    depends on the row and on its partition number only: copies of one row
    spread too, and a task that is run again produces the same salts.
    """
    return _salted_join(facts, lookup, keys, lookup_rows, limits, "inner")


def left_join(facts: DataFrame, lookup: DataFrame, key: str, lookup_rows: int, limits: JoinLimits) -> DataFrame:
    """Like ``keyed_join`` but keeps facts without a partner."""
    return _salted_join(facts, lookup, [key], lookup_rows, limits, "left")


def _salted_join(facts, lookup, keys, lookup_rows, limits, how) -> DataFrame:
    if lookup_rows <= limits.broadcast_rows:
        return facts.join(F.broadcast(lookup), keys, how)
    key = keys[0]
    hot = hot_keys(facts, key, limits.hot_share)
    if not hot:
        return facts.join(lookup, keys, how)
    salts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in facts.columns]), F.lit(salts))
    salted_facts = facts.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)).cast("int"))
    replicas = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.withColumn("_salt", F.explode(replicas))
    return salted_facts.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")
