"""Choosing the most frequent codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.operators.events import ITEM, named_drugs
from staylens.session import keep

NAMES_SHOWN = 5


def describe_codes(codes: DataFrame, dimension: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Left join of code descriptions; a code without one keeps NULLs."""
    kept = [c for c in columns if c in dimension.columns]
    labels = dimension.select(F.col(ITEM).cast("bigint").alias(ITEM), *kept)
    return codes.join(labels, ITEM, "left")


def top_codes(linked: DataFrame, n: int) -> DataFrame:
    """The ``n`` items with most linked events; the lower code wins a tie."""
    return (
        linked.groupBy(ITEM)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc(ITEM))
        .limit(n)
    )


def top_drugs(linked: DataFrame, n: int) -> DataFrame:
    """The ``n`` drug keys with most named prescriptions and up to five names.

    Names are first reduced to one row each and written, so prescriptions are
    read and linked once. The rank filter on the window keeps five rows per key
    in every task before the shuffle, so a key that collects very many spellings
    does not gather them in one place.
    """
    names = (
        named_drugs(linked)
        .filter("NAMED")
        .groupBy("DRUG_NAME")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("DRUG_KEY", fn.drug_key(F.col("DRUG_NAME")))
    )
    names = keep(names, "drug-names")
    top = (
        names.groupBy("DRUG_KEY")
        .agg(F.sum("rows").alias("prescription_count"))
        .orderBy(F.desc("prescription_count"), F.asc("DRUG_KEY"))
        .limit(n)
    )
    by_name = Window.partitionBy("DRUG_KEY").orderBy("DRUG_NAME")
    shown = (
        names.select("DRUG_KEY", "DRUG_NAME")
        .withColumn("_rank", F.row_number().over(by_name))
        .filter(F.col("_rank") <= NAMES_SHOWN)
        .groupBy("DRUG_KEY")
        .agg(F.sort_array(F.collect_list("DRUG_NAME")).alias("DRUG_NAMES"))
    )
    return top.join(shown, "DRUG_KEY").select("DRUG_KEY", "DRUG_NAMES", "prescription_count")


def rank_codes(long: DataFrame, top_n: dict[str, int]) -> DataFrame:
    """Most frequent codes of every family from the per-stay statistics.

    Frequencies are sums of counts that already exist, so the events are not
    read again. Ties go to the lower code.
    """
    counted = (
        long.groupBy("family", "code")
        .agg(F.sum("ranked").alias("event_count"))
        .filter(F.col("event_count") > 0)
    )
    order = Window.partitionBy("family").orderBy(
        F.desc("event_count"), F.col("code").try_cast("bigint"), F.col("code")
    )
    limit = F.create_map(*[F.lit(x) for pair in top_n.items() for x in pair])
    return (
        counted.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= max(top_n.values()))
        .filter(F.col("rank") <= limit[F.col("family")])
    )
