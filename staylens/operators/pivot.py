"""Long (stay, code) statistics to one wide row per stay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.schemas import STAY


@dataclass(frozen=True)
class Feature:
    """One selected code: its family, code text and column stem."""

    family: str
    code: str
    stem: str
    stats: tuple[str, ...]

    def columns(self) -> list[str]:
        return [f"{self.stem}_{s}" for s in self.stats]


def feature_columns(features: list[Feature]) -> list[str]:
    return [c for f in features for c in f.columns()]


def pivot_features(long: DataFrame, features: list[Feature]) -> DataFrame:
    """One row per stay with ``<stem>_<stat>`` columns of all families at once.

    ``long`` has (family, stay, code, statistics) and is unique per family, stay
    and code. Rows move once, by stay; both steps of the pivot then work within
    the partition, and no join per family is needed. A stay has at most
    ``len(features)`` rows.
    """
    stats = [s for s in ("mean", "min", "max", "std", "sum", "count", "last") if any(s in f.stats for f in features)]
    known = ", ".join(f"{fn.sql_text(f'{f.family}|{f.code}')}, {fn.sql_text(f.stem)}" for f in features)
    stem = F.expr(f"map({known})[concat_ws('|', family, code)]")
    tall = (
        long.filter(F.col("family").isin(sorted({f.family for f in features})))
        .filter(F.col("code").isin(sorted({f.code for f in features})))
        .select(STAY, stem.alias("stem"), *stats)
        .filter(F.col("stem").isNotNull())
    )
    # Pivoting a single aggregate would drop the alias from the column names.
    aggregates = [F.max(s).alias(s) for s in stats] + ([F.max(STAY).alias("_id")] if len(stats) == 1 else [])
    wide = (
        tall.repartition(STAY).groupBy(STAY).pivot("stem", [f.stem for f in features]).agg(*aggregates)
    )
    wanted = set(feature_columns(features))
    return wide.drop(*[c for c in wide.columns if c != STAY and c not in wanted])


def empty_family(family: str):
    """Typed placeholder column of a family without any selected code."""
    return F.lit(None).cast("double").alias(f"no_{family}_features")
