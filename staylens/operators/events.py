"""Event scans, window links and per-stay event statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.operators.joins import keyed_join, null_safe_join
from staylens.operators.stays import StayWindows
from staylens.schemas import ADMISSION, STAY
from staylens.settings import Family, JoinLimits, Source
from staylens.sources.raw import require_columns

TIME = "EVENT_TIME"
VALUE = "VALUE"
ITEM = "ITEMID"


def event_scan(raw: DataFrame, key: str, source: Source) -> DataFrame:
    """Narrow scan: link key, item, time and value of every usable event.

    Missing keys, times that do not parse and values that are no number are
    dropped. On typed parquet the casts vanish and the NULL filters reach the
    scan.
    """
    require_columns(raw, [key, ITEM, source.time, source.value], source.table.upper())
    return usable_events(raw.filter(F.col(ITEM).isNotNull()), key, source).select(
        F.col(key).cast("bigint").alias(key), F.col(ITEM).cast("bigint").alias(ITEM), TIME, VALUE
    )


def usable_events(raw: DataFrame, key: str, source: Source) -> DataFrame:
    """Events with a link key, a valid time and a numeric value; all columns kept."""
    time, value = fn.timestamp(F.col(source.time)), F.col(source.value).try_cast("double")
    return raw.filter(
        F.col(key).isNotNull() & time.isNotNull() & value.isNotNull() & ~F.isnan(value)
    ).select(*[c for c in raw.columns if c not in (TIME, VALUE)], time.alias(TIME), value.alias(VALUE))


def drug_scan(raw: DataFrame, key: str, source: Source) -> DataFrame:
    """Prescriptions with key and time; names are cleaned only after linking."""
    require_columns(raw, [key, source.time, "DRUG", "DRUG_NAME_GENERIC"], source.table.upper())
    return raw.select(
        F.col(key).cast("bigint").alias(key),
        fn.timestamp(F.col(source.time)).alias(TIME),
        "DRUG",
        "DRUG_NAME_GENERIC",
    ).filter(F.col(key).isNotNull() & F.col(TIME).isNotNull())


def named_drugs(linked: DataFrame) -> DataFrame:
    """Linked prescriptions with cleaned name, key and whether a name was given."""
    drug, generic = F.col("DRUG"), F.col("DRUG_NAME_GENERIC")
    return linked.select(
        STAY,
        TIME,
        "INTIME",
        F.coalesce(drug, generic).isNotNull().alias("NAMED"),
        fn.drug_name(drug, generic).alias("DRUG_NAME"),
    )


def family_scan(tables: dict[str, DataFrame], family: Family) -> DataFrame:
    """All sources of a family in one shape (``UNION ALL`` of its tables)."""
    scan = drug_scan if family.name == "drug" else event_scan
    parts = [scan(tables[s.table], family.key, s) for s in family.sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _slot(c: Column, hours: int) -> Column:
    return F.floor(F.unix_seconds(c) / F.lit(hours * fn.clean.SECONDS_PER_HOUR)).cast("bigint")


def link_in_window(
    events: DataFrame,
    windows: StayWindows,
    key: str,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Inner join of events with the stays whose closed window contains them.

    Linking by admission fans out to every matching stay. There a time slot as
    wide as the window joins the key, so an event meets only stays near it and
    not all stays of its admission; a window touches at most two slots.
    """
    if windows.rows == 0:
        near = events.filter(F.lit(False))
    else:
        near = events.filter(
            F.col(TIME).between(
                F.timestamp_micros(F.lit(windows.first)), F.timestamp_micros(F.lit(windows.last))
            )
        )
    stays, keys, rows = windows.df, [key], windows.rows
    if key == ADMISSION:
        stays = stays.filter(F.col(ADMISSION).isNotNull()).withColumn(
            "_slot",
            F.explode(F.sequence(_slot(F.col("INTIME"), windows.hours), _slot(F.col("WINDOW_END"), windows.hours))),
        )
        near = near.withColumn("_slot", _slot(F.col(TIME), windows.hours))
        keys, rows = [key, "_slot"], 2 * rows
    else:
        stays = stays.drop(ADMISSION)
    linked = keyed_join(near, stays, keys, rows, limits)
    inside = linked.filter(F.col(TIME).between(F.col("INTIME"), F.col("WINDOW_END")))
    return inside.drop("_slot", "WINDOW_END")


def link_any_time(
    events: DataFrame, windows: StayWindows, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Events joined to their stay whenever they happened (for quality counts)."""
    return keyed_join(events, windows.df.drop(ADMISSION), [STAY], windows.rows, limits)


def last_value(value: str = VALUE, time: str = TIME) -> Column:
    """Value at the latest time; the larger value wins among equal times."""
    return F.max_by(F.col(value), F.struct(time, value))


def stat_columns(stats: tuple[str, ...]) -> list[Column]:
    known = {
        "mean": F.avg(VALUE),
        "min": F.min(VALUE),
        "max": F.max(VALUE),
        "std": F.stddev_samp(VALUE),
        "sum": F.sum(VALUE),
        "count": F.count(F.lit(1)),
        "last": last_value(),
    }
    return [known[s].alias(s) for s in stats]


def event_stats(linked: DataFrame, stats: tuple[str, ...], codes: list[int] | None = None) -> DataFrame:
    """Statistics per (stay, item), optionally for some codes only.

    Partial aggregation runs before the shuffle on (stay, item), so a busy item
    or stay costs one small row per task.
    """
    rows = linked.filter(F.col(ITEM).isin(codes)) if codes is not None else linked
    return rows.groupBy(STAY, ITEM).agg(*stat_columns(stats))


def drug_counts(linked: DataFrame) -> DataFrame:
    """Prescriptions per (stay, drug key), and how many of them had a name."""
    return (
        named_drugs(linked)
        .withColumn("DRUG_KEY", fn.drug_key(F.col("DRUG_NAME")))
        .groupBy(STAY, "DRUG_KEY")
        .agg(F.count(F.lit(1)).alias("count"), F.count_if("NAMED").alias("named"))
    )


def summarise(linked: DataFrame, keys: list[str]) -> DataFrame:
    """Mergeable summary rows: count, mean, squared deviations, sum, min, max, last."""
    return linked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(VALUE).alias("mean"),
        (F.var_pop(VALUE) * F.count(F.lit(1))).alias("m2"),
        F.sum(VALUE).alias("sum"),
        F.min(VALUE).alias("min"),
        F.max(VALUE).alias("max"),
        F.max(TIME).alias("last_time"),
        last_value().alias("last"),
    )


def merge_stats(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Combine summary rows of disjoint parts (days, files) to final statistics.

    Squared deviations are merged around the combined mean rather than through
    the sum of squares, which would cancel for large values. The first grouping
    finds the combined means and the second shifts each part by a join with them;
    both combine rows before they are shuffled, so a key with very many parts
    costs one row per task.
    """
    means = parts.groupBy(*keys).agg(
        (F.sum(F.col("mean") * F.col("count")) / F.sum("count")).alias("_mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("count").alias("count"),
        F.sum("sum").alias("sum"),
        F.max_by("last", F.struct("last_time", "last")).alias("last"),
    )
    shifted = null_safe_join(parts.select(*keys, "m2", "count", "mean"), means.select(*keys, "_mean"), keys)
    spread = shifted.groupBy(*keys).agg(
        F.sum(F.col("m2") + F.col("count") * (F.col("mean") - F.col("_mean")) ** 2).alias("_m2")
    )
    merged = null_safe_join(means, spread, keys)
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1)))
    return merged.select(*keys, F.col("_mean").alias("mean"), "min", "max", std.alias("std"), "count", "sum", "last")
