"""Quality reports and audits as (metric, value) tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators import events as ev
from staylens.operators.joins import left_join
from staylens.operators.quantiles import exact_quantiles
from staylens.schemas import ID_COLUMNS, STAY, SUBJECT, TARGET
from staylens.session import keep
from staylens.settings import CHART, JoinLimits, Settings

MISSING_RATES_SHOWN = 25
RATE_DIGITS = 6
HISTOGRAM_BINS = 40


def metric_rows(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Many aggregates in one pass, turned into (metric, value) rows."""
    wide = df.agg(*[c.cast("double").alias(f"m{i}") for i, c in enumerate(metrics.values())])
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").alias("value")) for i, m in enumerate(metrics)]
    )
    return wide.select(F.explode(pairs).alias("_m")).select("_m.*")


def constant_rows(df: DataFrame, metrics: Mapping[str, float]) -> DataFrame:
    rows = [(m, float(v)) for m, v in metrics.items()]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def link_counts(tables: Mapping[str, DataFrame], windows, limits: JoinLimits) -> DataFrame:
    """Usable chart events: all, linked to a stay, before, in and after the window.

    The item may be missing here, so the scan differs from that of the features.
    A left join to the stays gives all five numbers in one scan; a stay is unique.
    """
    source = CHART.sources[0]
    valid = ev.usable_events(tables[source.table], STAY, source).select(
        F.col(STAY).cast("bigint").alias(STAY), ev.TIME
    )
    time = F.col(ev.TIME)
    side = windows.df.select(STAY, "INTIME", "WINDOW_END").withColumn("_stay", F.col(STAY))
    met = left_join(valid, side, STAY, windows.rows, limits)
    return metric_rows(
        met,
        {
            "valid_numeric_chartevents": F.count(F.lit(1)),
            "chartevents_linked_to_icustay": F.count("_stay"),
            "chartevents_before_intime": F.count_if(time < F.col("INTIME")),
            "chartevents_in_prediction_window": F.count_if(time.between(F.col("INTIME"), F.col("WINDOW_END"))),
            "chartevents_after_prediction_window": F.count_if(time > F.col("WINDOW_END")),
        },
    )


def stay_counts(stays: DataFrame) -> DataFrame:
    return metric_rows(
        stays.filter(F.col(TARGET).isNotNull()),
        {
            "icustays_after_target_filter": F.count(F.lit(1)),
            "patients_after_target_filter": F.countDistinct(SUBJECT),
        },
    )


def quality_base(tables: Mapping[str, DataFrame], run) -> DataFrame:
    """Report of the 5-table group (11 metrics)."""
    settings: Settings = run.settings
    return _union(
        [
            constant_rows(
                run.features,
                {
                    "window_hours": settings.window_hours,
                    "top_n_items": settings.top_n_chart,
                    "selected_items": len(run.selected),
                },
            ),
            stay_counts(run.stays),
            metric_rows(run.features, {"preprocessed_rows": F.count(F.lit(1))}),
            link_counts(tables, run.windows, settings.limits),
        ]
    )


def quality_group(run) -> DataFrame:
    """Report of the larger table groups: 5, 7 or 12 metrics."""
    settings: Settings = run.settings
    names = {"chart": "chart_items", "lab": "lab_items", "output": "output_items", "input": "input_items", "drug": "drugs"}
    families = [f.name for f in run.group.families]
    numbers: dict[str, float] = {}
    if run.group.needs_chart:
        numbers["version_tables"] = run.group.tables
    numbers["window_hours"] = settings.window_hours
    if not run.group.needs_chart:
        numbers.update({f"top_n_{names[f]}": settings.top_n(f) for f in families})
    numbers.update({f"selected_{names[f]}": len(run.selected_in(f)) for f in families})
    return constant_rows(run.features, numbers).unionByName(
        metric_rows(run.features, {"preprocessed_rows": F.count(F.lit(1))})
    )


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*ID_COLUMNS, TARGET)]


def missing_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of NULL per column, from one aggregate over all columns."""
    columns = columns if columns is not None else df.columns
    counted = ", ".join(f"count(`{c}`)" for c in columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), F.expr(f"array({counted})").alias("_counts"))
    names = F.array(*[F.lit(c) for c in columns])
    # An empty table has no rates.
    return (
        wide.filter(F.col("_n") > 0)
        .select("_n", F.explode(F.arrays_zip(names.alias("column"), F.col("_counts").alias("filled"))).alias("_m"))
        .select("_m.column", (1.0 - F.col("_m.filled") / F.col("_n")).alias("missing_rate"))
    )


def top_missing(df: DataFrame, columns: list[str], n: int = MISSING_RATES_SHOWN) -> DataFrame:
    return missing_rates(df, columns).orderBy(F.desc("missing_rate"), "column").limit(n)


def quality_local(tables: Mapping[str, DataFrame], run) -> DataFrame:
    """Report of the file-based flow: 15 metrics and the 25 highest missing rates.

    The features are written first, since three parts of the report read them.
    """
    run = replace(run, features=keep(run.features, "quality"))
    columns = feature_names(run.features)
    with_chart = run.features.agg(F.countDistinct(STAY).alias("n"))
    stays = run.stays.filter(F.col(TARGET).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    coverage = (
        with_chart.select(F.col("n").alias("with"), F.lit(0).cast("bigint").alias("all"))
        .unionByName(stays.select(F.lit(0).cast("bigint").alias("with"), F.col("n").alias("all")))
    )
    rates = top_missing(run.features, columns).select(
        F.concat(F.lit(f"missing_rate_top{MISSING_RATES_SHOWN}."), F.col("column")).alias("metric"),
        F.round("missing_rate", RATE_DIGITS).alias("value"),
    )
    shape = constant_rows(
        run.features,
        {"preprocessed_columns": len(run.features.columns), "model_feature_columns": len(columns)},
    )
    covered = metric_rows(
        coverage,
        {
            "icustays_with_chart_features": F.sum("with"),
            "icustays_without_chart_features": F.sum("all") - F.sum("with"),
        },
    )
    return _union([quality_base(tables, run), shape, covered, rates])


def audit(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and column differences of both sets."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        missing = F.expr(" + ".join(f"CAST(`{c}` IS NULL AS BIGINT)" for c in df.columns))
        return metric_rows(
            df,
            {
                f"{name}_rows": F.count(F.lit(1)),
                f"{name}_missing_cells": F.coalesce(F.sum(missing), F.lit(0)),
                f"target_{name}_missing": F.count_if(F.col(TARGET).isNull()),
            },
        )

    shape = {
        "train_columns": len(train.columns),
        "test_columns": len(test.columns),
        "columns_only_in_train": len(set(train.columns) - set(test.columns)),
        "columns_only_in_test": len(set(test.columns) - set(train.columns)),
        **{f"train_has_{c}": c in train.columns for c in (*ID_COLUMNS, TARGET)},
        **{f"test_has_{c}": c in test.columns for c in (*ID_COLUMNS, TARGET)},
    }
    return _union([counts(train, "train"), counts(test, "test"), constant_rows(train, shape)])


def stays_per_patient(df: DataFrame) -> DataFrame:
    per = df.groupBy(SUBJECT).agg(F.countDistinct(STAY).alias("stays"))
    return metric_rows(
        per,
        {
            "patients": F.count(F.lit(1)),
            "patients_with_several_stays": F.count_if(F.col("stays") > 1),
            "max_stays_of_one_patient": F.max("stays"),
        },
    )


def target_summary(df: DataFrame, rows: int | None = None, column: str = TARGET) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of the target."""
    values = df.select(F.lit(0).alias("_g"), F.col(column).alias("v")).filter(F.col("v").isNotNull())
    rows = values.count() if rows is None else rows
    basic = metric_rows(
        values,
        {"count": F.count("v"), "mean": F.avg("v"), "std": F.stddev_samp("v"), "min": F.min("v"), "max": F.max("v")},
    )
    quartiles = exact_quantiles(values, ["_g"], "v", [0.25, 0.5, 0.75], rows)
    named = quartiles.select(
        F.concat((F.col("q") * 100).cast("int").cast("string"), F.lit("%")).alias("metric"), "value"
    )
    return basic.unionByName(named)


def target_histogram(df: DataFrame, bins: int = HISTOGRAM_BINS, column: str = TARGET) -> DataFrame:
    """Equal-width histogram; the last bin includes the maximum, empty bins show 0."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.filter(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(width)).alias("bin_start"),
        (F.lit(low) + (F.col("id") + 1) * F.lit(width)).alias("bin_end"),
    )
    return edges.join(counted, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )
