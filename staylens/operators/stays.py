"""Stay (unit) table, observation windows and context features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.schemas import (
    ADMISSION,
    ADMISSION_CATEGORIES,
    STAY,
    STAY_CATEGORIES,
    SUBJECT,
    TARGET,
)
from staylens.sources.raw import require_columns


def _optional(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def unit_table(icustays: DataFrame, category_mode: str = "plain") -> DataFrame:
    """One row per stay: ids, cleaned stay categories, entry time and LOS.

    Rows without stay id or entry time are dropped. LOS falls back per row to
    the time between entry and exit and may stay NULL: such stays still count
    when codes are selected and leave only the feature table.
    """
    require_columns(icustays, [SUBJECT, ADMISSION, STAY, "INTIME"], "ICUSTAYS")
    if not {TARGET, "OUTTIME"} & set(icustays.columns):
        raise ValueError("ICUSTAYS needs LOS or OUTTIME to derive the target")
    return (
        icustays.select(
            *[F.col(c).cast("bigint").alias(c) for c in (SUBJECT, ADMISSION, STAY)],
            *[
                fn.category(F.col(c), category_mode).alias(c)
                for c in STAY_CATEGORIES
                if c in icustays.columns
            ],
            fn.timestamp(F.col("INTIME")).alias("INTIME"),
            fn.timestamp(_optional(icustays, "OUTTIME")).alias("OUTTIME"),
            _optional(icustays, TARGET).alias(TARGET),
        )
        .withColumn(TARGET, fn.length_of_stay(F.col(TARGET), F.col("INTIME"), F.col("OUTTIME")))
        .drop("OUTTIME")
        .filter(F.col(STAY).isNotNull() & F.col("INTIME").isNotNull())
    )


@dataclass(frozen=True)
class StayWindows:
    """Per stay: both link keys and the closed window, plus counted bounds.

    ``rows`` decides whether the table may be broadcast; ``first`` and ``last``
    (microseconds) bound all windows and are pushed into the event scans.
    """

    df: DataFrame
    hours: int
    rows: int
    first: int | None
    last: int | None


def stay_windows(stays: DataFrame, hours: int) -> StayWindows:
    df = stays.select(
        STAY, ADMISSION, "INTIME", fn.window_end(F.col("INTIME"), hours).alias("WINDOW_END")
    )
    bounds = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.unix_micros(F.min("INTIME")).alias("first"),
        F.unix_micros(F.max("WINDOW_END")).alias("last"),
    ).first()
    return StayWindows(df, hours, bounds["rows"], bounds["first"], bounds["last"])


def patient_context(patients: DataFrame, category_mode: str = "plain") -> DataFrame:
    require_columns(patients, [SUBJECT, "GENDER", "DOB"], "PATIENTS")
    return patients.select(
        F.col(SUBJECT).cast("bigint").alias(SUBJECT),
        fn.category(F.col("GENDER"), category_mode).alias("GENDER"),
        F.to_date(fn.timestamp(F.col("DOB"))).alias("DOB"),
    )


def admission_context(admissions: DataFrame, category_mode: str = "plain") -> DataFrame:
    require_columns(admissions, [SUBJECT, ADMISSION], "ADMISSIONS")
    columns = [
        fn.category(F.col(c), category_mode).alias(c)
        for c in ADMISSION_CATEGORIES
        if c in admissions.columns
    ]
    if "HAS_CHARTEVENTS_DATA" in admissions.columns:
        columns.append(F.col("HAS_CHARTEVENTS_DATA").try_cast("bigint").alias("HAS_CHARTEVENTS_DATA"))
    if {"EDREGTIME", "EDOUTTIME"} <= set(admissions.columns):
        arrived, left = fn.timestamp(F.col("EDREGTIME")), fn.timestamp(F.col("EDOUTTIME"))
        columns.append(fn.elapsed(arrived, left, fn.clean.SECONDS_PER_HOUR).alias("ED_LOS_HOURS"))
    return admissions.select(
        F.col(SUBJECT).cast("bigint").alias(SUBJECT), F.col(ADMISSION).cast("bigint").alias(ADMISSION), *columns
    )


def context_features(
    stays: DataFrame,
    patients: DataFrame | None = None,
    admissions: DataFrame | None = None,
    age_mode: str = "year_boundary",
    category_mode: str = "plain",
) -> DataFrame:
    """Stays with LOS plus gender, age and admission features (left joins).

    The dimension sides carry text, so no broadcast is forced: Spark broadcasts
    them by their own size or shuffles, and adaptive skew handling splits a
    subject with very many stays.
    """
    ages = {"year_boundary": fn.age_year_boundary, "exact": fn.age_exact}
    if age_mode not in ages:
        raise ValueError(f"unknown age mode {age_mode!r}; use one of {sorted(ages)}")
    out = stays.filter(F.col(TARGET).isNotNull())
    order = [c for c in (SUBJECT, ADMISSION, STAY, *STAY_CATEGORIES, TARGET) if c in out.columns]
    if patients is not None:
        out = out.join(patient_context(patients, category_mode), SUBJECT, "left")
        out = out.withColumn("AGE", ages[age_mode](F.col("DOB"), F.to_date("INTIME")))
        order += ["GENDER", "AGE"]
    if admissions is not None:
        extra = admission_context(admissions, category_mode)
        order += [c for c in extra.columns if c not in (SUBJECT, ADMISSION)]
        out = out.join(extra, [SUBJECT, ADMISSION], "left")
    return out.select(*order)


def assert_unique(df: DataFrame, keys: list[str], name: str) -> None:
    """Raise when a dimension would duplicate stays."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"{name} has more than one row for some {keys}")
