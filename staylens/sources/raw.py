"""Reading the raw event and dimension files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from staylens.schemas import RAW_TABLES


# The event tables hold codes and numbers; their files may split.
SPLITTING = frozenset(
    ("chartevents", "labevents", "outputevents", "inputevents_cv", "inputevents_mv", "icustays", "patients")
)


def load_raw_table(spark: SparkSession, table: str, path: str, quoted_newlines: bool | None = None) -> DataFrame:
    """Typed scan of one CSV or CSV.gz table; a malformed row stops the job.

    The fixed schema applies by position and the header line is skipped. With
    ``quoted_newlines`` a file is read by one task; by default only tables with
    free text are read that way, so a plain event file is split.
    """
    if table not in RAW_TABLES:
        raise ValueError(f"no schema is known for table {table!r}; known: {sorted(RAW_TABLES)}")
    if quoted_newlines is None:
        quoted_newlines = table not in SPLITTING
    return (
        spark.read.schema(RAW_TABLES[table])
        .option("header", True)
        .option("multiLine", quoted_newlines)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load_raw_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    target: str,
    only: Iterable[str] | None = None,
    quoted_newlines: bool | None = None,
) -> dict[str, DataFrame]:
    """Convert CSV tables to parquet under ``target``, replacing what is there.

    ``only`` restricts the run to some table keys. Parquet splits by row group,
    so a big unsplittable source needs no shuffle after this one-time load.
    """
    chosen = dict(paths)
    if only is not None:
        unknown = sorted(set(only) - set(paths))
        if unknown:
            raise ValueError(f"unknown table keys: {unknown}")
        chosen = {key: paths[key] for key in only}
    loaded = {}
    for table, path in chosen.items():
        out = f"{target.rstrip('/')}/{table}"
        load_raw_table(spark, table, path, quoted_newlines).write.mode("overwrite").parquet(out)
        loaded[table] = spark.read.parquet(out)
    return loaded


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")


def load_projected(
    spark: SparkSession,
    path: str,
    columns: Iterable[str],
    required: Iterable[str] = (),
    name: str = "table",
    quoted_newlines: bool = True,
) -> DataFrame:
    """Read a CSV by header, normalise the names, keep the known columns.

    Header names are trimmed and upper-cased first, so lower-case files work
    too. Columns that the file lacks are left out unless they are ``required``.
    All values come back as text; the operators cast them safely.
    """
    raw = spark.read.option("header", True).option("multiLine", quoted_newlines).option("escape", '"').csv(path)
    df = raw.toDF(*[c.strip().upper() for c in raw.columns])
    require_columns(df, required, name)
    return df.select(*[c for c in columns if c in df.columns])
