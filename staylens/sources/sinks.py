"""Writing tables, exports and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Create or replace a parquet table and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CSV = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"', "multiLine": "true"}
# NULL is written as an unquoted nothing, an empty text as "".
CSV_WRITE = {**_CSV, "nullValue": "", "emptyValue": '""'}
# The reader puts its mark for NULL where nothing stands, so the mark must not be the empty text.
CSV_READ = {**_CSV, "nullValue": "\x00", "emptyValue": ""}


def export_csv(df: DataFrame, path: str) -> None:
    """Sharded CSV with a header in every shard; NULL and empty texts stay apart."""
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def read_export(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``export_csv`` wrote, in the given schema."""
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One file, for result tables whose size does not depend on the data."""
    single = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        single.option("header", True).csv(path)
    elif fmt == "json":
        single.json(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
