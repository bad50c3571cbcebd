"""Session defaults and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# A task of a finely dealt shuffle gets about so many stays, and merged partitions hold at most so many bytes.
FINE_STAYS = 5_000
FINE_BYTES = "8m"


def build_session(app: str = "staylens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, adaptive plans)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder intermediate tables are written to.

    It is the one the cluster names in ``spark.checkpoint.dir``; without that
    setting it lies in the warehouse, which all executors share too.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staylens-scratch"


def scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/staylens-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to the scratch folder."""
    drop_path(spark, scratch_folder(spark))


def drop_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def fine_shuffles(spark: SparkSession, stays: int) -> Iterator[None]:
    """Jobs started inside have as many shuffle partitions as ``stays`` need.

    Rows of statistics compress well, so partitions merged up to Spark's usual size
    would sort many times as many bytes in one task.
    """
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stays // FINE_STAYS))
    with _settings(spark, {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.advisoryPartitionSizeInBytes": FINE_BYTES}):
        yield


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside hand Python at most ``rows`` rows at a time.

    For rows of many kilobytes: the next batch is written while one is worked on.
    """
    with _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        yield


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def keep(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Later steps then start from files that outlive any executor, and read only
    the columns they need.
    """
    return keep_at(df, new_path(df.sparkSession, label), partition_by)


def keep_at(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """``keep`` under a given new path, for callers that drop the table themselves."""
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
