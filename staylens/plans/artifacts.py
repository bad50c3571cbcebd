"""Versioned folders for fitted models and published results.

A version is a new folder whose description is written last; readers take the
newest version that has one, so a write that was cut short is never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import sql_name
from staylens.plans.linear import LinearModel
from staylens.plans.trees import TreeModel
from staylens.schemas import TARGET
from staylens.sources.sinks import export_csv, read_export

FORMAT = 1
MANIFEST = "manifest"


@dataclass(frozen=True)
class LogTargetModel:
    """A model fitted on log1p of the target; predictions are in the target's own unit."""

    inner: object

    def transform(self, df: DataFrame) -> DataFrame:
        return self.inner.transform(df).withColumn("prediction", F.expm1("prediction"))

    def used_features(self) -> list[int]:
        return self.inner.used_features()


def fit_log_target(train: DataFrame, fit) -> LogTargetModel:
    """``fit`` on the logarithm of the target."""
    return LogTargetModel(fit(train.withColumn(TARGET, F.log1p(TARGET))))


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions in ``folder``, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/v*/{MANIFEST}/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    names = [str(f.getPath().getParent().getParent().getName()) for f in found or []]
    return sorted(int(n.split("-")[0][1:]) for n in names)


def _version_path(spark: SparkSession, folder: str, version: int | None) -> str:
    versions = _versions(spark, folder)
    if version is None and versions:
        version = versions[-1]
    if version not in versions:
        raise FileNotFoundError(f"{folder} holds no complete version {'' if version is None else version}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{version}-*/{MANIFEST}/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    # Two writers may have taken one number; the names decide which one counts.
    return sorted(str(f.getPath().getParent().getParent()) for f in found)[0]


def _new_version(spark: SparkSession, folder: str) -> tuple[int, str]:
    number = (_versions(spark, folder) or [0])[-1] + 1
    return number, f"{folder}/v{number}-{uuid.uuid4().hex[:8]}"


def _describe(spark: SparkSession, path: str, content: dict) -> None:
    rows = spark.createDataFrame([(json.dumps({"format": FORMAT, **content}, sort_keys=True),)], "content string")
    rows.coalesce(1).write.text(f"{path}/{MANIFEST}")


def _description(spark: SparkSession, path: str) -> dict:
    content = json.loads(spark.read.text(f"{path}/{MANIFEST}").first()[0])
    if content["format"] != FORMAT:
        raise ValueError(f"{path} has format {content['format']}, this library reads {FORMAT}")
    return content


# ---------------------------------------------------------------------- models


def save_model(model, folder: str, names: tuple[str, ...]) -> int:
    """Write a fitted model and the names of its features as a new version."""
    spark = SparkSession.getActiveSession()
    number, path = _new_version(spark, folder)
    log, inner = isinstance(model, LogTargetModel), model
    while isinstance(inner, LogTargetModel):
        inner = inner.inner
    content = {"features": list(names), "log_target": log}
    if isinstance(inner, TreeModel):
        content |= {"kind": "trees"} | inner.save(f"{path}/model")
    elif isinstance(inner, LinearModel):
        content |= {"kind": "linear", "linear": asdict(inner)}
    elif isinstance(inner, PipelineModel):
        inner.save(f"{path}/model")
        content |= {"kind": "pipeline"}
    else:
        raise TypeError(f"a {type(inner).__name__} cannot be saved")
    _describe(spark, path, content)
    return number


def load_model(folder: str, names: tuple[str, ...] | None = None, version: int | None = None):
    """The newest (or the given) version; ``names`` must be the features it was fitted on."""
    spark = SparkSession.getActiveSession()
    path = _version_path(spark, folder, version)
    content = _description(spark, path)
    if names is not None and list(names) != content["features"]:
        odd = sorted(set(names) ^ set(content["features"])) or ["their order"]
        raise ValueError(f"the features differ from those of the model: {odd[:5]}")
    if content["kind"] == "trees":
        model = TreeModel.load(f"{path}/model", content)
    elif content["kind"] == "linear":
        model = LinearModel(**{k: tuple(v) if isinstance(v, list) else v for k, v in content["linear"].items()})
    else:
        model = PipelineModel.load(f"{path}/model")
    return LogTargetModel(model) if content["log_target"] else model


# --------------------------------------------------------------------- results


def publish(folder: str, tables: Mapping[str, DataFrame], summary: Mapping | None = None, large: tuple[str, ...] = ()) -> int:
    """Write result tables as CSV and a summary as a new version; its manifest comes last.

    Tables not named in ``large`` are single files, for results whose size does not
    depend on the data; the others keep their partitions.
    """
    spark = SparkSession.getActiveSession()
    number, path = _new_version(spark, folder)
    listed = {}
    for name, df in tables.items():
        export_csv(df if name in large else df.coalesce(1), f"{path}/{name}")
        schema = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        rows = read_export(spark, f"{path}/{name}", schema).count()
        listed[name] = {"schema": schema, "rows": rows}
    _describe(spark, path, {"tables": listed, "summary": dict(summary or {})})
    return number


def read_published(folder: str, version: int | None = None) -> tuple[dict[str, DataFrame], dict]:
    """Tables and summary of a published version; raises if a table has lost rows."""
    spark = SparkSession.getActiveSession()
    path = _version_path(spark, folder, version)
    content = _description(spark, path)
    tables = {}
    for name, entry in content["tables"].items():
        tables[name] = read_export(spark, f"{path}/{name}", entry["schema"])
        if tables[name].count() != entry["rows"]:
            raise ValueError(f"{path}/{name} does not have the {entry['rows']} rows of its manifest")
    return tables, content["summary"]
