"""Leakage-safe preparation: learned on train, applied to any feature table."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from staylens import functions as fn
from staylens.operators.quantiles import column_medians
from staylens.operators.split import exact_group_split, group_split, model_columns
from staylens.schemas import FEATURES, ID_COLUMNS, PREPARED, TARGET
from staylens.session import keep
from staylens.settings import Settings

log = logging.getLogger(__name__)


def split_types(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical): text is categorical, everything else numeric."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return [c for c in columns if c not in text], [c for c in columns if c in text]


@dataclass(frozen=True)
class NumericFit:
    column: str
    median: float | None
    mean: float
    std: float
    rows: int
    missing: int


@dataclass(frozen=True)
class CategoryFit:
    column: str
    mode: str | None
    values: tuple[str, ...]


def fit_numeric(train: DataFrame, columns: list[str]) -> list[NumericFit]:
    """Exact median, and mean and population deviation after imputing it.

    The moments after imputation follow from those before, because imputation adds
    a block of equal values; one row per column returns.
    """
    found = column_medians(train, columns)
    fits = []
    for column in columns:
        r = found[column]
        if not r["n"]:
            fits.append(NumericFit(column, None, 0.0, 0.0, r["rows"], r["rows"]))
            continue
        share, median = r["n"] / r["rows"], r["median"]
        mean = share * r["mean"] + (1 - share) * median
        var = share * r["var"] + share * (1 - share) * (r["mean"] - median) ** 2
        fits.append(NumericFit(column, median, mean, var**0.5, r["rows"], r["rows"] - r["n"]))
    return fits


def category_table(train: DataFrame, columns: list[str]) -> DataFrame:
    """The dictionary: position, value, rows, and the value's place in its column."""
    values = F.array(*[F.col(fn.sql_name(c)).cast("string") for c in columns])
    counts = train.select(F.posexplode(values).alias("position", "value")).filter(F.col("value").isNotNull())
    counts = counts.groupBy("position", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("position").orderBy("value")) - 1)


def fit_categories(train: DataFrame, columns: list[str]) -> list[CategoryFit]:
    """Most frequent value (lowest on a tie) and the known values per column.

    The dictionary is written as a table; a column's values become output columns,
    so what returns is bounded by the schema of the result.
    """
    if not columns:
        return []
    table = keep(category_table(train, columns), "categories")
    order = F.struct(-F.col("rows"), "value")
    known = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"])
    fits = table.groupBy("position").agg(F.min(order)["value"].alias("mode"), known.alias("known")).collect()
    by_position = {r["position"]: r for r in fits}
    empty = {"mode": None, "known": ()}
    return [CategoryFit(c, r["mode"], tuple(r["known"])) for c, r in ((c, by_position.get(i, empty)) for i, c in enumerate(columns))]


def _scaled(expression: str, mean: float, std: float) -> str:
    if std == 0:
        return f"({expression} - {mean!r}D)"
    return f"(({expression} - {mean!r}D) / {std!r}D)"


@dataclass(frozen=True)
class Preparation:
    """A fitted preparation: a Spark ML pipeline and the names of its outputs."""

    pipeline: PipelineModel
    names: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Ids and target plus one ``features`` vector of all outputs, sparse where that is smaller."""
        return self.pipeline.transform(df)

    def vectors(self, prepared: DataFrame) -> DataFrame:
        """``prepared`` with the outputs as an array too."""
        return prepared.withColumn(PREPARED, vector_to_array(F.col(FEATURES)))

    def flat(self, prepared: DataFrame, kind: str = "double") -> DataFrame:
        """One column per feature; ``float`` halves the size of an export."""
        keep_columns = [c for c in prepared.columns if c not in (PREPARED, FEATURES)]
        cells = [f"CAST({PREPARED}[{i}] AS {kind}) AS {fn.sql_name(n)}" for i, n in enumerate(self.names)]
        return self.vectors(prepared).selectExpr(*keep_columns, *cells)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        names = spark.createDataFrame(list(enumerate(self.names)), "position int, name string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/names")

    @staticmethod
    def load(path: str) -> Preparation:
        spark = SparkSession.getActiveSession()
        names = spark.read.parquet(f"{path}/names").orderBy("position").collect()
        return Preparation(PipelineModel.load(f"{path}/pipeline"), tuple(r["name"] for r in names))


def build_preparation(numeric: list[NumericFit], categories: list[CategoryFit]) -> Preparation:
    """Turn fitted values into a pipeline of Spark ML stages.

    Outputs in order: imputed and scaled numbers, scaled missing indicators,
    one column per known category. A numeric column without any value in train
    has no median and gives only its indicator; an unseen category is all zero.
    """
    names, numbers = [], []
    for f in numeric:
        if f.median is None:
            log.warning("column %s has no value in train and is left out", f.column)
            continue
        value = f"CAST({fn.sql_name(f.column)} AS DOUBLE)"
        filled = f"COALESCE(NANVL({value}, NULL), {f.median!r}D)"
        names.append(f.column)
        numbers.append(_scaled(filled, f.mean, f.std))
    for f in numeric:
        if f.missing:
            share = f.missing / f.rows
            value = f"CAST({fn.sql_name(f.column)} AS DOUBLE)"
            flag = f"CAST(NANVL({value}, NULL) IS NULL AS DOUBLE)"
            names.append(f"missingindicator_{f.column}")
            numbers.append(_scaled(flag, share, (share * (1 - share)) ** 0.5))
    known = [c for c in categories if c.mode is not None]
    for c in categories:
        if c.mode is None:
            log.warning("column %s has no value in train and is left out", c.column)
        names += [f"{c.column}_{v}" for v in c.values]
    # The encoder takes no empty labels, so every value gets a mark in front.
    filled = [f"CONCAT('=', COALESCE({fn.sql_name(c.column)}, {fn.sql_text(c.mode)}))" for c in known]
    cells = [f"{x} AS _n{i}" for i, x in enumerate(numbers)] + [f"{x} AS _c{i}" for i, x in enumerate(filled)]
    kept = ", ".join([*ID_COLUMNS, TARGET])
    stages = [SQLTransformer(statement=f"SELECT {', '.join([kept, *cells])} FROM __THIS__")]
    inputs = [f"_n{i}" for i in range(len(numbers))]
    if known:
        columns = {tag: [f"_{tag}{i}" for i in range(len(known))] for tag in "cih"}
        # An unseen value takes the place after the known ones, which is then dropped.
        for c, shown, index in zip(known, columns["c"], columns["i"]):
            stages.append(StringIndexerModel.from_labels([f"={v}" for v in c.values], shown, index, handleInvalid="keep"))
        spark = SparkSession.getActiveSession()
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns["c"]))
        encoder = OneHotEncoder(inputCols=columns["i"], outputCols=columns["h"], dropLast=True)
        stages.append(encoder.fit(PipelineModel(stages[1:]).transform(empty)))
        inputs += columns["h"]
    if not inputs:
        raise ValueError("no column has a value in train")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    stages.append(SQLTransformer(statement=f"SELECT {kept}, {FEATURES} FROM __THIS__"))
    return Preparation(PipelineModel(stages), tuple(names))


def fit_preparation(train: DataFrame, exclude: tuple[str, ...] = ()) -> Preparation:
    numeric, categorical = split_types(train, model_columns(train.columns, exclude))
    return build_preparation(fit_numeric(train, numeric), fit_categories(train, categorical))


@dataclass(frozen=True)
class PreparedData:
    train: DataFrame
    test: DataFrame
    preparation: Preparation


def prepare(features: DataFrame, settings: Settings = Settings(), path: str | None = None) -> PreparedData:
    """Split by patient, fit on train, transform both sides.

    The feature table is written once before the passes of the fit, and the
    prepared sets are written before they train models. With ``path`` the
    prepared sets and the fitted preparation are kept there.
    """
    features = keep(features, "features")
    split = exact_group_split if settings.exact_split else group_split
    train, test = split(features, settings.test_size, settings.seed)
    preparation = fit_preparation(train, settings.exclude)
    out = {"train": preparation.transform(train), "test": preparation.transform(test)}
    for name, df in out.items():
        if path is None:
            out[name] = keep(df, name)
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = df.sparkSession.read.parquet(f"{path}/{name}")
    if path is not None:
        preparation.save(f"{path}/preparation")
    return PreparedData(out["train"], out["test"], preparation)
