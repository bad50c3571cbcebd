"""Regression models of the benchmark, fitted on ``features``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.plans.artifacts import LogTargetModel, fit_log_target
from staylens.plans.linear import LinearModel, fit_closed_form
from staylens.plans.prepare import FEATURES
from staylens.plans.trees import Boost, Forest, TreeModel, bin_rows, boost, boosted_model, forest_model, plant, plant_all
from staylens.schemas import STAY, TARGET

PREDICTION = "prediction"
# The closed form returns a matrix of features squared to the driver.
NORMAL_SOLVER_FEATURES = 4096
# Bounds of the iterative solver.
RIDGE_TOLERANCE, RIDGE_ITERATIONS = 1e-15, 3_000
# Boosting that stops early does so after this many rounds without a better error.
PATIENCE = 10


def with_log_target(df: DataFrame) -> DataFrame:
    return df.withColumn(TARGET, F.log1p(TARGET))


def without_log(df: DataFrame, column: str = PREDICTION) -> DataFrame:
    return df.withColumn(column, F.expm1(column))


def fit_mean(train: DataFrame) -> PipelineModel:
    """Predicts the mean target of train for every row."""
    mean = train.agg(F.avg(TARGET)).first()[0]
    if mean is None:
        raise ValueError("the training set has no target")
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {mean!r}D AS {PREDICTION} FROM __THIS__")])


def fit_ridge(train: DataFrame, alpha: float = 1.0, solver: str = "normal") -> LinearModel | PipelineModel:
    """Ridge regression on standardised features.

    ``solver="normal"`` is the closed form; beyond its limit of features it is
    refused, and ``"l-bfgs"`` must be asked for. That one minimises mean squared
    error with the target scaled to unit deviation and standardises with the sample
    deviation, while ``alpha`` belongs to the sum of squares over
    population-standardised features. Both are constants for one training set and
    are folded into the penalty.
    """
    if solver == "normal":
        return fit_closed_form(train, alpha, NORMAL_SOLVER_FEATURES)
    n, spread = train.agg(F.count(TARGET), F.stddev_pop(TARGET)).first()
    penalty = alpha * (n - 1) / n * spread / n
    scaler = StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=True, withStd=True)
    ridge = LinearRegression(
        featuresCol="scaled",
        labelCol=TARGET,
        regParam=penalty,
        elasticNetParam=0.0,
        standardization=False,
        solver=solver,
        tol=RIDGE_TOLERANCE,
        maxIter=RIDGE_ITERATIONS,
    )
    return Pipeline(stages=[scaler, ridge]).fit(train)


def fit_forest(train: DataFrame, **options) -> TreeModel:
    """Random forest; ``options`` are those of ``Forest`` (250 trees of any depth)."""
    rows, forest = bin_rows(train), Forest(**options)
    return forest_model(rows, plant(rows, forest))


def fit_boosted(train: DataFrame, early_stop_share: float | None = None, **options) -> TreeModel:
    """Boosting on all rows; ``options`` are those of ``Boost`` (250 rounds of 31 leaves).

    ``early_stop_share`` holds out that hashed share of the stays and stops after
    ``PATIENCE`` rounds without a better error on it.
    """
    if not early_stop_share:
        rows = bin_rows(train)
        return boosted_model(rows, boost(rows, [Boost(**options)])[0])
    held_out = fn.hash_fraction(F.col(STAY), options.get("seed", 42)) < early_stop_share
    rows = bin_rows(train.withColumn("_held_out", held_out.cast("int")), "_held_out")
    return boosted_model(rows, boost(rows, [Boost(held=1, patience=PATIENCE, **options)])[0])


def fit_forest_folds(train: DataFrame, fold: str, folds: list[int], **options) -> list[TreeModel]:
    """A forest per held fold; rows are binned once and all folds grow in the same jobs."""
    rows = bin_rows(train, fold)
    return [forest_model(rows, nodes) for nodes in plant_all(rows, [Forest(held=f, **options) for f in folds])]


def fit_boosted_folds(train: DataFrame, fold: str, folds: list[int], **options) -> list[TreeModel]:
    """A boosted model per held fold; all folds advance in the same jobs."""
    rows = bin_rows(train, fold)
    return [boosted_model(rows, x) for x in boost(rows, [Boost(held=f, **options) for f in folds])]


@dataclass(frozen=True)
class ModelSpec:
    """A named way to fit a model on prepared vectors.

    ``fit_folds(train, fold column, folds)`` gives one model per held fold where
    that is cheaper than one fit after the other.
    """

    name: str
    fit: Callable[[DataFrame], object]
    fit_folds: Callable[[DataFrame, str, list[int]], list] | None = None


def on_log_target(spec: ModelSpec) -> ModelSpec:
    """The same model fitted on the logarithm; it predicts in the target's own unit."""

    def folds(train: DataFrame, *rest):
        return [LogTargetModel(m) for m in spec.fit_folds(with_log_target(train), *rest)]

    return ModelSpec(spec.name, lambda train: fit_log_target(train, spec.fit), spec.fit_folds and folds)


def baseline_models(
    forest_options: dict | None = None, boosted_options: dict | None = None, alpha: float = 1.0
) -> list[ModelSpec]:
    """The four baselines in order of complexity."""
    trees, rounds = forest_options or {}, boosted_options or {}
    return [
        ModelSpec("Mean", fit_mean),
        ModelSpec("Ridge", lambda train: fit_ridge(train, alpha)),
        ModelSpec("RandomForest", lambda train: fit_forest(train, **trees), lambda *a: fit_forest_folds(*a, **trees)),
        ModelSpec("GradientBoosting", lambda train: fit_boosted(train, **rounds), lambda *a: fit_boosted_folds(*a, **rounds)),
    ]
