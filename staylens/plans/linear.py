"""Ridge regression in closed form, its Gram matrix summed on Spark."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.schemas import FEATURES, TARGET

# A variance below this share of the squared mean is rounding.
CONSTANT = 1e-20


@dataclass(frozen=True)
class LinearModel:
    """prediction = intercept + weights * features; means and deviations of train."""

    weights: tuple[float, ...]
    intercept: float
    means: tuple[float, ...] = ()
    deviations: tuple[float, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array(F.col(FEATURES)), F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        total = F.aggregate(products, F.lit(self.intercept), lambda a, x: a + x)
        return df.withColumn("prediction", total)

    def used_features(self) -> list[int]:
        return [i for i, w in enumerate(self.weights) if w]


def centred_products(train: DataFrame, means: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of centred columns, the target last.

    Each task adds up its own matrix; the rows of the matrices are added after one
    shuffle, so no more than (features + 1) rows return.
    """
    width = len(means)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width - 1)
                z = np.column_stack([x, batch.column("y").to_numpy(zero_copy_only=False)]) - means
                total += z.T @ z
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(width), pa.int32()), "cells": pa.array([r.tobytes() for r in total])})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, cells in zip(batch.column("at").to_pylist(), batch.column("cells").to_pylist()):
                sums[at] = sums.get(at, 0) + np.frombuffer(cells)
        if sums:
            yield pa.RecordBatch.from_pydict({"at": pa.array(list(sums), pa.int32()), "cells": pa.array([r.tobytes() for r in sums.values()])})

    rows = train.select(vector_to_array(FEATURES).alias("x"), F.col(TARGET).cast("double").alias("y"))
    found = rows.mapInArrow(partial, "at int, cells binary").repartition("at").mapInArrow(added, "at int, cells binary").collect()
    return np.array([np.frombuffer(r["cells"]) for r in sorted(found, key=lambda r: r["at"])])


def fit_closed_form(train: DataFrame, alpha: float, most_features: int) -> LinearModel:
    """Weights that minimise squared error + alpha * squared weights of standardised features.

    Columns without spread get weight zero and take no part in the equations, which
    are then never singular for a positive ``alpha``.
    """
    train = train.filter(F.col(TARGET).isNotNull())
    at = F.posexplode(F.concat(vector_to_array(FEATURES), F.array(F.col(TARGET).cast("double")))).alias("at", "v")
    size = train.select(F.count(F.lit(1)), F.max(F.size(vector_to_array(FEATURES)))).first()
    if not size[0]:
        raise ValueError("the training set has no target")
    if size[1] > most_features:
        raise ValueError(f"the closed form takes {most_features} features, not {size[1]}; use solver='l-bfgs'")
    sums = train.select(at).groupBy("at").agg(F.avg("v").alias("mean")).collect()
    means = np.array([r["mean"] for r in sorted(sums, key=lambda r: r["at"])])
    products = centred_products(train, means)
    variance = np.diag(products)[:-1] / size[0]
    kept = np.flatnonzero(variance > CONSTANT * (1 + means[:-1] ** 2))
    deviation = np.sqrt(variance[kept])
    gram = products[np.ix_(kept, kept)] / np.outer(deviation, deviation)
    beta = np.linalg.solve(gram + alpha * np.eye(len(kept)), products[kept, -1] / deviation)
    weights, deviations = np.zeros(size[1]), np.zeros(size[1])
    weights[kept], deviations[kept] = beta / deviation, deviation
    intercept = float(means[-1] - weights @ means[:-1])
    return LinearModel(tuple(weights.tolist()), intercept, tuple(means[:-1].tolist()), tuple(deviations.tolist()))
