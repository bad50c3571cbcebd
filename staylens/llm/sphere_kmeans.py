"""Exact k-means in integers, with lower bounds that loosen by geometry, not by full drift.

Each vector keeps its cluster, an upper bound of the distance to that centroid and
a lower bound of the distance to every other one. When centroid j moves from c to
c', no vector x can come nearer to it by more than d(x, c) - d(x, c'). All vectors
of a cluster lie in a sphere around its old centroid, and in the plane through that
centre, c and c' the difference is at most |c'c| times the cosine of the smallest
angle between the move and a line from the middle of the move into the sphere. A
cluster beside or behind the move hardly loosens, where the plain bound always
loses all of |c'c|. Vectors whose bounds meet are compared with all centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.session import drop_path, keep, keep_at, new_path

DIMENSIONS, CLUSTERS, ROUNDS = 64, 8, 10
SCALE = 1024
SEED_TEXT = "3:"
# Whole components are held within this bound, so every squared distance fits a long.
LIMIT = 1 << 26
# Bounds are doubles; two that differ by less than this share count as equal.
SLACK = 1e-9


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, held within ``LIMIT``."""
    bound = F.lit(float(LIMIT))
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("double"), bound), -bound).cast("int"))


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Exactly ``dimensions`` components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How much the lower bounds of each cluster lose: the largest over the other centroids.

    Row i of the table behind it holds, for each moved centroid j, a bound of
    d(x, old j) - d(x, new j) over the sphere of cluster i.
    """
    move = new - old
    drift = np.sqrt((move**2).sum(axis=1))
    away = old[:, None, :] - (old + new)[None, :, :] / 2
    apart = np.sqrt((away**2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = (away * move[None]).sum(axis=2) / (apart * drift[None])
        angle = np.arccos(np.clip(cosine, -1.0, 1.0)) - np.arcsin(np.clip(radius[:, None] / apart, 0.0, 1.0))
    share = np.clip(np.cos(np.clip(angle, 0.0, np.pi)), 0.0, 1.0)
    # The middle of the move inside the sphere, or no distance at all: the full drift.
    share = np.where((apart <= radius[:, None] * (1 + SLACK)) | ~np.isfinite(share), 1.0, share)
    losses = drift[None] * share
    np.fill_diagonal(losses, -np.inf)
    return np.maximum(losses.max(axis=1), 0.0) if len(old) > 1 else np.zeros(len(old))


def nearest_two(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, its squared distance, the second least squared distance)."""
    squares = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = squares.argmin(axis=1)
    at = np.arange(len(vectors))
    least = squares[at, best]
    squares[at, best] = np.iinfo(np.int64).max
    return best, least, squares.min(axis=1)


@dataclass(frozen=True)
class Moves:
    """What one round needs of the round before; a few numbers per centroid."""

    centroids: np.ndarray
    drift: np.ndarray
    loss: np.ndarray

    @staticmethod
    def between(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Moves:
        drift = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))
        return Moves(new, drift, loosening(old.astype(float), new.astype(float), radius * (1 + SLACK) + SLACK))

    def assign(self, vectors, cluster, upper, lower):
        """New (cluster, upper, lower, scanned), bounds as doubles.

        Only vectors whose bounds meet are scanned; a tie is always scanned, so the
        smaller number wins as in a full comparison.
        """
        cluster = cluster.copy()
        upper, lower = upper + self.drift[cluster], lower - self.loss[cluster]
        meet = np.flatnonzero(upper * (1 + SLACK) + SLACK >= lower)
        own = self.centroids[cluster[meet]]
        upper[meet] = np.sqrt(((vectors[meet] - own) ** 2).sum(axis=1).astype(float))
        scan = meet[upper[meet] * (1 + SLACK) + SLACK >= lower[meet]]
        if len(scan):
            cluster[scan], least, second = nearest_two(vectors[scan], self.centroids)
            upper[scan], lower[scan] = np.sqrt(least.astype(float)), np.sqrt(second.astype(float))
        return cluster, upper, lower, len(scan)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width).astype(np.int64)


STATE = ["id", "whole", "cluster", "up", "low", "sums", "n", "radius", "scanned"]


def _state_schema(id_kind: str) -> str:
    return f"id {id_kind}, whole array<int>, cluster int, up double, low double, sums array<bigint>, n bigint, radius double, scanned bigint"


def _round(moves: Moves, first: bool, width: int):
    """Rows with their new state, then one row of sums per cluster of the task."""
    clusters = len(moves.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((clusters, width), np.int64), np.zeros(clusters, np.int64)
        radius, scanned = np.zeros(clusters), 0
        for batch in batches:
            vectors = _matrix(batch.column("whole"), width)
            if not len(vectors):
                continue
            if first:
                cluster, least, second = nearest_two(vectors, moves.centroids)
                up, low, seen = np.sqrt(least.astype(float)), np.sqrt(second.astype(float)), len(vectors)
            else:
                state = (batch.column(n).to_numpy() for n in ("cluster", "up", "low"))
                cluster, up, low, seen = moves.assign(vectors, *state)
            for c in range(clusters):
                sums[c] += vectors[cluster == c].sum(axis=0)
            counts += np.bincount(cluster, minlength=clusters)
            np.maximum.at(radius, cluster, up)
            scanned += seen
            id_type = batch.schema.field("id").type
            yield out(batch.column("id"), batch.column("whole"), cluster, up, low)
        if counts.any():
            rows = out(pa.nulls(clusters, id_type), pa.nulls(clusters, pa.list_(pa.int32())), np.arange(clusters), None, None)
            yield with_sums(rows, sums, counts, radius, scanned)

    def out(ids, whole, cluster, up, low):
        size = len(cluster)
        doubles = [pa.nulls(size, pa.float64()) if x is None else pa.array(x, pa.float64()) for x in (up, low)]
        empty = [pa.nulls(size, k) for k in (pa.list_(pa.int64()), pa.int64(), pa.float64(), pa.int64())]
        return pa.RecordBatch.from_arrays([ids, whole.cast(pa.list_(pa.int32())), pa.array(cluster, pa.int32()), *doubles, *empty], names=STATE)

    def with_sums(rows, sums, counts, radius, scanned):
        columns = rows.columns[:5] + [
            pa.array(sums.tolist(), pa.list_(pa.int64())),
            pa.array(counts, pa.int64()),
            pa.array(radius, pa.float64()),
            pa.array([scanned] + [0] * (len(counts) - 1), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=STATE)

    return run


@dataclass(frozen=True)
class Totals:
    """Sums of one round over all tasks: a row per cluster."""

    sums: list
    counts: list
    radius: np.ndarray
    scanned: int

    @staticmethod
    def of(state: DataFrame, clusters: int, width: int) -> Totals:
        parts = state.filter("n IS NOT NULL")
        # Sums of many tasks can pass a long, so they are added as decimals.
        added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("scanned").alias("scanned"), *added).collect()
        rows = {r["cluster"]: r for r in found}
        return Totals(
            [[int(rows[c][f"s{i}"]) for i in range(width)] if c in rows else [0] * width for c in range(clusters)],
            [rows[c]["n"] if c in rows else 0 for c in range(clusters)],
            np.array([rows[c]["radius"] if c in rows else 0.0 for c in range(clusters)]),
            sum(r["scanned"] for r in found),
        )

    def centroids(self, old: np.ndarray) -> np.ndarray:
        """floor(sum / count) in whole numbers; an empty cluster keeps its centroid."""
        return np.array([[s // n for s in sums] if n else list(o) for sums, n, o in zip(self.sums, self.counts, old)], np.int64)


@dataclass(frozen=True)
class Clustering:
    """Final centroids, the table (id, cluster, distance), and how many vectors each round scanned."""

    centroids: np.ndarray
    assigned: DataFrame
    scanned: list[int]


def cluster_spheres(whole: DataFrame, starts: np.ndarray, rounds: int = ROUNDS) -> Clustering:
    """Lloyd's rounds over ``whole`` (id, whole) from ``starts``, exact at every step.

    A round is one pass over the table of the round before, without a shuffle of
    vectors; tasks return a row of sums per cluster, added up by Spark. Each table is
    written to the shared folder, and the one before it is dropped, so two exist at
    most and a lost executor costs no more than its part of one round.
    """
    spark, width = whole.sparkSession, starts.shape[1]
    schema = _state_schema(whole.schema["id"].dataType.simpleString())
    still = np.zeros(len(starts))
    moves, state, scanned, last = Moves(starts, still, still), whole, [], None
    for step in range(rounds + 1):
        path = new_path(spark, "assigned")
        found = keep_at(state.mapInArrow(_round(moves, step == 0, width), schema), path)
        if last:
            drop_path(spark, last)
        last = path
        totals = Totals.of(found, len(starts), width)
        state = found.filter("n IS NULL").select("id", "whole", "cluster", "up", "low")
        scanned.append(totals.scanned)
        if step < rounds:
            moves = Moves.between(moves.centroids, totals.centroids(moves.centroids), totals.radius)
    centroids = moves.centroids
    points = F.array(*[F.array(*[F.lit(int(x)) for x in c]) for c in centroids])
    own = F.zip_with("whole", points[F.col("cluster")], lambda x, c: (x - c).cast("bigint") * (x - c))
    distance = F.aggregate(own, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return Clustering(centroids, state.select("id", "cluster", distance.alias("distance")), scanned)


def cluster_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed_text: str = SEED_TEXT,
) -> DataFrame:
    """Columns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    One row per vector with exactly ``dimensions`` finite components; others are
    left out. Centroids start as the vectors whose ids (after ``seed_text``) have
    the least SHA-256; a NULL id counts as an empty text, equal ids follow by their
    components, and fewer vectors than ``clusters`` give fewer centroids. Ties go to
    the smaller cluster number. Components beyond +-65,536 are held at that value;
    sums of distances beyond a long are NULL. Repeated rows repeat. An empty table
    gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).filter(usable(F.col("v"), dimensions))
    kind = kept.schema["id"].dataType.simpleString()
    table = keep(kept.select("id", whole_components(F.col("v")).alias("whole")), "vectors")
    rank = F.sha2(F.concat(F.lit(seed_text), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    seeds = [r["whole"] for r in table.orderBy(rank, "whole").limit(clusters).collect()]
    if not seeds:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    found = cluster_spheres(table, np.array(seeds, np.int64), rounds)
    sums = {r["cluster"]: int(r["s"]) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]

    def long(number):
        return F.lit(number if number < 2**63 else None).cast("bigint")

    by_cluster = F.array(*[long(sums.get(c, 0)) for c in range(len(seeds))])
    return found.assigned.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        by_cluster[F.col("cluster")].alias("cluster_inertia"),
        long(sum(sums.values())).alias("inertia"),
        F.array(*[F.lit(s) for s in shas])[F.col("cluster")].alias("centroid_sha256"),
    )
