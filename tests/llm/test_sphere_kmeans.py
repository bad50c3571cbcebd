"""Integer k-means against a full comparison of all vectors and centroids."""

import hashlib
import math

import numpy as np
import pytest

from staylens.llm.sphere_kmeans import CLUSTERS, DIMENSIONS, Moves, cluster_spheres, cluster_vectors, loosening
from tests.llm.words import collected

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, whole string, cluster string, distance string, n string"


def table(spark, rows, parts=4):
    data = [(i, v, 0, "z", "z", "z", "z", "z") for i, v in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def brute(rows, rounds=10):
    kept = [(i, [min(max(math.floor(1024 * x), -(2**26)), 2**26) for x in v]) for i, v in rows if usable(v)]
    if not kept:
        return []
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:CLUSTERS]]
    for step in range(rounds + 1):
        squares = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        cluster = [s.index(min(s)) for s in squares]
        if step < rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), k in zip(kept, cluster) if k == c]
                if mine:
                    centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    sums = [sum(min(s) for s, k in zip(squares, cluster) if k == c) for c in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    long = lambda x: x if x < 2**63 else None
    return sorted(((i, c, min(s), long(sums[c]), long(sum(sums)), shas[c]) for (i, _), c, s in zip(kept, cluster, squares)), key=repr)


def usable(v):
    return v is not None and len(v) == DIMENSIONS and all(x is not None and math.isfinite(x) for x in v)


def vectors(seed, count, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, DIMENSIONS))
    return [(i, (centres[i % 12] * 0.5 + rng.normal(size=DIMENSIONS) * spread).tolist()) for i in range(count)]


@pytest.mark.parametrize("seed, count, spread", [(1, 240, 0.3), (2, 200, 1.5), (3, 5, 0.3)])
def test_equals_full_comparison(spark, seed, count, spread):
    rows = vectors(seed, count, spread)
    assert collected(cluster_vectors(table(spark, rows))) == brute(rows)


def test_awkward_vectors(spark):
    flat = [0.25] * DIMENSIONS
    rows = [(i, flat) for i in range(20)] + [(3, flat), (None, flat), (None, [x * 2 for x in flat])]
    rows += [(50, None), (51, []), (52, flat[:-1]), (53, flat + [0.0]), (54, [None] + flat[1:]), (55, [math.nan] + flat[1:])]
    rows += [(56, [math.inf] + flat[1:]), (57, [-math.inf] + flat[1:]), (58, [1e300] + flat[1:]), (59, [-1e30] * DIMENSIONS)]
    rows += [(60 + i, [0.0] * i + [1.0] * (DIMENSIONS - i)) for i in range(DIMENSIONS)]
    assert collected(cluster_vectors(table(spark, rows))) == brute(rows)


def test_empty_tables(spark):
    assert cluster_vectors(table(spark, [])).collect() == []
    assert cluster_vectors(table(spark, [(1, None)])).collect() == []


def test_many_copies_of_one_vector(spark):
    rows = [(i, [0.5] * DIMENSIONS) for i in range(400)] + vectors(5, 200)[100:]
    assert collected(cluster_vectors(table(spark, rows, 9))) == brute(rows)


def test_loosening_holds_and_is_less_than_full_drift():
    rng = np.random.default_rng(7)
    saved = 0
    for _ in range(60):
        old = rng.normal(size=(5, 3)) * rng.choice([1, 10])
        new = old + rng.normal(size=(5, 3)) * rng.choice([0.0, 0.1, 3.0])
        radius = np.abs(rng.normal(size=5)) * rng.choice([0.1, 2.0])
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))
        loss = loosening(old, new, radius)
        for i in range(5):
            x = rng.normal(size=(4000, 3))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * rng.uniform(size=(4000, 1)) ** 0.3
            others = [j for j in range(5) if j != i]
            change = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in others)
            assert change <= loss[i] + 1e-9
            assert loss[i] <= drift[others].max() + 1e-9
            saved += loss[i] < 0.9 * drift[others].max()
    assert saved > 50


def test_far_vectors_are_not_scanned(spark):
    rng = np.random.default_rng(3)
    centres = np.kron(np.eye(8), np.ones(8)) * 4000
    data = [(int(i), (centres[i % 8] + rng.integers(-50, 50, 64)).astype(int).tolist()) for i in range(4000)]
    whole = spark.createDataFrame(data, "id bigint, whole array<int>")
    found = cluster_spheres(whole, (centres + 30).astype(np.int64), 4)
    assert found.scanned[0] == 4000 and found.scanned[1:] == [0, 0, 0, 0]


def test_bounds_give_the_same_clusters_without_a_scan():
    rng = np.random.default_rng(11)
    v = rng.integers(-500, 500, (3000, 8))
    old = v[:6].astype(np.int64)
    squares = ((v[:, None] - old[None]) ** 2).sum(axis=2)
    cluster = squares.argmin(axis=1)
    ordered = np.sort(np.sqrt(squares), axis=1)
    radius = np.array([ordered[cluster == c, 0].max() for c in range(6)])
    new = np.array([v[cluster == c].mean(axis=0).astype(np.int64) for c in range(6)])
    got, up, low, seen = Moves.between(old, new, radius).assign(v, cluster, ordered[:, 0], ordered[:, 1])
    after = np.sqrt(((v[:, None] - new[None]) ** 2).sum(axis=2))
    assert (got == after.argmin(axis=1)).all() and seen < len(v)
    assert (up + 1e-6 >= after.min(axis=1)).all() and (low - 1e-6 <= np.sort(after, axis=1)[:, 1]).all()
