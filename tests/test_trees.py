"""Trees grown on Spark against plain numpy versions that see all rows at once."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from staylens.plans import models as md
from staylens.plans import splits as sp
from staylens.plans import trees as tr
from staylens.plans.splits import Growth, Layout, Split, count_cells, histogram, split_of_cells, split_of_histogram, split_of_rows

SCHEMA = "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, LOS double, f int, prepared array<double>"


def table(spark, n=500, seed=3, missing=False):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n), rng.exponential(size=n), np.full(n, 4.0), rng.integers(0, 2, n)]).astype(float)
    y = np.sin(x[:, 0] * 2) * 3 + x[:, 1] * (x[:, 2] > 1) + rng.normal(size=n) * 0.3 + 5
    if missing:
        x[rng.random(n) < 0.2, 0] = math.nan
    rows = [(i % 60, i, i, float(y[i]), i % 4, x[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df.withColumn("features", array_to_vector("prepared")), x, y


def plain_bins(x, edges):
    out = np.empty(x.shape, int)
    for f, e in enumerate(edges):
        out[:, f] = [255 if math.isnan(v) else sum(v > t for t in e) for v in x[:, f]]
    return out


def plain_split(bins, g, w, growth):
    """Every feature, bin and side for missing values, one after the other."""
    best, total, n = None, g.sum(), w.sum()
    if n < 2 * growth.min_leaf:
        return None
    for f in range(bins.shape[1]):
        for missing_left in (False, True) if (bins[:, f] == 255).any() else (False,):
            for b in range(255):
                left = np.where(bins[:, f] == 255, missing_left, bins[:, f] <= b)
                nl, gl = w[left].sum(), g[left].sum()
                if nl < growth.min_leaf or n - nl < growth.min_leaf or not nl or nl == n:
                    continue
                halves = gl * gl / (nl + growth.l2) + (total - gl) ** 2 / (n - nl + growth.l2)
                gain = halves - total * total / (n + growth.l2)
                if gain > 1e-12 * halves and (best is None or gain > best[0]):
                    best = (gain, f, b, missing_left, left)
    return best


def plain_tree(bins, g, w, growth, value):
    """Leaf-wise growth over all rows; returns the value of every row."""
    leaves = [(np.arange(len(bins)), 0, plain_split(bins, g, w, growth))]
    while growth.max_leaves is None or len(leaves) < growth.max_leaves:
        able = [i for i, (_, d, s) in enumerate(leaves) if s and (growth.max_depth is None or d < growth.max_depth)]
        if not able:
            break
        at = max(able, key=lambda i: leaves[i][2][0])
        rows, d, s = leaves.pop(at)
        for part in (rows[s[4]], rows[~s[4]]):
            leaves.append((part, d + 1, plain_split(bins[part], g[part], w[part], growth)))
    out = np.empty(len(bins))
    for rows, _, _ in leaves:
        out[rows] = value(g[rows].sum(), w[rows].sum())
    return out


@pytest.mark.parametrize("missing", [False, True])
@pytest.mark.parametrize("local_rows", [0, 60, 10**6])
def test_boosting_equals_numpy(spark, missing, local_rows):
    df, x, y = table(spark, missing=missing)
    rows = tr.bin_rows(df)
    s = tr.Boost(rate=0.3, rounds=4, max_leaves=7, min_leaf=9, l2=1.5)
    got = tr.boosted_model(rows, tr.boost(rows, [s], local_rows, state_rounds=2)[0]).transform(df)
    got = np.array([r["prediction"] for r in got.orderBy("ICUSTAY_ID").collect()])
    bins, score = plain_bins(x, rows.edges), np.full(len(y), rows.mean(None))
    for _ in range(s.rounds):
        g = np.rint((y - score) * rows.scale)
        score = score + plain_tree(bins, g, np.ones(len(y)), s.growth(), lambda t, n: s.rate * t / rows.scale / (n + s.l2))
    np.testing.assert_allclose(got, score, rtol=1e-12)


@pytest.mark.parametrize("local_rows", [0, 100, 10**6])
def test_forest_equals_numpy(spark, local_rows):
    df, x, y = table(spark, 200)
    rows = tr.bin_rows(df)
    s = tr.Forest(trees=3, max_depth=4, min_leaf=2)
    got = tr.forest_model(rows, tr.plant(rows, s, local_rows)).transform(df)
    got = np.array([r["prediction"] for r in got.orderBy("ICUSTAY_ID").collect()])
    bins, total = plain_bins(x, rows.edges), np.zeros(len(y))
    for t in range(s.trees):
        w = tr.bootstrap_weights(np.arange(len(y)), t, s.seed)
        g, in_bag = np.rint((y - rows.middle) * rows.scale) * w, w > 0
        growth = Growth(None, s.max_depth, s.min_leaf)
        # Values come from the bag, but rows outside it follow the same splits.
        total += follow(bins, g, w, in_bag, growth, lambda a, n: rows.middle + a / n / rows.scale)
    np.testing.assert_allclose(got, total / s.trees, rtol=1e-12)


def follow(bins, g, w, in_bag, growth, value):
    out = np.empty(len(bins))

    def visit(rows, depth):
        bag = rows[in_bag[rows]]
        split = plain_split(bins[bag], g[bag], w[bag], growth) if depth < growth.max_depth else None
        if not split:
            out[rows] = value(g[bag].sum(), w[bag].sum())
            return
        left = bins[rows, split[1]] <= split[2]
        visit(rows[left], depth + 1)
        visit(rows[~left], depth + 1)

    visit(np.arange(len(bins)), 0)
    return out


def nodes(model):
    return sorted(tuple(r) for r in model.nodes.collect())


def test_same_trees_from_any_partitions_and_pass(spark):
    df, _, _ = table(spark, 900)
    seen = set()
    for parts, local_rows in ((1, 200), (8, 50), (64, 10**6), (3, 0)):
        rows = tr.bin_rows(df.repartition(parts))
        boosted = tr.boosted_model(rows, tr.boost(rows, [tr.Boost(rounds=3, max_leaves=6)], local_rows)[0])
        forest = tr.forest_model(rows, tr.plant(rows, tr.Forest(trees=4, min_leaf=3, subset="0.5"), local_rows))
        seen.add((tuple(nodes(boosted)), tuple(nodes(forest))))
    assert len(seen) == 1


def test_folds_and_trials_share_jobs_and_stay_apart(spark):
    df, _, y = table(spark, 400)
    rows = tr.bin_rows(df, "f")
    settings = [tr.Boost(rounds=r, max_leaves=5, min_leaf=5, held=h) for r in (2, 5) for h in (0, 3)]
    together = tr.boost(rows, settings, 100, state_rounds=2)
    for s, fit in zip(settings, together):
        alone = tr.boost(rows, [s])[0]
        assert len(fit.trees) == s.rounds and fit.held_mae == alone.held_mae
        mine = df.filter(F.col("f") == s.held)
        scored = tr.boosted_model(rows, fit).transform(mine)
        mae = scored.agg(F.avg(F.abs(F.col("LOS") - F.col("prediction")))).first()[0]
        assert fit.held_mae == pytest.approx(mae, rel=1e-6)
    forest = tr.Forest(trees=3, max_depth=3, held=1)
    model = tr.forest_model(rows, tr.plant(rows, forest))
    mae = model.transform(df.filter("f = 1")).agg(F.avg(F.abs(F.col("LOS") - F.col("prediction")))).first()[0]
    assert tr.held_mae(rows, model, 1) == pytest.approx(mae, rel=1e-6)


def test_held_rows_do_not_move_the_model(spark):
    df, _, _ = table(spark, 300)
    other = df.withColumn("LOS", F.when(F.col("f") == 2, F.lit(5.0)).otherwise(F.col("LOS")))
    found = []
    for d in (df, other):
        rows = tr.bin_rows(d, "f")
        rows = type(rows)(rows.blocks, rows.edges, rows.rows, 5.0, 2.0**30, rows.folds)
        found.append([t.path.tolist() for t in tr.boost(rows, [tr.Boost(rounds=1, max_leaves=6, held=2)])[0].trees])
    assert found[0] == found[1]


def test_l2_shrinks_leaves_and_leaves_are_counted(spark):
    df, _, _ = table(spark)
    rows = tr.bin_rows(df)
    plain, shrunk = tr.boost(rows, [tr.Boost(rounds=1, max_leaves=8, rate=1.0), tr.Boost(rounds=1, max_leaves=8, rate=1.0, l2=500.0)])
    size = lambda fit: np.abs(fit.trees[0].value[fit.trees[0].feature < 0])
    assert len(size(plain)) == 8 and size(shrunk).max() < size(plain).max() / 1.5


def test_early_stopping(spark):
    df, _, _ = table(spark, 400)
    rows = tr.bin_rows(df, "f")
    fit = tr.boost(rows, [tr.Boost(rate=1.0, rounds=60, max_leaves=31, min_leaf=1, held=0, patience=2)])[0]
    assert len(fit.trees) < 60


def test_bootstrap_weights():
    w = tr.bootstrap_weights(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - math.exp(-1)) < 0.01
    other = tr.bootstrap_weights(np.arange(200_000), 4, 42)
    assert abs(np.corrcoef(w, other)[0, 1]) < 0.01


def test_rows_and_histograms_give_one_split():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(2, 100))
        bins = rng.integers(0, rng.choice([2, 5, 250]), (n, 6)).astype(np.uint8)
        g, w = rng.integers(-1000, 1000, n).astype(float), rng.integers(1, 4, n).astype(float)
        growth = Growth(min_leaf=int(rng.integers(1, 4)), l2=float(rng.choice([0.0, 2.0])))
        a = split_of_rows(bins, g, w, g.sum(), w.sum(), growth, chosen := rng.choice([None, 1]) and np.array([0, 2, 5]))
        b = split_of_histogram(histogram(bins, g, w), g.sum(), w.sum(), growth, chosen)
        assert a == b or (isinstance(a, Split) and a[:4] == b[:4])


def test_constant_target_and_tiny_tables(spark):
    df, _, _ = table(spark, 30)
    same = df.withColumn("LOS", F.lit(2.5))
    for model in (md.fit_boosted(same, rounds=3), md.fit_forest(same, trees=3)):
        assert {r["prediction"] for r in model.transform(same).collect()} == {2.5}
    one = df.limit(1)
    assert md.fit_forest(one, trees=2).transform(one).count() == 1
    with pytest.raises(ValueError, match="no target"):
        md.fit_boosted(df.withColumn("LOS", F.lit(None).cast("double")))


def test_large_models_predict_in_parts(spark, monkeypatch):
    df, _, _ = table(spark, 200)
    model = md.fit_forest(df, trees=6)
    want = [r["prediction"] for r in model.transform(df).orderBy("ICUSTAY_ID").collect()]
    monkeypatch.setattr(tr, "PART_NODES", 1)
    assert len(list(model.parts())) == 6
    got = [r["prediction"] for r in model.transform(df).orderBy("ICUSTAY_ID").collect()]
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_many_rows_take_few_passes_and_several_small_fits_one_job(spark, monkeypatch):
    df, _, _ = table(spark, 9_000)
    rows = tr.bin_rows(df, "f")
    passes, plain = [], tr._pass
    monkeypatch.setattr(tr, "_pass", lambda *a: passes.append(1) or plain(*a))
    tr.plant(rows, tr.Forest(trees=2, max_depth=6))
    assert len(passes) == 1
    passes.clear()
    settings = [tr.Boost(rounds=r, max_leaves=5, held=h) for r in (3, 6) for h in (0, 2, None)]
    together = tr.boost(rows, settings)
    # All rounds of all fits are one job; the other pass gives the errors of the held folds.
    assert len(passes) == 1
    for got, want in zip(together, [tr.boost(rows, [s], 100)[0] for s in settings]):
        assert got.held_mae == want.held_mae and len(got.trees) == len(want.trees)
        for a, b in zip(got.trees, want.trees):
            assert a.path.tolist() == b.path.tolist() and a.value.tolist() == b.value.tolist()


def test_histograms_hold_only_the_bins_that_occur():
    rng = np.random.default_rng(7)
    sizes = [3, 40, 2, 250]
    bins = np.column_stack([rng.integers(0, k + 1, 3000) for k in sizes]).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = 255
    g, w = rng.integers(-1000, 1000, 3000).astype(float), rng.integers(1, 4, 3000).astype(float)
    layout, slots = Layout.of([np.empty(k) for k in sizes]), rng.integers(0, 3, 3000)
    cells = count_cells(bins, g, w, layout, slots, 3)
    assert cells.shape == (2, 3, sum(sizes) + 2 * len(sizes))
    growth = Growth(min_leaf=5)
    for k in range(3):
        at = slots == k
        total, n = g[at].sum(), w[at].sum()
        want = split_of_histogram(histogram(bins[at], g[at], w[at]), total, n, growth)
        assert split_of_cells(cells[:, k], layout, total, n, growth) == want
        assert split_of_rows(bins[at], g[at], w[at], total, n, growth, None, layout) == want


@pytest.mark.parametrize("missing", [0.0, 0.02])
@pytest.mark.parametrize("subset", ["all", "sqrt"])
def test_small_nodes_are_split_together(monkeypatch, subset, missing):
    rng = np.random.default_rng(11)
    bins = np.column_stack([rng.integers(0, 200, 3_000), rng.integers(0, 2, 3_000), rng.integers(0, 30, 3_000), np.full(3_000, 7), rng.integers(0, 2, (3_000, 3))]).astype(np.uint8)
    bins[rng.random(bins.shape) < missing] = sp.MISSING
    weights = rng.integers(1, 4, 3_000).astype(float)
    sums = rng.integers(-9, 9, 3_000) * 2.0**38 * weights
    calls, alone = [], sp.split_of_rows
    monkeypatch.setattr(sp, "split_of_rows", lambda *a: calls.append(1) or alone(*a))
    for growth in (Growth(subset=subset), Growth(max_depth=7, min_leaf=5, subset=subset)):
        found = []
        for batch_rows, cells in ((0, 1), (256, 1 << 20), (3_000, 200)):
            calls.clear()
            monkeypatch.setattr(sp, "BATCH_ROWS", batch_rows, raising=False)
            monkeypatch.setattr(sp, "BATCH_CELLS", cells, raising=False)
            found.append(sorted(sp.grow(bins, sums, weights, growth, 2)))
            if batch_rows and not missing:
                assert len(calls) < 50 < len(found[-1])
        assert found[0] == found[1] == found[2]


def test_one_small_fit_takes_one_job_too(spark, monkeypatch):
    df, _, _ = table(spark, 200)
    rows = tr.bin_rows(df)
    want = tr.boost(rows, [tr.Boost(rounds=6, max_leaves=5)], local_rows=100)[0]
    monkeypatch.setattr(tr, "_advance", None)
    got = tr.boost(rows, [tr.Boost(rounds=6, max_leaves=5)])[0]
    assert [t.value.tolist() for t in got.trees] == [t.value.tolist() for t in want.trees]


def test_errors_of_a_fold_score_its_rows_only(spark):
    df, _, _ = table(spark, 400)
    rows = tr.bin_rows(df, "f")
    fit = tr.boost(rows, [tr.Boost(rounds=3, max_leaves=5, held=2)])[0]
    seen = []

    class Counted:
        def predict(self, bins):
            seen.append(len(bins))
            return fit.trees[0].predict(bins)

    learner = tr.Learner(Growth(), 2, base=fit.base, recent=[Counted()], watch=True)
    batches = rows.blocks.toArrow().to_batches()
    (message,) = tr._emit(rows, {0: learner}, 10)(iter(batches))
    count, *_ = np.frombuffer(message.column("sums")[0].as_py())
    assert sum(seen) == count == 100


def test_features_with_few_bins_are_counted_together():
    rng = np.random.default_rng(8)
    layout = Layout(np.array([3, 100, 4, 256, 5, 2, 4]))
    assert len(layout.bundles.groups) < len(layout.sizes)
    bins = np.column_stack([rng.integers(0, size - 1, 9_000) for size in layout.sizes]).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = sp.MISSING
    sums, weights, slots = rng.integers(-9, 9, 9_000).astype(float), rng.integers(1, 3, 9_000).astype(float), rng.integers(0, 3, 9_000)
    for w in (weights, np.ones(9_000)):
        got, apart = count_cells(bins, sums, w, layout), count_cells(bins, sums, w, layout, slots, 3)
        for f, (start, size) in enumerate(zip(layout.starts, layout.sizes)):
            for b in range(size):
                mine = bins[:, f] == (sp.MISSING if b == size - 1 else b)
                assert got[:, 0, start + b].tolist() == [sums[mine].sum(), w[mine].sum()]
                for k in range(3):
                    assert apart[:, k, start + b].tolist() == [sums[mine & (slots == k)].sum(), w[mine & (slots == k)].sum()]


def test_passes_of_boosting_read_cached_blocks(spark, monkeypatch):
    df, _, _ = table(spark)
    rows, setting, seen = tr.bin_rows(df), "spark.sql.execution.arrow.maxRecordsPerBatch", []
    want = tr.boost(rows, [tr.Boost(rounds=5, max_leaves=6)])[0]
    advance, before = tr._advance, spark.conf.get(setting)
    monkeypatch.setattr(tr, "_advance", lambda r, *rest: (seen.append((r.blocks.storageLevel.useMemory, spark.conf.get(setting))), advance(r, *rest)))
    # 60 rows of five features.
    monkeypatch.setattr(tr, "LOCAL_BYTES", 60 * 21)
    got = tr.boost(rows, [tr.Boost(rounds=5, max_leaves=6)], state_rounds=2)[0]
    assert len(seen) > 5 and set(seen) == {(True, str(tr.BATCH_BLOCKS))}
    assert not rows.blocks.storageLevel.useMemory and spark.conf.get(setting) == before
    assert [t.path.tolist() for t in got.trees] == [t.path.tolist() for t in want.trees]
    assert all(np.array_equal(a.value, b.value) for a, b in zip(got.trees, want.trees))


def test_large_models_are_not_brought_to_the_driver(spark, monkeypatch):
    df, _, _ = table(spark, 200)
    twice = df.unionByName(df.filter("ICUSTAY_ID < 20"))
    model = md.fit_forest(df, trees=5)
    want = sorted(tuple(r) for r in model.transform(twice).select("ICUSTAY_ID", F.round("prediction", 9)).collect())
    monkeypatch.setattr(tr, "PART_NODES", 10)
    # Rows are handed out 30 at a time, nodes never.
    monkeypatch.setattr(tr, "LOCAL_BYTES", 30 * (5 + 16))
    monkeypatch.setattr(tr.TreeModel, "_trees", None)
    got = model.transform(twice)
    assert got.columns == [*twice.columns, "prediction"]
    assert sorted(tuple(r) for r in got.select("ICUSTAY_ID", F.round("prediction", 9)).collect()) == want
    assert model.transform(df.limit(0)).count() == 0


def test_small_forests_grow_from_rows_that_tasks_share(spark, monkeypatch):
    df, _, _ = table(spark, 300)
    rows = tr.bin_rows(df, "f")
    forests = [tr.Forest(trees=3, held=1, min_leaf=2), tr.Forest(trees=2, held=None, subset="0.5")]
    want = [sorted(map(tuple, tr.plant(rows, x, 100).collect())) for x in forests]
    # No row is sent to the task of a node.
    monkeypatch.setattr(tr, "_emit", None)
    got = [sorted(map(tuple, nodes.collect())) for nodes in tr.plant_all(rows, forests)]
    assert got == want and len(got[0]) > 10 and len({r[0] for r in got[0]}) == 3


def test_features_with_two_values_are_not_sorted(monkeypatch):
    rng = np.random.default_rng(12)
    bins = np.column_stack([rng.integers(0, 2, (2_000, 6)), rng.integers(0, 9, 2_000)]).astype(np.uint8)
    bins[:, 4] = bins[:, 1]
    weights = rng.integers(1, 4, 2_000).astype(float)
    sums = rng.integers(-9, 9, 2_000) * 2.0**38 * weights
    layout = Layout(np.array([3] * 6 + [10]))
    for growth in (Growth(), Growth(subset="0.5"), Growth(max_depth=9, min_leaf=4)):
        # Bins of all sizes: nothing is known to have two values.
        want = sorted(sp.grow(bins, sums, weights, growth, 1, 1, Layout.full(7)))
        assert sorted(sp.grow(bins, sums, weights, growth, 1, 1, layout)) == want
    seen, plain = [], sp._two_valued
    monkeypatch.setattr(sp, "_two_valued", lambda out, two, *rest: seen.append(len(two)) or plain(out, two, *rest))
    sp.grow(bins, sums, weights, Growth(), 1, 1, layout)
    assert set(seen) == {6}
    assert tr.distinct_features(bins).tolist() == [0, 1, 2, 3, 5, 6]


def test_errors_of_forests_are_found_in_one_job(spark, monkeypatch):
    df, _, _ = table(spark, 300, missing=True)
    rows = tr.bin_rows(df, "f")
    forests = [tr.Forest(trees=t, held=h, max_depth=6, subset=x) for t, h, x in ((20, 1, "all"), (3, 2, "0.5"), (2, 9, "sqrt"))]
    want = [tr.held_mae(rows, tr.forest_model(rows, tr.plant(rows, x, 100)), x.held) for x in forests]
    monkeypatch.setattr(tr, "keep", None)
    got = tr.forest_errors(rows, forests)
    assert got[:2] == pytest.approx(want[:2], rel=1e-9)
    # No row is in this fold.
    assert math.isnan(got[2]) and math.isnan(want[2])


def test_cells_of_many_chosen_features_are_kept(monkeypatch):
    rng = np.random.default_rng(13)
    bins = rng.integers(0, 40, (6_000, 10)).astype(np.uint8)
    sums, counted, plain = rng.integers(-9, 9, 6_000) * 2.0**38, [], sp.count_cells
    monkeypatch.setattr(sp, "count_cells", lambda b, *rest: counted.append(b.size) or plain(b, *rest))
    found, cells = [], []
    for kept in (200, 10**9):
        monkeypatch.setattr(sp, "KEPT_ROWS", kept)
        counted.clear()
        found.append(sorted(sp.grow(bins, sums, np.ones(6_000), Growth(max_depth=4, subset="0.8"), 1, 1, Layout(np.full(10, 41)))))
        cells.append(sum(counted))
    # The larger of two children is not counted.
    assert found[0] == found[1] and cells[0] < 0.9 * cells[1]
