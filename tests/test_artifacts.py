"""Saved models and published results."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from staylens.plans import artifacts as art
from staylens.plans import evaluate as em
from staylens.plans import models as md
from staylens.plans.linear import LinearModel
from staylens.operators.quantiles import column_medians
from staylens.sources import export_csv, read_export


def vectors(spark, n=120):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3))
    x[:, 2] = 5.0
    y = np.exp(x[:, 0]) + x[:, 1] ** 2
    rows = [(i % 20, i, i, float(y[i]), x[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, LOS double, prepared array<double>")
    return df.withColumn("features", array_to_vector("prepared")), x, y


def predictions(model, df):
    return [r["prediction"] for r in model.transform(df).orderBy("ICUSTAY_ID").collect()]


def test_models_survive_a_round_trip(spark, tmp_path):
    df, _, _ = vectors(spark)
    names = ("one", "two", "three")
    models = [md.fit_mean(df), md.fit_ridge(df), md.fit_ridge(df, solver="l-bfgs"), md.fit_boosted(df, rounds=4), md.fit_forest(df, trees=4), md.on_log_target(md.ModelSpec("x", md.fit_ridge)).fit(df)]
    folder = str(tmp_path / "models")
    for n, model in enumerate(models, 1):
        assert art.save_model(model, folder, names) == n
        assert predictions(art.load_model(folder, names), df) == predictions(model, df)
    assert predictions(art.load_model(folder, version=1), df) == predictions(models[0], df)
    with pytest.raises(ValueError, match="four"):
        art.load_model(folder, ("one", "two", "four"))
    with pytest.raises(ValueError, match="order"):
        art.load_model(folder, ("two", "one", "three"))
    with pytest.raises(FileNotFoundError):
        art.load_model(folder, version=9)
    with pytest.raises(TypeError):
        art.save_model(object(), folder, names)


def test_a_version_without_manifest_is_not_seen(spark, tmp_path):
    folder = str(tmp_path / "results")
    table = spark.createDataFrame([("a", None, 1.5), ("", "x, \"y\"\nz", None)], "k string, t string, v double")
    assert art.publish(folder, {"t": table}, {"best": "a"}) == 1
    # A write that ended before its manifest.
    export_csv(table, f"{folder}/v2-abcdef00/t")
    tables, summary = art.read_published(folder)
    assert sorted(map(tuple, tables["t"].collect()), key=repr) == sorted(map(tuple, table.collect()), key=repr)
    assert summary == {"best": "a"}
    assert art.publish(folder, {"t": table.limit(0)}) == 2
    assert art.read_published(folder)[0]["t"].count() == 0 and art.read_published(folder, 1)[0]["t"].count() == 2
    export_csv(table.limit(1), [str(p) for p in (tmp_path / "results").glob("v1-*/t")][0])
    with pytest.raises(ValueError, match="2 rows"):
        art.read_published(folder, 1)


def test_export_keeps_null_and_empty_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, None, " a "), (2, "", "\"q\", 'r'"), (3, "x", "line\nfeed"), (4, None, "")], "i int, s string, t string")
    export_csv(df, str(tmp_path / "csv"))
    back = read_export(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_log_target_metrics_are_in_days(spark):
    df, _, y = vectors(spark)
    spec = md.on_log_target(md.ModelSpec("LogMean", md.fit_mean))
    got = predictions(spec.fit(df), df)
    assert got == pytest.approx([math.exp(np.log1p(y).mean()) - 1] * len(y))
    row = em.cv_benchmark(df, [spec], folds=2).first()
    assert row["cv_mae_mean"] < y.std() * 2
    folds = md.on_log_target(md.baseline_models({"trees": 3}, {"rounds": 3})[3]).fit_folds(df.withColumn("fold", F.col("SUBJECT_ID") % 2), "fold", [0, 1])
    assert len(folds) == 2 and all(v > -1 for v in predictions(folds[0], df))


def test_closed_form_ignores_constant_columns(spark):
    df, x, y = vectors(spark)
    model = md.fit_ridge(df, 2.0)
    z = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0)
    beta = np.linalg.solve(z.T @ z + 2 * np.eye(2), z.T @ (y - y.mean()))
    np.testing.assert_allclose(model.weights, [*(beta / x[:, :2].std(0)), 0], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(predictions(model, df), z @ beta + y.mean(), rtol=1e-9)


def test_importance_of_trees_equals_plain_permutation(spark):
    df, x, y = vectors(spark)
    model = md.fit_boosted(df, rounds=6, min_leaf=5)
    got = {r["feature"]: r for r in em.permutation_importance(model, df, ("one", "two", "three"), repeats=3).collect()}
    order = [r["ICUSTAY_ID"] for r in em.ranked_rows(df).orderBy("_rank").collect()]
    assert sorted(order) == list(range(len(y)))
    place = {s: k for k, s in enumerate(order)}
    base = ((y - np.array(predictions(model, df))) ** 2).sum()
    for f, name in enumerate(("one", "two", "three")):
        drops = []
        for step in em.donor_steps(len(y), 3):
            changed = x.copy()
            changed[:, f] = [x[order[(place[i] + step) % len(y)], f] for i in range(len(y))]
            rows = [(i, i, i, float(y[i]), changed[i].tolist()) for i in range(len(y))]
            other = spark.createDataFrame(rows, "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, LOS double, prepared array<double>")
            other = other.withColumn("features", array_to_vector("prepared"))
            drops.append((((y - np.array(predictions(model, other))) ** 2).sum() - base) / (y.var() * len(y)))
        assert got[name]["importance_mean"] == pytest.approx(np.mean(drops), abs=1e-9)
        assert got[name]["importance_std"] == pytest.approx(np.std(drops), abs=1e-9)
    assert got["three"]["importance_mean"] == 0.0


def test_importance_is_refused_for_unknown_models(spark):
    df, _, _ = vectors(spark, 20)
    with pytest.raises(TypeError):
        em.permutation_importance(md.fit_mean(df), df, ("a", "b", "c"))
    none = em.permutation_importance(LinearModel((0.0, 0.0, 0.0), 1.0), df, ("a", "b", "c")).collect()
    assert [tuple(r)[1:] for r in none] == [(0.0, 0.0)] * 3


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_column_medians(spark, accuracy):
    rng = np.random.default_rng(2)
    n = 3000
    columns = {
        "normal": rng.normal(size=n),
        "mostly zero": np.where(rng.random(n) < 0.8, 0.0, rng.normal(size=n)),
        "two": np.where(np.arange(n) % 2, 1.0, 2.0),
        "sparse`": np.where(rng.random(n) < 0.99, np.nan, rng.normal(size=n)),
        "none": np.full(n, np.nan),
    }
    rows = [tuple(None if np.isnan(v[i]) and i % 2 else float(v[i]) for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c.replace('`', '``')}` double" for c in columns)).repartition(7)
    got = column_medians(df, list(columns), accuracy)
    for name, v in columns.items():
        have = v[~np.isnan(v)]
        assert got[name]["n"] == len(have) and got[name]["rows"] == n
        if len(have):
            assert got[name]["median"] == np.median(have) and got[name]["mean"] == pytest.approx(have.mean())
        else:
            assert got[name]["median"] is None
    assert column_medians(df.limit(0), ["two"])["two"]["median"] is None
