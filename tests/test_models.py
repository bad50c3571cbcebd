import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from staylens.operators import split as sp
from staylens.operators.quantiles import exact_quantiles
from staylens.operators import quality as ql
from staylens.plans import evaluate as em
from staylens.plans import models as md
from staylens.plans import prepare as pp
from staylens.plans import trees as tr
from staylens.plans.linear import LinearModel
from staylens.schemas import FEATURES, STAY, TARGET
from staylens.settings import JoinLimits, Settings

IDS = "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, LOS double"


@pytest.mark.parametrize("small", [10**6, 0])
@pytest.mark.parametrize("accuracy", [50, 1000])
def test_exact_quantiles(spark, small, accuracy):
    rng = np.random.default_rng(7)
    groups = {0: rng.normal(size=997), 1: np.repeat([1.0, 2.0, 3.0], [10, 700, 11]), 2: np.array([4.0]), 3: np.exp(rng.normal(size=500) * 5)}
    long = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs] + [(0, None)], "k int, v double")
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(long, ["k"], "v", qs, 10**6 if small == 0 else 1000, small_group=small, accuracy=accuracy).collect()
    assert len(got) == len(groups) * len(qs)
    for r in got:
        assert r["value"] == pytest.approx(np.quantile(groups[r["k"]], r["q"]), rel=1e-12)


def sample(spark, n=300):
    df = spark.range(n).select(
        (F.col("id") % 90).alias("SUBJECT_ID"),
        F.col("id").alias("HADM_ID"),
        F.col("id").alias("ICUSTAY_ID"),
        (3 + F.sin("id") * 2 + F.col("id") % 5).alias("LOS"),
        F.when(F.col("id") % 4 != 0, F.sin("id")).alias("a"),
        (F.col("id") % 5).alias("b"),
        F.lit(7.0).alias("same"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 6 != 0, F.element_at(F.array(F.lit("x"), F.lit("y y"), F.lit("it's")), (F.col("id") % 3 + 1).cast("int"))).alias("c"),
    )
    return df


def test_split_keeps_patients_together(spark):
    train, test = sp.group_split(sample(spark), 0.2, 42)
    report = {r["metric"]: r["value"] for r in sp.leakage_check(train, test).collect()}
    assert report["subject_overlap"] == 0 and report["train_subjects"] + report["test_subjects"] == 90
    assert 5 <= report["test_subjects"] <= 35
    other = sp.group_split(sample(spark), 0.2, 43)[1]
    assert {r[0] for r in other.select("SUBJECT_ID").distinct().collect()} != {r[0] for r in test.select("SUBJECT_ID").distinct().collect()}


def test_folds_are_disjoint(spark):
    rows = sp.fold_preview(sample(spark)).collect()
    assert len(rows) == 5 and sum(r["valid_rows"] for r in rows) == 300
    assert all(r["subject_overlap"] == 0 and r["train_rows"] + r["valid_rows"] == 300 for r in rows)


def test_exact_split_takes_the_share_of_patients(spark):
    df = sample(spark)
    for size, wanted in ((0.2, 18), (0.25, 23), (0.0, 0), (1.0, 90)):
        train, test = sp.exact_group_split(df, size)
        ids = [{r[0] for r in side.select("SUBJECT_ID").distinct().collect()} for side in (train, test)]
        assert len(ids[1]) == wanted and not ids[0] & ids[1] and train.count() + test.count() == 300
    nulls = df.withColumn("SUBJECT_ID", F.when(F.col("SUBJECT_ID") > 4, F.col("SUBJECT_ID")))
    train, test = sp.exact_group_split(nulls, 0.5)
    assert train.count() + test.count() == 300 and test.select("SUBJECT_ID").distinct().count() == 43
    assert not {r[0] for r in train.select("SUBJECT_ID").collect()} & {r[0] for r in test.select("SUBJECT_ID").collect()}
    assert [side.count() for side in sp.exact_group_split(df.filter("false"))] == [0, 0]


def one_by_one(classes, folds):
    loads, shares = [0] * folds, {size: [0] * folds for size in classes}
    for size in sorted(classes, reverse=True):
        for _ in range(classes[size]):
            lightest = loads.index(min(loads))
            loads[lightest] += size
            shares[size][lightest] += 1
    return shares


def test_classes_are_dealt_as_one_by_one():
    rng = np.random.default_rng(5)
    for _ in range(300):
        classes = {int(s): int(n) for s, n in zip(rng.integers(1, 60, 4), rng.integers(1, 40, 4))}
        folds = int(rng.integers(1, 7))
        assert sp.deal_classes(classes, folds) == one_by_one(classes, folds)
    assert [sum(s) for s in sp.deal_classes({10**9: 1, 1: 10**9}, 3).values()] == [1, 10**9]
    assert sp.deal_classes({}, 5) == {}


def test_balanced_folds(spark):
    hot = sample(spark).withColumn("SUBJECT_ID", F.when(F.col("ICUSTAY_ID") < 57, F.lit(1000)).when(F.col("ICUSTAY_ID") < 70, F.lit(None)).otherwise(F.col("ICUSTAY_ID") % 90))
    for df in (sample(spark), hot, hot.filter("ICUSTAY_ID < 60")):
        folded = sp.with_balanced_folds(df)
        classes = dict(Counter(r["count"] for r in df.groupBy("SUBJECT_ID").count().collect()))
        sizes = sorted(sum(size * n for size, n in zip(classes, fold)) for fold in zip(*(one_by_one(classes, 5)[c] for c in classes)))
        assert folded.columns == [*df.columns, "fold"] and folded.count() == df.count()
        rows = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
        assert sorted(rows.get(f, 0) for f in range(5)) == sizes
        assert folded.groupBy("SUBJECT_ID").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    salted = sp.with_balanced_folds(hot, limits=JoinLimits(broadcast_rows=0, hot_share=0.1))
    assert salted.exceptAll(sp.with_balanced_folds(hot)).count() == 0 and salted.count() == 300
    assert sp.with_balanced_folds(hot.filter("false")).count() == 0
    assert all(r["valid_rows"] == 60 and r["subject_overlap"] == 0 for r in sp.fold_preview(sample(spark), balanced=True).collect())


def test_exact_split_and_balanced_folds_reach_the_models(spark):
    df = sample(spark)
    data = pp.prepare(df, Settings(exact_split=True))
    assert data.test.select("SUBJECT_ID").distinct().count() == 18
    train = data.preparation.vectors(data.train)
    oof, _ = em.cross_validate(train, md.baseline_models()[:1], 4, balanced=True)
    sizes = sorted(r["count"] for r in oof.groupBy("fold").count().collect())
    assert sum(sizes) == train.count() and sizes[-1] - sizes[0] <= 1


def test_leaking_columns_are_refused():
    with pytest.raises(ValueError, match="DISCHTIME"):
        sp.model_columns(["SUBJECT_ID", "DISCHTIME", "x"])
    assert sp.model_columns(["SUBJECT_ID", "LOS", "x", "y"], exclude=("y",)) == ["x"]


def test_preparation_matches_numpy(spark, tmp_path):
    train = sample(spark)
    fitted = pp.fit_preparation(train)
    assert fitted.names == (
        "a", "b", "same", "missingindicator_a", "missingindicator_empty", "c_it's", "c_x", "c_y y",
    )
    rows = fitted.flat(fitted.transform(train)).orderBy("ICUSTAY_ID").collect()
    raw = train.orderBy("ICUSTAY_ID").collect()
    a = np.array([np.nan if r["a"] is None else r["a"] for r in raw])
    filled = np.where(np.isnan(a), np.nanmedian(a), a)
    flag = np.isnan(a).astype(float)
    np.testing.assert_allclose([r["a"] for r in rows], (filled - filled.mean()) / filled.std(), atol=1e-12)
    np.testing.assert_allclose([r["missingindicator_a"] for r in rows], (flag - flag.mean()) / flag.std(), atol=1e-12)
    assert {r["same"] for r in rows} == {0.0} and {r["missingindicator_empty"] for r in rows} == {0.0}
    counts = {}
    for r in raw:
        counts[r["c"]] = counts.get(r["c"], 0) + 1
    mode = min((k for k in counts if k), key=lambda k: (-counts[k], k))
    assert sum(r[f"c_{mode}"] for r in rows) == counts[mode] + counts[None]
    fitted.save(str(tmp_path / "fit"))
    loaded = pp.Preparation.load(str(tmp_path / "fit"))
    assert loaded.names == fitted.names
    assert loaded.transform(train).exceptAll(fitted.transform(train)).count() == 0


def test_unseen_category_is_all_zero_and_float_export(spark):
    train = sample(spark).select("SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "LOS", "c")
    fitted = pp.fit_preparation(train)
    new = train.limit(1).withColumn("c", F.lit("never"))
    flat = fitted.flat(fitted.transform(new), "float")
    assert [flat.first()[n] for n in fitted.names] == [0.0, 0.0, 0.0] and dict(flat.dtypes)["c_x"] == "float"


def test_mode_tie_takes_the_lowest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "c string")
    assert pp.fit_categories(df, ["c"])[0].mode == "a"


def vectors(spark, n=200, columns=3):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, columns)) * [1, 5, 0.2][:columns] + 2
    y = x @ np.array([1.0, -0.5, 4.0][:columns]) + rng.normal(size=n)
    rows = [(i % 40, i, i, float(y[i]), [float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, IDS + ", prepared array<double>")
    return df.withColumn("features", array_to_vector("prepared")), x, y


def test_ridge_equals_closed_form(spark):
    df, x, y = vectors(spark)
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    got = [r["prediction"] for r in md.fit_ridge(df, 1.0).transform(df).orderBy("ICUSTAY_ID").collect()]
    np.testing.assert_allclose(got, z @ beta + y.mean(), rtol=1e-9)


def test_mean_model_and_metrics(spark):
    df, _, y = vectors(spark)
    scored = em.predict(md.fit_mean(df), df).withColumn("g", F.lit(1))
    row = em.regression_metrics(scored, ["g"], 200).first()
    error = y - y.mean()
    assert row["MAE"] == pytest.approx(np.abs(error).mean()) and row["RMSE"] == pytest.approx(y.std())
    assert row["R2"] == pytest.approx(0, abs=1e-12) and row["MedianAE"] == pytest.approx(np.median(np.abs(error)))


def test_models_rank_above_the_mean(spark):
    df, _, _ = vectors(spark)
    models = md.baseline_models({"trees": 10, "max_depth": 5}, {"rounds": 10, "max_depth": 3, "min_leaf": 5})
    cv = em.cv_benchmark(df, models, folds=2).collect()
    assert cv[0]["model"] == "Ridge" and cv[-1]["model"] == "Mean" and len(cv) == 4
    done = em.evaluate_on_test(df, df, models)
    assert [c for c in done.predictions.columns if c.endswith("_pred")] == [f"{m.name}_pred" for m in models]
    tuned = em.tune(df, "boosted", trials=2, folds=2, ranges={"rounds": (2, 4), "max_depth": (2, 3)})
    assert tuned.best_cv_mae == min(score for _, score in tuned.trials)
    ranked = em.compare_models(done.results, em.evaluate_on_test(df, df, [md.ModelSpec("tuned", lambda _: tuned.model)]).results)
    maes = [r["MAE"] for r in ranked.collect()]
    assert maes == sorted(maes) and len(maes) == 5
    summary = em.run_summary(df, df, ("p", "q", "r"), ranked).first()
    assert summary["best_model"] == em.best_model(ranked) and summary["train_rows"] == 200 and summary["n_features"] == 3


def test_early_stopping_is_asked_for(spark):
    df, _, _ = vectors(spark)
    assert md.fit_boosted(df, rounds=3, max_depth=2).getNumTrees == 3
    assert md.fit_boosted(df, early_stop_share=0.1, rounds=3, max_depth=2).transform(df).count() == 200


def test_trees_do_not_depend_on_the_layout(spark):
    df, _, _ = vectors(spark)
    for fit in (lambda d: md.fit_forest(d, trees=5, max_depth=4), lambda d: md.fit_boosted(d, rounds=4, max_depth=3, min_leaf=2)):
        one, eight = (
            [r["prediction"] for r in fit(df.repartition(n)).transform(df).orderBy("ICUSTAY_ID").collect()] for n in (1, 8)
        )
        assert one == eight


def test_closed_form_is_refused_beyond_its_limit(spark, monkeypatch):
    df, _, _ = vectors(spark)
    monkeypatch.setattr(md, "NORMAL_SOLVER_FEATURES", 2)
    with pytest.raises(ValueError, match="l-bfgs"):
        md.fit_ridge(df)
    assert md.fit_ridge(df, solver="l-bfgs").transform(df).count() == 200


@pytest.mark.parametrize("rows", [1000, 10**6])
def test_metrics_keep_the_null_group(spark, rows):
    data = [("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, 1.0), (None, 7.0, 1.0), (None, 9.0, 1.0)]
    scored = spark.createDataFrame(data, "g string, y_true double, prediction double")
    got = {r["g"]: (r["MAE"], r["MedianAE"]) for r in em.regression_metrics(scored, ["g"], rows).collect()}
    assert got == {"a": (1.0, 1.0), None: (6.0, 6.0)}


def test_trials_stay_in_range():
    for t in em.draw_trials("boosted", 50):
        assert 0.01 <= t["rate"] <= 0.2 and 3 <= t["max_depth"] <= 12 and 100 <= t["rounds"] <= 400 and 10 <= t["min_leaf"] <= 80
    forest = em.draw_trials("forest", 50)
    assert {t["trees"] % 50 for t in forest} == {0} and forest == em.draw_trials("forest", 50)


@pytest.mark.parametrize("blocks", [1, 8])
def test_permutation_importance_finds_the_strong_feature(spark, blocks):
    df, x, y = vectors(spark)
    model = md.fit_ridge(df)
    # The ridge model reads "features" through its scaler, so replacing it works.
    got = em.permutation_importance(model, df, ("one", "two", "three"), repeats=5, blocks=blocks).collect()
    assert [r["feature"] for r in got][0] == "two" and all(r["importance_std"] >= 0 for r in got)
    # Shuffling a coefficient's column costs about 2 * beta^2 * var(x) / var(y).
    share = 2 * 0.25 * x[:, 1].var() / y.var()
    assert got[0]["importance_mean"] == pytest.approx(share, rel=0.35)


def test_permutation_spans_the_whole_table(spark):
    df, _, _ = vectors(spark)
    model = md.fit_ridge(df)
    one, many = (
        {r["feature"]: r for r in em.permutation_importance(model, df, ("one", "two", "three"), repeats=3, blocks=b).collect()}
        for b in (1, 7)
    )
    for name, r in one.items():
        assert r["importance_mean"] == pytest.approx(many[name]["importance_mean"], rel=1e-9, abs=1e-12)
        assert r["importance_std"] == pytest.approx(many[name]["importance_std"], rel=1e-9, abs=1e-12)


def test_importance_of_a_target_that_does_not_vary_is_undefined(spark):
    rows = [(i, 2.5, Vectors.dense([1.0, float(i % 2), 3.0])) for i in range(6)]
    df = spark.createDataFrame(rows, [STAY, TARGET, FEATURES])
    got = em.permutation_importance(LinearModel((1.0, 0.0, 2.0), 0.0), df, ("one", "unread", "two"), repeats=3).collect()
    assert len(got) == 3 and all(math.isnan(r["importance_mean"]) and math.isnan(r["importance_std"]) for r in got)
    with pytest.raises(ValueError, match="rows with a target"):
        em.permutation_importance(LinearModel((1.0, 0.0, 2.0), 0.0), df.limit(0), ("one", "unread", "two"))


def test_log_target_round_trip(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 6.5)], "ICUSTAY_ID bigint, LOS double")
    back = md.without_log(md.with_log_target(df), "LOS").orderBy("ICUSTAY_ID").collect()
    assert [r["LOS"] for r in back] == pytest.approx([0.0, 6.5])


def test_target_reports(spark):
    df = spark.range(1, 101).select((F.col("id") * 1.0).alias("LOS"), F.col("id").alias("SUBJECT_ID"), F.col("id").alias("ICUSTAY_ID"))
    summary = {r["metric"]: r["value"] for r in ql.target_summary(df).collect()}
    assert summary["50%"] == 50.5 and summary["25%"] == 25.75 and summary["max"] == 100
    hist = ql.target_histogram(df, bins=40).orderBy("bin").collect()
    expected, _ = np.histogram(np.arange(1, 101), bins=40)
    assert [r["count"] for r in hist] == expected.tolist()
    assert ql.target_histogram(df.filter("LOS = 5")).agg(F.sum("count")).first()[0] == 1


def test_trials_of_forests_are_not_written(spark, monkeypatch):
    rows = [(i % 30, i, i, float(i % 7 + i % 3), [float(i % 7), float(i % 11), float(i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, LOS double, x array<double>")
    df = df.withColumn("features", array_to_vector("x"))
    planted, plain, found = [], em.plant, []
    monkeypatch.setattr(em, "plant", lambda *a: planted.append(1) or plain(*a))
    for limit in (tr.LOCAL_BYTES, 100):
        monkeypatch.setattr(tr, "LOCAL_BYTES", limit)
        found.append(em.tune(df, "forest", trials=2, folds=2, ranges={"trees": (2, 3, 1), "max_depth": (2, 4)}))
        # Only the best setting is planted, but for more rows than a task may hold.
        assert len(planted) == (1 if limit > 100 else 1 + 5)
    (a, b) = ([mae for _, mae in t.trials] for t in found)
    assert a == pytest.approx(b, rel=1e-9) and found[0].best_params == found[1].best_params
