"""Queries for preparation, splits, models and evaluation."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from checks import feature_queries as fq
from checks import sqltext as q
from checks.standins import standin_tables
from staylens.operators import quality as ql
from staylens.operators import split as sp
from staylens.plans import artifacts as art
from staylens.plans import evaluate as em
from staylens.plans import models as md
from staylens.plans import prepare as pp
from staylens.plans.features import build_features
from staylens.plans.linear import LinearModel
from staylens.schemas import ID_COLUMNS, STAY, TARGET
from staylens.session import keep, new_path
from staylens.settings import Settings
from staylens.sources import export_csv, read_export

# A fixed linear model over a few raw columns; the third takes no part.
FEW = ["AGE", "ED_LOS_HOURS", fq.ITEM_COLUMNS[0], fq.ITEM_COLUMNS[1]]
FEW_WEIGHTS = [0.05, 0.25, 0.0, 0.0625]
# One of the two published numbers of trials; folds, rounds, trees and ranges are the defaults.
TRIALS = 10


def _features(spark, sf):
    return build_features(standin_tables(spark, sf), "5").features


def _prepared(spark, sf):
    data = pp.prepare(_features(spark, sf))
    vectors = data.preparation.vectors
    return data, vectors(data.train), vectors(data.test)


def group_split(spark, sf):
    train, test = sp.group_split(_features(spark, sf))
    side = lambda df, name: df.select(*ID_COLUMNS, F.lit(name).alias("side"))
    return side(train, "train").unionByName(side(test, "test"))


def leakage_check(spark, sf):
    return sp.leakage_check(*sp.group_split(keep(_features(spark, sf), "features")))


def group_kfold(spark, sf):
    train, _ = sp.group_split(_features(spark, sf))
    return sp.fold_preview(train)


def exact_split(spark, sf):
    train, test = sp.exact_group_split(keep(_features(spark, sf), "features"))
    side = lambda df, name: df.select(*ID_COLUMNS, F.lit(name).alias("side"))
    return side(train, "train").unionByName(side(test, "test"))


def balanced_folds(spark, sf):
    return sp.fold_preview(keep(_features(spark, sf), "features"), balanced=True)


def audit(spark, sf):
    return ql.audit(*sp.group_split(keep(_features(spark, sf), "features")))


def _numeric_fits(spark, sf):
    train, _ = sp.group_split(keep(_features(spark, sf), "features"))
    numeric, _ = pp.split_types(train, sp.model_columns(train.columns))
    return pp.fit_numeric(train, numeric)


def impute_median(spark, sf):
    rows = [(f.column, f.median, f.missing) for f in _numeric_fits(spark, sf)]
    out = spark.createDataFrame(rows, "feature string, median double, missing bigint")
    return out.withColumn("median", F.round("median", 6))


def standard_scale(spark, sf):
    rows = [(f.column, f.mean, f.std) for f in _numeric_fits(spark, sf)]
    out = spark.createDataFrame(rows, "feature string, mean double, std double")
    return out.select("feature", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"))


def _category_fits(spark, sf):
    train, _ = sp.group_split(keep(_features(spark, sf), "features"))
    _, categorical = pp.split_types(train, sp.model_columns(train.columns))
    return pp.fit_categories(train, categorical)


def impute_mode(spark, sf):
    rows = [(f.column, f.mode, len(f.values)) for f in _category_fits(spark, sf)]
    return spark.createDataFrame(rows, "feature string, mode string, known_values bigint")


def one_hot(spark, sf):
    """Sum of every one-hot column on both sides of the split."""
    features = keep(_features(spark, sf), "features")
    train, test = sp.group_split(features)
    _, categorical = pp.split_types(train, sp.model_columns(train.columns))
    fitted = pp.build_preparation([], pp.fit_categories(train, categorical))
    out = None
    for side, df in (("train", train), ("test", test)):
        cells = fitted.vectors(fitted.transform(df)).select(F.posexplode(pp.PREPARED).alias("position", "hot"))
        names = F.array(*[F.lit(n) for n in fitted.names])
        part = cells.groupBy(names[F.col("position")].alias("feature")).agg(
            F.sum("hot").cast("bigint").alias("rows")
        ).select(F.lit(side).alias("side"), "feature", "rows")
        out = part if out is None else out.unionByName(part)
    return out


def prepare(spark, sf):
    """Prepared numeric part of train and test after saving and loading the fit."""
    path = new_path(spark, "prepare")
    data = pp.prepare(_features(spark, sf), Settings(), path)
    loaded = pp.Preparation.load(f"{path}/preparation")
    both = data.preparation.flat(data.train).select(F.lit("train").alias("side"), "*").unionByName(
        loaded.flat(data.test).select(F.lit("test").alias("side"), "*")
    )
    numbers = [*fq.ITEM_COLUMNS, *NUMERIC_CONTEXT]
    return both.select("side", *ID_COLUMNS, *[F.round(c, 5).alias(c) for c in numbers])


def log_target(spark, sf):
    features = _features(spark, sf).select(STAY, TARGET)
    logged = md.with_log_target(features).withColumn("log_los", F.col(TARGET))
    return md.without_log(logged, TARGET).select(
        STAY, F.round("log_los", 9).alias("log_los"), F.round(TARGET, 9).alias(TARGET)
    )


def model_mean(spark, sf):
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    model = md.fit_mean(train)
    scored = em.predict(model, test)
    return scored.select(*ID_COLUMNS, *[F.round(c, 9).alias(c) for c in (em.TRUTH, em.PREDICTION)])


def regression_metrics(spark, sf):
    """Metrics per gender (NULL for stays without patient) of the mean model."""
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    scored = md.fit_mean(train).transform(test).withColumn(em.TRUTH, F.col(TARGET))
    out = em.regression_metrics(scored, ["GENDER"], test.count())
    return out.select("GENDER", *[F.round(m, 6).alias(m) for m in ("MAE", "RMSE", "R2", "MedianAE")])


def cv_mean(spark, sf):
    train, _ = sp.group_split(keep(_features(spark, sf), "features"))
    out = em.cv_benchmark(train, [md.ModelSpec("Mean", md.fit_mean)])
    return out.drop("fit_time_seconds").select("model", *[F.round(c, 6).alias(c) for c in out.columns if c.startswith("cv_")])


def _model_query(fit):
    def run(spark, sf):
        _, train, test = _prepared(spark, sf)
        return em.predict(fit(train), test)

    return run


def ridge_gradient(spark, sf):
    """Slope of the penalised mean loss at the fitted ridge weights: zero only there."""
    data, train, _ = _prepared(spark, sf)
    train = keep(train, "vectors")
    model = md.fit_ridge(train, 1.0)
    n = train.count()
    columns = [F.array(*[F.lit(x) for x in v]) for v in (model.weights, model.means, model.deviations)]
    weights, means, deviations = (F.get(c, F.col("at")) for c in columns)
    error = F.col(TARGET) - F.col("prediction")
    cells = model.transform(train).select(error.alias("e"), F.posexplode(vector_to_array(pp.FEATURES)).alias("at", "x"))
    scaled = F.when(deviations > 0, (F.col("x") - means) / deviations).otherwise(0.0)
    names = F.array(*[F.lit(x) for x in data.preparation.names])
    sums = cells.groupBy("at").agg(F.sum(scaled * F.col("e")).alias("dot"))
    slope = weights * deviations - F.col("dot")
    # Adding zero turns a rounded -0.0 into 0.0.
    return sums.select(F.get(names, F.col("at")).alias("feature"), (F.round(slope / n, 6) + 0.0).alias("slope"))


def ridge_two(spark, sf):
    """Weights of a ridge on two features, which SQL solves by hand."""
    model = md.fit_ridge(_few(sp.group_split(keep(_features(spark, sf), "features"))[0], FEW[:2]), 1.0)
    rows = [(c, float(w)) for c, w in zip(["intercept", *FEW[:2]], [model.intercept, *model.weights])]
    out = spark.createDataFrame(rows, "feature string, weight double")
    return out.select("feature", F.round("weight", 6).alias("weight"))


def _few(df, columns):
    """A vector of a few raw columns, NULL as 0."""
    cells = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return df.select(*ID_COLUMNS, TARGET, array_to_vector(cells).alias(pp.FEATURES))


def forest_bounds(spark, sf):
    """A forest averages training targets, so it stays within their range."""
    _, train, test = _prepared(spark, sf)
    low, high = train.agg(F.min(TARGET), F.max(TARGET)).first()
    scored = em.predict(md.fit_forest(train), test)
    inside = F.col(em.PREDICTION).between(low - 1e-9, high + 1e-9)
    return scored.select(*ID_COLUMNS, F.round(em.TRUTH, 9).alias(em.TRUTH), inside.alias("inside"))


def _two_means(spark, sf):
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    high = train.agg(F.max(TARGET)).first()[0]
    highest = SQLTransformer(statement=f"SELECT *, {high!r}D AS {em.PREDICTION} FROM __THIS__")
    models = [md.ModelSpec("Mean", md.fit_mean), md.ModelSpec("Highest", lambda _: PipelineModel([highest]))]
    return em.evaluate_on_test(train, test, models)


def compare_means(spark, sf):
    """Ranked comparison of two models that SQL can replay."""
    out = em.compare_models(_two_means(spark, sf).results)
    return out.select("model", "rank", *[F.round(m, 6).alias(m) for m in ("MAE", "RMSE", "R2", "MedianAE")])


def observed_vs_predicted(spark, sf):
    done = _two_means(spark, sf)
    out = em.observed_vs_predicted(done.predictions, em.best_model(done.results))
    return out.select(STAY, *[F.round(c, 9).alias(c) for c in (em.TRUTH, "y_pred")])


def prepared_cells(spark, sf):
    """Every cell of the prepared sets: numbers, indicators and one-hot columns."""
    data = pp.prepare(_features(spark, sf))
    names = F.array(*[F.lit(n) for n in data.preparation.names])
    out = None
    for side, df in (("train", data.train), ("test", data.test)):
        cells = data.preparation.vectors(df).select(STAY, F.posexplode(pp.PREPARED).alias("at", "v"))
        value = F.round("v", 5) + 0.0
        part = cells.select(F.lit(side).alias("side"), STAY, F.get(names, F.col("at")).alias("feature"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def float_export(spark, sf):
    """The flat float export of the test set, read back from CSV."""
    data = pp.prepare(_features(spark, sf))
    path = new_path(spark, "float-export")
    flat = data.preparation.flat(data.test, "float")
    export_csv(flat, path)
    back = read_export(spark, path, flat.schema)
    return back.select(*ID_COLUMNS, *[F.round(F.col(c).cast("double"), 4).alias(c) for c in NUMERIC])


def audit_prepared(spark, sf):
    """The audit of the prepared sets, as they train models."""
    data = pp.prepare(_features(spark, sf))
    return ql.audit(data.preparation.flat(data.train), data.preparation.flat(data.test))


def cv_benchmark(spark, sf):
    _, train, _ = _prepared(spark, sf)
    return em.cv_benchmark(keep(train, "vectors"), md.baseline_models())


def test_predictions(spark, sf):
    _, train, test = _prepared(spark, sf)
    return em.evaluate_on_test(train, test, md.baseline_models()).predictions


def _tuned(train):
    return [em.tune(train, kind, trials=TRIALS) for kind in ("boosted", "forest")]


def tune(spark, sf):
    _, train, _ = _prepared(spark, sf)
    train = keep(train, "vectors")
    return em.tuning_results(train, _tuned(train))


def model_compare(spark, sf):
    """Baselines and the best boosting of the search, fitted on all of train."""
    _, train, test = _prepared(spark, sf)
    train, test = keep(train, "vectors"), keep(test, "vectors")
    baseline = em.evaluate_on_test(train, test, md.baseline_models())
    best = em.tune(train, "boosted", trials=TRIALS)
    tuned = [md.ModelSpec("GradientBoosting_tuned", lambda _: best.model)]
    return em.compare_models(baseline.results, em.evaluate_on_test(train, test, tuned).results)


def compare_two_tables(spark, sf):
    """Two result tables of replayable models joined into one ranking."""
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    plain = em.evaluate_on_test(train, test, [md.ModelSpec("Mean", md.fit_mean)]).results
    logged = em.evaluate_on_test(train, test, [_log_mean()]).results
    out = em.compare_models(plain, logged)
    return out.select("model", "rank", *[F.round(m, 6).alias(m) for m in ("MAE", "RMSE", "R2", "MedianAE")])


def _log_mean():
    return md.on_log_target(md.ModelSpec("LogMean", md.fit_mean))


def log_target_model(spark, sf):
    """Test predictions and cross-validation error of the mean of log1p(LOS), in days."""
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    done = em.evaluate_on_test(train, test, [_log_mean()])
    mae = em.cv_benchmark(train, [_log_mean()]).first()["cv_mae_mean"]
    return done.predictions.select(*ID_COLUMNS, F.round("LogMean_pred", 6).alias("prediction"), F.round(F.lit(mae), 6).alias("cv_mae_mean"))


def saved_models(spark, sf):
    """Do models that were saved and loaded again predict the same for every test stay?"""
    data, train, test = _prepared(spark, sf)
    train, test, names = keep(train, "vectors"), keep(test, "vectors"), data.preparation.names
    models = {
        "Mean": md.fit_mean(train),
        "Ridge": md.fit_ridge(train),
        "RandomForest": md.fit_forest(train, trees=10),
        "GradientBoosting": md.fit_boosted(train, rounds=10),
        "LogRidge": md.on_log_target(md.ModelSpec("LogRidge", md.fit_ridge)).fit(train),
    }
    out = None
    for name, model in models.items():
        folder = new_path(spark, f"model-{name}")
        art.save_model(model, folder, names)
        loaded = art.load_model(folder, names)
        both = loaded.transform(model.transform(test).withColumnRenamed(md.PREDICTION, "before"))
        part = both.select(STAY, F.lit(name).alias("model"), (F.col("before") == F.col(md.PREDICTION)).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


def published_results(spark, sf):
    """All result tables of a run with replayable models, published and read back."""
    train, test = sp.group_split(keep(_features(spark, sf), "features"))
    models = [md.ModelSpec("Mean", md.fit_mean), _log_mean()]
    cv = em.cv_benchmark(train, models)
    done = em.evaluate_on_test(train, test, models)
    comparison = em.compare_models(done.results)
    importance = em.permutation_importance(_linear(), _few(test, FEW), tuple(FEW))
    folder = new_path(spark, "results")
    em.publish_run(folder, em.RunResults(cv, done.results, comparison, importance, done.predictions), ("a", "b"), train.count(), test.count())
    tables, summary = art.read_published(folder)
    long = []
    for name, columns in (("cv_results", ["cv_mae_mean", "cv_r2_std"]), ("test_results", ["MAE", "R2"]), ("comparison", ["rank"])):
        for c in columns:
            long.append(tables[name].select(F.lit(name).alias("part"), F.col("model").alias("name"), F.lit(c).alias("metric"), F.round(F.col(c).cast("double"), 6).alias("value")))
    long.append(tables["importance"].select(F.lit("importance"), "feature", F.lit("importance_mean"), F.round("importance_mean", 6)))
    sums = tables["predictions"].agg(F.sum("Mean_pred").alias("s"))
    long.append(sums.select(F.lit("predictions"), F.lit("Mean"), F.lit("sum"), F.round("s", 5)))
    numbers = [("summary", k, "value", float(summary[k])) for k in ("train_rows", "test_rows", "n_features")]
    numbers.append(("summary", summary["best_model"], "best_model", 1.0))
    out = spark.createDataFrame(numbers, "part string, name string, metric string, value double")
    for part in long:
        out = out.union(part)
    return out


def permutation_importance(spark, sf):
    data, train, test = _prepared(spark, sf)
    model = md.fit_boosted(train)
    return em.permutation_importance(model, test, data.preparation.names)


def _linear():
    return LinearModel(tuple(FEW_WEIGHTS), 1.0)


def importance_linear(spark, sf):
    """Importance of a fixed linear model, which SQL can replay."""
    _, test = sp.group_split(keep(_features(spark, sf), "features"))
    out = em.permutation_importance(_linear(), _few(test, FEW), tuple(FEW))
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("importance_mean", "importance_std")])


def run_summary(spark, sf):
    data, train, test = _prepared(spark, sf)
    train, test = keep(train, "vectors"), keep(test, "vectors")
    done = em.evaluate_on_test(train, test, md.baseline_models())
    return em.run_summary(train, test, data.preparation.names, done.results)


QUERIES = {
    "group_split": group_split,
    "leakage_check": leakage_check,
    "group_kfold": group_kfold,
    "exact_split": exact_split,
    "balanced_folds": balanced_folds,
    "audit": audit,
    "impute_median": impute_median,
    "standard_scale": standard_scale,
    "impute_mode": impute_mode,
    "one_hot": one_hot,
    "prepare": prepare,
    "log_target": log_target,
    "model_mean": model_mean,
    "regression_metrics": regression_metrics,
    "cv_mean": cv_mean,
    "model_ridge": _model_query(md.fit_ridge),
    "model_forest": _model_query(md.fit_forest),
    "model_boosted": _model_query(md.fit_boosted),
    "ridge_gradient": ridge_gradient,
    "forest_bounds": forest_bounds,
    "compare_means": compare_means,
    "observed_vs_predicted": observed_vs_predicted,
    "cv_benchmark": cv_benchmark,
    "test_predictions": test_predictions,
    "tune": tune,
    "model_compare": model_compare,
    "permutation_importance": permutation_importance,
    "run_summary": run_summary,
    "ridge_two": ridge_two,
    "prepared_cells": prepared_cells,
    "float_export": float_export,
    "audit_prepared": audit_prepared,
    "compare_two_tables": compare_two_tables,
    "log_target_model": log_target_model,
    "saved_models": saved_models,
    "published_results": published_results,
    "importance_linear": importance_linear,
}


# ---------------------------------------------------------------- comparison

HASH = "CAST(('0x' || substr(md5('{salt}:' || SUBJECT_ID), 1, 8)) AS BIGINT)"
IS_TEST = f"{HASH.format(salt='42')} / 4294967296.0 < 0.2"
FOLD_SQL = f"{HASH.format(salt='42:fold')} % 5"
NUMERIC_CONTEXT = ["AGE", "HAS_CHARTEVENTS_DATA", "ED_LOS_HOURS"]
NUMERIC = [*NUMERIC_CONTEXT, *fq.ITEM_COLUMNS]
CATEGORICAL = [c for c in fq.FEATURE_COLUMNS if c not in NUMERIC]


def _sides():
    return fq.static_features_5() + [
        ("sided", f"SELECT *, CASE WHEN {IS_TEST} THEN 'test' ELSE 'train' END AS side FROM final_features"),
        ("train", "SELECT * FROM sided WHERE side = 'train'"),
        ("test", "SELECT * FROM sided WHERE side = 'test'"),
    ]


def _each(template, columns):
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


def _balanced_sql(sides):
    """Patients dealt one by one, the largest first, each to the lightest fold."""
    sizes = """SELECT row_number() OVER (ORDER BY stays DESC, SUBJECT_ID) AS place, stays
FROM (SELECT SUBJECT_ID, count(*) AS stays FROM final_features GROUP BY SUBJECT_ID)"""
    lightest = "list_position(loads, list_min(loads))"
    add = "list_transform({loads}, lambda x, k: CASE WHEN k = " + lightest + " THEN x + {more} ELSE x END)"
    zeros = "CAST([0, 0, 0, 0, 0] AS BIGINT[])"
    dealt = f"""SELECT CAST(0 AS BIGINT) AS place, {zeros} AS loads, {zeros} AS people UNION ALL
SELECT s.place, {add.format(loads='loads', more='s.stays')}, {add.format(loads='people', more='1')} FROM dealt d JOIN sizes s ON s.place = d.place + 1"""
    parts = q.cte(*sides, ("sizes", sizes), ("dealt", dealt), ("dealt_last", "SELECT * FROM dealt WHERE place = (SELECT max(place) FROM dealt)"))
    last = "SELECT unnest(range(5)) AS fold, unnest(loads) AS n, unnest(people) AS people FROM dealt_last"
    return parts.replace("WITH ", "WITH RECURSIVE ", 1) + f"""SELECT CAST(fold AS INT) AS fold, CAST(sum(n) OVER () - n AS BIGINT) AS train_rows, CAST(n AS BIGINT) AS valid_rows,
  CAST(sum(people) OVER () - people AS BIGINT) AS train_subjects, CAST(people AS BIGINT) AS valid_subjects, CAST(0 AS BIGINT) AS subject_overlap FROM ({last})"""


def _audit_sql():
    width = len(fq.CONTEXT_COLUMNS) + len(fq.ITEM_COLUMNS)
    missing = " + ".join(f"count_if({c} IS NULL)" for c in fq.CONTEXT_COLUMNS + fq.ITEM_COLUMNS)
    rows = []
    for side in ("train", "test"):
        rows += [
            (f"{side}_rows", "count(*)", side),
            (f"{side}_missing_cells", missing, side),
            (f"target_{side}_missing", "count_if(LOS IS NULL)", side),
            (f"{side}_columns", str(width), ""),
            (f"columns_only_in_{side}", "0", ""),
        ]
        rows += [(f"{side}_has_{c}", "1", "") for c in (*ID_COLUMNS, TARGET)]
    return q.cte(*_sides()) + fq._metrics(rows)


def _prepare_sql():
    params = ", ".join(f"median({c}) AS med_{c}" for c in NUMERIC)
    filled = ", ".join(f"coalesce({c}, med_{c}) AS {c}" for c in NUMERIC)
    moments = ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in NUMERIC)
    scaled = ", ".join(
        f"round(CASE WHEN std_{c} = 0 THEN {c} - mean_{c} ELSE ({c} - mean_{c}) / std_{c} END, 5) AS {c}" for c in NUMERIC
    )
    return (
        q.cte(
            *_sides(),
            ("params", f"SELECT {params} FROM train"),
            ("filled", f"SELECT side, SUBJECT_ID, HADM_ID, ICUSTAY_ID, {filled} FROM sided CROSS JOIN params"),
            ("moments", f"SELECT {moments} FROM filled WHERE side = 'train'"),
        )
        + f"SELECT side, SUBJECT_ID, HADM_ID, ICUSTAY_ID, {scaled} FROM filled CROSS JOIN moments"
    )


def _metric_sql():
    return """round(avg(abs(e)), 6) AS MAE, round(sqrt(avg(e * e)), 6) AS RMSE,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum(e * e) / (var_pop(y) * count(*)) END, 6) AS R2, round(median(abs(e)), 6) AS MedianAE"""


def _cells_sql():
    """Every prepared cell, one line per stay and feature."""
    scaled = "round(CASE WHEN std = 0 THEN v - mean ELSE (v - mean) / std END, 5) + 0"
    number = f"""SELECT side, ICUSTAY_ID, '{{c}}' AS feature, {scaled} AS value
FROM (SELECT side, ICUSTAY_ID, CAST(coalesce({{c}}, med) AS DOUBLE) AS v, med FROM sided CROSS JOIN (SELECT median({{c}}) AS med FROM train)) x
CROSS JOIN (SELECT avg(v) AS mean, stddev_pop(v) AS std FROM (SELECT CAST(coalesce({{c}}, (SELECT median({{c}}) FROM train)) AS DOUBLE) AS v FROM train)) m"""
    flag = f"""SELECT side, ICUSTAY_ID, 'missingindicator_{{c}}' AS feature, {scaled} AS value
FROM (SELECT side, ICUSTAY_ID, CASE WHEN {{c}} IS NULL THEN 1.0 ELSE 0.0 END AS v FROM sided)
CROSS JOIN (SELECT 1 - count({{c}}) / CAST(count(*) AS DOUBLE) AS mean, sqrt((count({{c}}) / CAST(count(*) AS DOUBLE)) * (1 - count({{c}}) / CAST(count(*) AS DOUBLE))) AS std
  FROM train HAVING count(*) > count({{c}})) m"""
    hot = """SELECT s.side, s.ICUSTAY_ID, concat('{c}_', v.v) AS feature, CASE WHEN coalesce(s.{c}, m.mode) = v.v THEN 1.0 ELSE 0.0 END AS value
FROM sided s CROSS JOIN (SELECT DISTINCT {c} AS v FROM train WHERE {c} IS NOT NULL) v
CROSS JOIN (SELECT {c} AS mode FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) m"""
    parts = [_each(number, NUMERIC), _each(flag, NUMERIC), _each(hot, CATEGORICAL)]
    return q.cte(*_sides()) + "SELECT side, ICUSTAY_ID, feature, CAST(value AS DOUBLE) AS value FROM (" + " UNION ALL ".join(parts) + ")"


def _float_sql():
    cells = ", ".join(f"round(CAST(CAST(unrounded.{c} AS FLOAT) AS DOUBLE), 4) AS {c}" for c in NUMERIC)
    exact = _prepare_sql()
    for c in NUMERIC:
        exact = exact.replace(f"std_{c} END, 5) AS {c}", f"std_{c} END, 17) AS {c}")
    return f"SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, {cells} FROM ({exact}) unrounded WHERE side = 'test'"


def _importance_ctes():
    """Importance of the fixed linear model, step by step."""
    steps = ", ".join(f"[{r}, 1 + CAST(('0x' || substr(md5('42:step:{r}'), 1, 8)) AS BIGINT) % (n - 1)]" for r in range(10))
    draw = "CAST(('0x' || substr(md5('42:order:' || ICUSTAY_ID), 1, 8)) AS BIGINT)"
    few = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEW)
    y = " + ".join(f"{w} * {c}" for w, c in zip(FEW_WEIGHTS, FEW))
    size = "(SELECT count(*) AS n FROM test WHERE LOS IS NOT NULL)"
    each = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, s.r, sum(pow(a.e - {w} * (b.{c} - a.{c}), 2) - a.e * a.e) AS extra FROM steps s CROSS JOIN drawn a JOIN drawn b ON b.k = (a.k + s.step) % s.n GROUP BY s.r"
        for w, c in zip(FEW_WEIGHTS, FEW)
    )
    return [
        ("drawn", f"SELECT *, LOS - (1 + {y}) AS e FROM (SELECT row_number() OVER (ORDER BY {draw}, ICUSTAY_ID) - 1 AS k, LOS, {few} FROM test WHERE LOS IS NOT NULL)"),
        ("steps", f"SELECT u.p[1] AS r, u.p[2] AS step, n FROM (SELECT n, unnest([{steps}]) AS p FROM {size}) u"),
        ("extra", each),
        ("importance", "SELECT feature, avg(extra / s) AS importance_mean, stddev_pop(extra / s) AS importance_std FROM extra CROSS JOIN (SELECT var_pop(LOS) * count(LOS) AS s FROM test) GROUP BY feature"),
    ]


def _replayed(sides, folds, scored):
    """Queries on models that SQL can fit itself."""
    log = "exp((SELECT avg(ln(1 + LOS)) FROM train)) - 1"
    log_folds = [
        (n, t.replace("avg(t.LOS) AS mean", "exp(avg(ln(1 + t.LOS))) - 1 AS mean")) for n, t in folds
    ]
    named = [
        ("constant", f"SELECT 'Mean' AS model, avg(LOS) AS p FROM train UNION ALL SELECT 'LogMean', {log}"),
        *scored[1:],
    ]
    ranked = "SELECT model, CAST(row_number() OVER (ORDER BY MAE, model) AS INT) AS rank, MAE, RMSE, R2, MedianAE FROM metrics"
    cv = "round(avg(mae), 6) AS cv_mae_mean, round(stddev_pop(r2), 6) AS cv_r2_std"
    both = [*folds, *[(f"log_{n}", re.sub(r"\b(folded|fold_means|fold_errors)\b", r"log_\1", t)) for n, t in log_folds]]
    x, y = FEW[:2]
    two = [
        ("few", f"SELECT CAST(coalesce({x}, 0) AS DOUBLE) AS a, CAST(coalesce({y}, 0) AS DOUBLE) AS b, LOS AS y FROM train WHERE LOS IS NOT NULL"),
        ("moments", "SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb FROM few"),
        ("z", "SELECT (a - ma) / sa AS a, (b - mb) / sb AS b, y - my AS y FROM few CROSS JOIN moments"),
        ("sums", "SELECT sum(a * a) + 1 AS aa, sum(b * b) + 1 AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS byy FROM z"),
        ("beta", "SELECT (ay * bb - byy * ab) / (aa * bb - ab * ab) / sa AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) / sb AS wb, my, ma, mb FROM sums CROSS JOIN moments"),
    ]
    saved = ", ".join(f"('{m}')" for m in ("Mean", "Ridge", "RandomForest", "GradientBoosting", "LogRidge"))
    width = f"(SELECT count(*) FROM ({_each('SELECT 1 FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL)', CATEGORICAL)}))"
    flags = f"(SELECT count(*) FROM ({_each('SELECT 1 FROM train HAVING count(*) > count({c})', NUMERIC)}))"
    columns = f"CAST(4 + {len(NUMERIC)} + {width} + {flags} AS BIGINT)"
    audit = []
    for side in ("train", "test"):
        audit += [
            f"SELECT '{side}_rows' AS metric, count(*) AS value FROM {side}",
            f"SELECT '{side}_missing_cells', 0",
            f"SELECT 'target_{side}_missing', count_if(LOS IS NULL) FROM {side}",
            f"SELECT '{side}_columns', {columns}",
            f"SELECT 'columns_only_in_{side}', 0",
            *[f"SELECT '{side}_has_{c}', 1" for c in (*ID_COLUMNS, TARGET)],
        ]
    importance = _importance_ctes()
    return {
        "prepared_cells": _cells_sql(),
        "float_export": _float_sql(),
        "audit_prepared": q.cte(*sides) + "SELECT metric, CAST(value AS DOUBLE) AS value FROM (" + " UNION ALL ".join(audit) + ")",
        "ridge_two": q.cte(*sides, *two)
        + f"SELECT feature, round(weight, 6) AS weight FROM (SELECT 'intercept' AS feature, my - wa * ma - wb * mb AS weight FROM beta UNION ALL SELECT '{x}', wa FROM beta UNION ALL SELECT '{y}', wb FROM beta)",
        "compare_two_tables": q.cte(*sides, *named) + ranked,
        "log_target_model": q.cte(*sides, *log_folds)
        + f"SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, round({log}, 6) AS prediction, (SELECT round(avg(mae), 6) FROM fold_metrics) AS cv_mae_mean FROM test",
        "saved_models": q.cte(*sides) + f"SELECT ICUSTAY_ID, model, true AS same FROM test CROSS JOIN (VALUES {saved}) m(model)",
        "importance_linear": q.cte(*sides, *importance)
        + "SELECT feature, round(importance_mean, 6) AS importance_mean, round(importance_std, 6) AS importance_std FROM importance",
        "published_results": q.cte(*sides, *both, *named, ("ranked", ranked), ("cv", f"SELECT 'Mean' AS model, {cv} FROM fold_metrics UNION ALL SELECT 'LogMean', {cv} FROM log_fold_metrics"), *importance)
        + """SELECT part, name, metric, CAST(value AS DOUBLE) AS value FROM (
SELECT 'cv_results' AS part, model AS name, 'cv_mae_mean' AS metric, cv_mae_mean AS value FROM cv UNION ALL SELECT 'cv_results', model, 'cv_r2_std', cv_r2_std FROM cv
UNION ALL SELECT 'test_results', model, 'MAE', MAE FROM ranked UNION ALL SELECT 'test_results', model, 'R2', R2 FROM ranked
UNION ALL SELECT 'comparison', model, 'rank', rank FROM ranked
UNION ALL SELECT 'importance', feature, 'importance_mean', round(importance_mean, 6) FROM importance
UNION ALL SELECT 'predictions', 'Mean', 'sum', round((SELECT avg(LOS) FROM train) * (SELECT count(*) FROM test), 5)
UNION ALL SELECT 'summary', 'train_rows', 'value', (SELECT count(*) FROM train) UNION ALL SELECT 'summary', 'test_rows', 'value', (SELECT count(*) FROM test)
UNION ALL SELECT 'summary', 'n_features', 'value', 2 UNION ALL SELECT 'summary', (SELECT model FROM ranked WHERE rank = 1), 'best_model', 1)""",
    }


def oracles() -> dict[str, str]:
    sides = _sides()
    mode = """SELECT '{c}' AS feature, (SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
  count(DISTINCT {c}) AS known_values FROM train"""
    hot = """SELECT s.side, concat('{c}_', v.v) AS feature, CAST(count_if(coalesce(s.{c}, m.mode) = v.v) AS BIGINT) AS rows
FROM sided s CROSS JOIN (SELECT DISTINCT {c} AS v FROM train WHERE {c} IS NOT NULL) v
CROSS JOIN (SELECT {c} AS mode FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) m GROUP BY ALL"""
    errors = """SELECT GENDER, LOS AS y, LOS - (SELECT avg(LOS) FROM train) AS e FROM test"""
    folds = [
        ("folded", f"SELECT *, {FOLD_SQL} AS fold FROM train"),
        ("fold_means", "SELECT f.fold, avg(t.LOS) AS mean FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold GROUP BY f.fold"),
        ("fold_errors", "SELECT fold, LOS AS y, LOS - mean AS e FROM folded JOIN fold_means USING (fold)"),
        (
            "fold_metrics",
            """SELECT fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
  CASE WHEN var_pop(y) > 0 THEN 1 - sum(e * e) / (var_pop(y) * count(*)) END AS r2, median(abs(e)) AS medae FROM fold_errors GROUP BY fold""",
        ),
    ]
    indicator = "SELECT 'missingindicator_{c}' AS feature FROM train HAVING count(*) > count({c})"
    names = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in NUMERIC)
    hot_names = _each("SELECT DISTINCT concat('{c}_', {c}) AS feature FROM train WHERE {c} IS NOT NULL", CATEGORICAL)
    scored = [
        ("constant", "SELECT 'Mean' AS model, avg(LOS) AS p FROM train UNION ALL SELECT 'Highest', max(LOS) FROM train"),
        ("errors", "SELECT model, LOS AS y, LOS - p AS e FROM test CROSS JOIN constant"),
        ("metrics", f"SELECT model, {_metric_sql()} FROM errors GROUP BY model"),
    ]
    return {
        **_replayed(sides, folds, scored),
        "ridge_gradient": q.cte(*sides)
        + f"SELECT feature, CAST(0 AS DOUBLE) AS slope FROM ({names} UNION ALL {_each(indicator, NUMERIC)} UNION ALL {hot_names})",
        "forest_bounds": q.cte(*sides) + "SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, round(LOS, 9) AS y_true, true AS inside FROM test",
        "compare_means": q.cte(*sides, *scored)
        + "SELECT model, CAST(row_number() OVER (ORDER BY MAE, model) AS INT) AS rank, MAE, RMSE, R2, MedianAE FROM metrics",
        "observed_vs_predicted": q.cte(*sides, *scored)
        + """SELECT ICUSTAY_ID, round(LOS, 9) AS y_true, round(p, 9) AS y_pred FROM test CROSS JOIN constant
WHERE model = (SELECT model FROM metrics ORDER BY MAE, model LIMIT 1)""",
        "group_split": q.cte(*sides) + "SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, side FROM sided",
        "leakage_check": q.cte(*sides)
        + fq._metrics(
            [
                ("train_subjects", "count(DISTINCT SUBJECT_ID)", "train"),
                ("train_stays", "count(DISTINCT ICUSTAY_ID)", "train"),
                ("test_subjects", "count(DISTINCT SUBJECT_ID)", "test"),
                ("test_stays", "count(DISTINCT ICUSTAY_ID)", "test"),
                ("subject_overlap", "count(DISTINCT SUBJECT_ID)", "train SEMI JOIN test USING (SUBJECT_ID)"),
                ("leaking_columns", "0", ""),
            ]
        ),
        "group_kfold": q.cte(*sides, folds[0])
        + """SELECT CAST(f.fold AS INT) AS fold, count_if(t.fold <> f.fold) AS train_rows, count_if(t.fold = f.fold) AS valid_rows,
  count(DISTINCT CASE WHEN t.fold <> f.fold THEN t.SUBJECT_ID END) AS train_subjects,
  count(DISTINCT CASE WHEN t.fold = f.fold THEN t.SUBJECT_ID END) AS valid_subjects, CAST(0 AS BIGINT) AS subject_overlap
FROM (SELECT DISTINCT fold FROM folded) f CROSS JOIN folded t GROUP BY f.fold""".replace(
            "count_if(t.fold <> f.fold) AS", "CAST(count_if(t.fold <> f.fold) AS BIGINT) AS"
        ).replace("count_if(t.fold = f.fold) AS", "CAST(count_if(t.fold = f.fold) AS BIGINT) AS"),
        "audit": _audit_sql(),
        "impute_median": q.cte(*sides)
        + _each(
            "SELECT '{c}' AS feature, round(median({c}), 6) AS median, CAST(count(*) - count({c}) AS BIGINT) AS missing FROM train",
            NUMERIC,
        ),
        "standard_scale": q.cte(*sides)
        + _each(
            """SELECT '{c}' AS feature, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std
FROM (SELECT CAST(coalesce({c}, (SELECT median({c}) FROM train)) AS DOUBLE) AS v FROM train)""",
            NUMERIC,
        ),
        "exact_split": q.cte(*sides, ("drawn", f"SELECT SUBJECT_ID, row_number() OVER (ORDER BY {HASH.format(salt='42')}, CAST(SUBJECT_ID AS VARCHAR)) AS place FROM (SELECT DISTINCT SUBJECT_ID FROM final_features)"))
        + """SELECT f.SUBJECT_ID, f.HADM_ID, f.ICUSTAY_ID, CASE WHEN d.place <= ceil(round(0.2 * (SELECT count(*) FROM drawn), 9)) THEN 'test' ELSE 'train' END AS side
FROM final_features f JOIN drawn d USING (SUBJECT_ID)""",
        "balanced_folds": _balanced_sql(sides),
        "impute_mode": q.cte(*sides) + _each(mode, CATEGORICAL),
        "one_hot": q.cte(*sides) + _each(hot, CATEGORICAL),
        "prepare": _prepare_sql(),
        "log_target": q.cte(*sides) + "SELECT ICUSTAY_ID, round(ln(1 + LOS), 9) AS log_los, round(LOS, 9) AS LOS FROM final_features",
        "model_mean": q.cte(*sides)
        + "SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, round(LOS, 9) AS y_true, round((SELECT avg(LOS) FROM train), 9) AS prediction FROM test",
        "regression_metrics": q.cte(*sides, ("errors", errors)) + f"SELECT GENDER, {_metric_sql()} FROM errors GROUP BY GENDER",
        "cv_mean": q.cte(*sides, *folds)
        + """SELECT 'Mean' AS model, round(avg(mae), 6) AS cv_mae_mean, round(stddev_pop(mae), 6) AS cv_mae_std,
  round(avg(rmse), 6) AS cv_rmse_mean, round(stddev_pop(rmse), 6) AS cv_rmse_std, round(avg(r2), 6) AS cv_r2_mean,
  round(stddev_pop(r2), 6) AS cv_r2_std, round(avg(medae), 6) AS cv_medae_mean FROM fold_metrics""",
    }
