import pytest
from conftest import at

from staylens.operators import quality as ql
from staylens.plans import features as ft
from staylens.session import FINE_STAYS, fine_shuffles
from staylens.settings import CHART, LAB, OUTPUT, JoinLimits, Settings, TableGroup


@pytest.fixture(scope="module")
def tables(spark, stays_table):
    ts = at("2130-01-01 21:00:00")
    return {
        "icustays": stays_table,
        "chartevents": spark.createDataFrame(
            [(11, 1, ts, 5.0), (11, 1, at("2130-01-02 09:00:00"), 7.0), (12, 1, ts, 1.0), (12, 2, ts, 4.0), (31, 2, at("2130-06-01 01:00:00"), 3.0), (31, 2, at("2130-06-01 02:00:00"), 3.0)],
            "ICUSTAY_ID bigint, ITEMID bigint, CHARTTIME timestamp, VALUENUM double",
        ),
        "labevents": spark.createDataFrame(
            [(1, 90, ts, 1.5), (2, 90, at("2130-05-01 01:00:00"), 2.5)],
            "HADM_ID bigint, ITEMID bigint, CHARTTIME timestamp, VALUENUM double",
        ),
        "outputevents": spark.createDataFrame([], "ICUSTAY_ID bigint, ITEMID bigint, CHARTTIME timestamp, VALUE double"),
        "inputevents_cv": spark.createDataFrame([(11, 5, ts, 2.0)], "ICUSTAY_ID bigint, ITEMID bigint, CHARTTIME timestamp, AMOUNT double"),
        "inputevents_mv": spark.createDataFrame([(11, 5, ts, 4.0)], "ICUSTAY_ID bigint, ITEMID bigint, STARTTIME timestamp, AMOUNT double"),
        "prescriptions": spark.createDataFrame([(1, "Aspirin", None, ts), (1, None, None, ts)], "HADM_ID bigint, DRUG string, DRUG_NAME_GENERIC string, STARTDATE timestamp"),
    }


def rows_by_stay(run):
    return {r["ICUSTAY_ID"]: r.asDict() for r in run.features.collect()}


def test_five_tables(tables):
    run = ft.build_features(tables, "5")
    # Item 2 has most events although stay 31 has no target and is not a row.
    assert [(f.code, run.counts["chart", f.code]) for f in run.selected] == [("1", 3), ("2", 3)]
    rows = rows_by_stay(run)
    assert sorted(rows) == [11, 12]
    assert rows[11]["item_1_mean"] == 6.0 and rows[11]["item_1_last"] == 7.0 and rows[11]["item_1_count"] == 2
    assert rows[11]["item_2_count"] is None and rows[12]["item_2_std"] is None
    assert dict(run.features.dtypes)["item_1_count"] == "bigint"


def test_top_n_cut_and_given_codes(tables):
    one = ft.build_features(tables, "5", Settings(top_n_chart=1))
    assert [f.code for f in one.selected] == ["1"]
    given = ft.build_features(tables, "5", codes={"chart": [2]})
    assert sorted(rows_by_stay(given)) == [12] and "item_1_mean" not in given.features.columns


def test_seven_needs_chart_rows_and_more_does_not(tables):
    seven = rows_by_stay(ft.build_features(tables, "7"))
    assert sorted(seven) == [11, 12]
    assert seven[11]["lab_90_mean"] == seven[12]["lab_90_mean"] == 1.5
    more = ft.build_features(tables, "more")
    rows = rows_by_stay(more)
    assert sorted(rows) == [11, 12, 21]
    assert rows[21]["chart_1_mean"] is None and rows[21]["lab_90_mean"] == 2.5
    assert rows[11]["input_5_sum"] == 6.0 and rows[11]["input_5_mean"] == 3.0 and rows[11]["input_5_last"] == 4.0
    assert rows[11]["drug_aspirin_count"] == 1 and "drug_unknown_count" not in more.features.columns
    assert rows[11]["no_output_features"] is None and dict(more.features.dtypes)["no_output_features"] == "double"


def test_nothing_in_any_window(tables):
    empty = {**tables, "chartevents": tables["chartevents"].filter("false")}
    run = ft.build_features(empty, "5")
    assert run.features.count() == 0 and "no_chart_features" in run.features.columns


def test_shuffled_join_gives_the_same_table(tables):
    small = ft.build_features(tables, "more").features
    big = ft.build_features(tables, "more", Settings(limits=JoinLimits(broadcast_rows=0, hot_share=0.2))).features
    assert small.columns == big.columns and small.exceptAll(big).count() == 0 and big.count() == small.count()


def test_groups_without_families_hold_context_only(tables):
    stays = ft.build_features(tables, "stays")
    assert stays.selected == [] and sorted(rows_by_stay(stays)) == [11, 12, 21]
    assert not {"GENDER", "AGE", "INSURANCE"} & set(stays.features.columns)
    report = {r["metric"]: r["value"] for r in ql.quality_group(stays).collect()}
    assert report == {"window_hours": 24.0, "preprocessed_rows": 3.0}
    labs = rows_by_stay(ft.build_features(tables, "labs"))
    assert sorted(labs) == [11, 12, 21] and labs[21]["lab_90_mean"] == 2.5


def test_sweep_equals_single_runs(spark, tables):
    own = TableGroup("own", 6, (OUTPUT, LAB, CHART), False, "vital")
    groups = ["stays", "context", "labs", "5", "9", "inputs", own]
    runs = ft.sweep_features(tables, groups, [2, 24], [1, 25], Settings())
    assert len(runs) == 28
    lines = {(r["table_group"], r["window_hours"], r["top_n"]): r for r in ft.compare_sweep(spark, runs).collect()}
    assert len(lines) == 28
    for setting, run in runs.items():
        group = own if setting.group == "own" else setting.group
        single = ft.build_features(tables, group, Settings(window_hours=setting.window_hours, top_n_chart=setting.top_n))
        assert run.features.columns == single.features.columns, setting
        assert run.features.dtypes == single.features.dtypes, setting
        assert run.selected == single.selected and run.counts == single.counts
        assert run.features.exceptAll(single.features).count() == 0
        line = lines[setting.group, setting.window_hours, setting.top_n]
        checked = ft.feature_checksum(single.features).first()
        assert (line["rows"], line["cells"], line["checksum"]) == (single.features.count(), checked["cells"], checked["checksum"])


def test_checksum_sees_cells_not_order(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b"), (3, -1.25, None)], "ICUSTAY_ID bigint, x double, t string")
    base = ft.feature_checksum(df).first()
    assert (base["rows"], base["cells"]) == (3, 4)
    assert ft.feature_checksum(df.orderBy("x").select("t", "x", "ICUSTAY_ID")).first() == base
    others = [df.withColumnRenamed("x", "y"), df.withColumn("x", df.x + 0.01), df.withColumn("ICUSTAY_ID", df.ICUSTAY_ID + 1), df.replace("a", "c")]
    assert all(ft.feature_checksum(other).first()["checksum"] != base["checksum"] for other in others)
    assert ft.feature_checksum(df.filter("false")).first().asDict() == {"rows": 0, "cells": 0, "checksum": 0}


def test_quality_counts_reconcile(tables):
    run = ft.build_features(tables, "5")
    report = {r["metric"]: r["value"] for r in ql.quality_base(tables, run).collect()}
    parts = ("chartevents_before_intime", "chartevents_in_prediction_window", "chartevents_after_prediction_window")
    assert report["chartevents_linked_to_icustay"] == sum(report[p] for p in parts) == 6
    assert report["preprocessed_rows"] == 2 and report["icustays_after_target_filter"] == 3
    local = {r["metric"]: r["value"] for r in ql.quality_local(tables, run).collect()}
    assert local["icustays_without_chart_features"] == 1
    assert sum(m.startswith("missing_rate_top25.") for m in local) == min(25, int(local["model_feature_columns"]))


def test_group_reports(tables):
    sizes = {"7": 5, "9": 7, "more": 12}
    for group, size in sizes.items():
        report = ql.quality_group(ft.build_features(tables, group)).collect()
        assert len(report) == size


def test_published_run(spark, tables, tmp_path):
    run = ft.build_features(tables, "9")
    dims = {"d_items": spark.createDataFrame([(1, "Heart Rate", "Vitals", "bpm")], "ITEMID bigint, LABEL string, CATEGORY string, UNITNAME string")}
    ft.write_run(run, {**tables, **dims}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "features"))
    assert back.columns == run.features.columns and back.count() == 2
    codes = {r["ITEMID"]: r["LABEL"] for r in spark.read.parquet(str(tmp_path / "selected_chart")).collect()}
    assert codes == {1: "Heart Rate", 2: None}
    assert spark.read.parquet(str(tmp_path / "selected_drug")).first()["DRUG_NAMES"] == ["ASPIRIN"]
    report = spark.read.option("header", True).csv(str(tmp_path / "quality"))
    assert report.count() == 7


def test_duplicate_dimension_rows_are_refused_on_request(spark, tables):
    twice = spark.createDataFrame([(1, "F", at("2060-01-01 00:00:00"))] * 2, "SUBJECT_ID bigint, GENDER string, DOB timestamp")
    with pytest.raises(ValueError, match="PATIENTS"):
        ft.build_features({**tables, "patients": twice}, "5", validate=True)
    assert ft.build_features(tables, "5", validate=True).features.count() == 2


def test_sweep_lines_hold_no_plan_of_the_wide_tables(spark, tables):
    runs = ft.sweep_features(tables, ["5", "9"], [2, 24], [1, 25], Settings())
    lines = ft.compare_sweep(spark, runs)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count() == len(runs) and "Union" not in plan and "Join" not in plan


def test_statistics_are_dealt_by_the_number_of_stays(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    with fine_shuffles(spark, 1_000 * FINE_STAYS):
        assert [spark.conf.get(n) for n in names] == ["1000", "8m"]
    with pytest.raises(KeyError), fine_shuffles(spark, 1):
        assert spark.conf.get(names[0]) == before[0]
        raise KeyError
    assert [spark.conf.get(n) for n in names] == before
