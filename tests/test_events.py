import statistics

import pytest
from conftest import at
from pyspark.sql import functions as F

from staylens.operators import events as ev
from staylens.operators import joins
from staylens.operators import selection as sel
from staylens.operators.stays import stay_windows, unit_table
from staylens.settings import CHART, DRUG, LAB, JoinLimits

SHUFFLED = JoinLimits(broadcast_rows=0, hot_share=0.2)
RAW = "ICUSTAY_ID bigint, ITEMID bigint, CHARTTIME string, VALUENUM string"


@pytest.fixture(scope="module")
def windows(stays_table):
    return stay_windows(unit_table(stays_table), 24)


def chart(spark, rows):
    return ev.event_scan(spark.createDataFrame(rows, RAW), "ICUSTAY_ID", CHART.sources[0])


def test_dirty_values_and_times_are_dropped(spark):
    rows = [(11, 1, "2130-01-01 12:00:00", v) for v in ("abc", "", None, "NaN", "7.5")]
    rows += [(11, 1, "2130-02-30 1", "1"), (None, 1, "2130-01-01 12:00:00", "1"), (11, None, "2130-01-01 12:00:00", "1")]
    assert [r["VALUE"] for r in chart(spark, rows).collect()] == [7.5]


@pytest.mark.parametrize("limits", [JoinLimits(), SHUFFLED])
def test_window_is_closed_at_both_ends(spark, windows, limits):
    times = ["2130-01-01 10:00:00", "2130-01-02 10:00:00", "2130-01-01 09:59:59", "2130-01-02 10:00:01"]
    linked = ev.link_in_window(chart(spark, [(11, 1, t, "1") for t in times]), windows, "ICUSTAY_ID", limits)
    assert linked.count() == 2
    anytime = ev.link_any_time(chart(spark, [(11, 1, t, "1") for t in times]), windows, limits)
    assert anytime.count() == 4


@pytest.mark.parametrize("limits", [JoinLimits(), SHUFFLED])
def test_admission_link_fans_out_to_every_stay(spark, windows, limits):
    labs = spark.createDataFrame(
        [(1, 7, at("2130-01-01 21:00:00"), 1.0), (1, 7, at("2130-01-01 11:00:00"), 2.0), (9, 7, at("2130-01-01 11:00:00"), 2.0)],
        "HADM_ID bigint, ITEMID bigint, CHARTTIME timestamp, VALUENUM double",
    )
    linked = ev.link_in_window(ev.event_scan(labs, "HADM_ID", LAB.sources[0]), windows, "HADM_ID", limits)
    assert sorted((r["ICUSTAY_ID"], r["VALUE"]) for r in linked.collect()) == [(11, 1.0), (11, 2.0), (12, 1.0)]


def test_link_without_stays_is_empty(spark, stays_table):
    none = stay_windows(unit_table(stays_table.filter("false")), 24)
    assert ev.link_in_window(chart(spark, [(11, 1, "2130-01-01 12:00:00", "1")]), none, "ICUSTAY_ID").count() == 0


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 400).alias("k"), (F.col("id") % 7).alias("v")
    )
    copies = spark.range(3000).select(F.lit(1).cast("bigint").alias("k"), F.lit(5).cast("bigint").alias("v"))
    facts = facts.unionByName(copies)
    lookup = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert 1 in joins.hot_keys(facts, "k", 0.2)
    salted = joins.keyed_join(facts, lookup, ["k"], 300, SHUFFLED)
    plain = facts.join(lookup, "k")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.filter("k = 1").select(F.spark_partition_id()).distinct().count() > 1


def test_six_statistics(spark, windows):
    rows = [(11, 1, "2130-01-01 12:00:00", "3"), (11, 1, "2130-01-01 13:00:00", "5"), (11, 1, "2130-01-01 11:00:00", "10"), (11, 2, "2130-01-01 11:00:00", "4")]
    linked = ev.link_in_window(chart(spark, rows), windows, "ICUSTAY_ID")
    got = {r["ITEMID"]: r.asDict() for r in ev.event_stats(linked, CHART.stats).collect()}
    one = got[1]
    assert (one["mean"], one["min"], one["max"], one["count"], one["last"]) == (6.0, 3.0, 10.0, 3, 5.0)
    assert one["std"] == pytest.approx(statistics.stdev([3, 5, 10]))
    assert got[2]["std"] is None and got[2]["mean"] == got[2]["last"] == 4.0
    only = ev.event_stats(linked, ("count",), codes=[2]).collect()
    assert [(r["ITEMID"], r["count"]) for r in only] == [(2, 1)]


def test_last_value_prefers_the_larger_on_a_tie(spark, windows):
    for order in ([("1", "9", "3")], [("9", "3", "1")], [("3", "1", "9")]):
        rows = [(11, 1, "2130-01-01 12:00:00", v) for v in order[0]]
        linked = ev.link_in_window(chart(spark, rows), windows, "ICUSTAY_ID")
        assert ev.event_stats(linked, ("last",)).first()["last"] == 9.0


def test_merge_equals_direct_for_any_split(spark):
    values = spark.range(400).select(
        (F.col("id") % 5).alias("ICUSTAY_ID"),
        (F.col("id") % 3).alias("ITEMID"),
        F.timestamp_seconds(F.col("id") % 97).alias("EVENT_TIME"),
        (F.lit(1e9) + F.sin(F.col("id"))).alias("VALUE"),
        F.pmod(F.hash("id"), F.lit(6)).alias("part"),
    )
    keys = ["ICUSTAY_ID", "ITEMID"]
    merged = {tuple(r[k] for k in keys): r for r in ev.merge_stats(ev.summarise(values, [*keys, "part"]), keys).collect()}
    direct = ev.event_stats(values, ("mean", "min", "max", "std", "count", "sum", "last")).collect()
    assert len(direct) == len(merged) == 15
    for d in direct:
        m = merged[d["ICUSTAY_ID"], d["ITEMID"]]
        for exact in ("min", "max", "count", "last"):
            assert m[exact] == d[exact]
        assert m["mean"] == pytest.approx(d["mean"], rel=1e-14)
        assert m["std"] == pytest.approx(d["std"], rel=1e-6)


def test_top_codes_break_ties_by_the_lower_code(spark, windows):
    rows = [(11, c, "2130-01-01 12:00:00", "1") for c in (30, 20, 10, 10)]
    linked = ev.link_in_window(chart(spark, rows), windows, "ICUSTAY_ID")
    assert [(r["ITEMID"], r["event_count"]) for r in sel.top_codes(linked, 2).collect()] == [(10, 2), (20, 1)]


def test_top_drugs_need_a_name_and_show_five_spellings(spark, windows):
    names = [f"Drug-{c}" for c in "!?#%&*"] + [None]
    rows = [(1, n, None, at("2130-01-01 21:00:00")) for n in names]
    raw = spark.createDataFrame(rows, "HADM_ID bigint, DRUG string, DRUG_NAME_GENERIC string, STARTDATE timestamp")
    linked = ev.link_in_window(ev.drug_scan(raw, "HADM_ID", DRUG.sources[0]), windows, "HADM_ID")
    top = sel.top_drugs(linked, 10).collect()
    assert [(r["DRUG_KEY"], r["prescription_count"]) for r in top] == [("drug_drug_", 12)]
    assert top[0]["DRUG_NAMES"] == sorted(n.upper() for n in names if n)[:5]
    counts = {(r["ICUSTAY_ID"], r["DRUG_KEY"]): (r["count"], r["named"]) for r in ev.drug_counts(linked).collect()}
    assert counts[11, "drug_drug_"] == (6, 6) and counts[12, "drug_unknown"] == (1, 0)
