import pytest
from conftest import at
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.operators.stays import assert_unique, context_features, stay_windows, unit_table


def test_los_given_derived_or_missing(spark, stays_table):
    got = {r["ICUSTAY_ID"]: r["LOS"] for r in unit_table(stays_table).collect()}
    assert got == {11: 2.5, 12: 1.5, 21: 1.5, 31: None}


def test_stay_without_target_leaves_only_the_features(spark, stays_table):
    stays = unit_table(stays_table)
    assert stay_windows(stays, 24).rows == 4
    assert sorted(r["ICUSTAY_ID"] for r in context_features(stays).collect()) == [11, 12, 21]


def test_required_columns(spark, stays_table):
    with pytest.raises(ValueError, match="INTIME"):
        unit_table(stays_table.drop("INTIME"))
    with pytest.raises(ValueError, match="LOS or OUTTIME"):
        unit_table(stays_table.drop("LOS", "OUTTIME"))


def test_strip_trims_every_kind_of_blank(spark):
    texts = ["\tUrgent\r\n", "\u00a0new \u2003born\x0b", "\n\t ", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string").select(fn.category(F.col("c"), "strip").alias("c"))
    assert [r["c"] for r in df.collect()] == [(t or "").strip().upper() or "UNKNOWN" for t in texts]


@pytest.mark.parametrize(
    "mode, expected",
    [("plain", [" EMERGENCY ", "", "UNKNOWN"]), ("strip", ["EMERGENCY", "UNKNOWN", "UNKNOWN"])],
)
def test_category_modes(spark, mode, expected):
    df = spark.createDataFrame([(0, " emergency "), (1, ""), (2, None)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(fn.category(F.col("c"), mode)).collect()]
    assert got == expected


@pytest.mark.parametrize(
    "birth, boundary, exact",
    [
        ("2060-06-02 00:00:00", 70, 69),  # birthday not reached
        ("2060-06-01 00:00:00", 70, 70),
        ("2009-01-01 00:00:00", 90, 90),  # 121 years
        ("2131-01-01 00:00:00", None, None),  # born after entry
        ("2129-12-31 00:00:00", 1, 0),
        (None, None, None),
    ],
)
def test_ages(spark, birth, boundary, exact):
    df = spark.createDataFrame([(at(birth) if birth else None, at("2130-06-01 00:00:00"))], "b timestamp, t timestamp")
    row = df.select(
        fn.age_year_boundary(F.to_date("b"), F.to_date("t")), fn.age_exact(F.to_date("b"), F.to_date("t"))
    ).first()
    assert tuple(row) == (boundary, exact)


def test_drug_key(spark):
    df = spark.createDataFrame(
        [(" 5% Dextrose (EXCEL BAG)", None), (None, "Aspirin"), (None, None), ("x" * 200, None)], "d string, g string"
    )
    name = fn.drug_name(F.col("d"), F.col("g"))
    got = [tuple(r) for r in df.select(name, fn.drug_key(name)).collect()]
    assert got[0] == ("5% DEXTROSE (EXCEL BAG)", "drug_5_dextrose_excel_bag_")
    assert got[1] == ("ASPIRIN", "drug_aspirin")
    assert got[2] == ("UNKNOWN", "drug_unknown")
    assert len(got[3][1]) == 100


def test_context_without_dimension_row_is_null(spark, stays_table):
    patients = spark.createDataFrame([(1, None, at("2060-01-01 00:00:00"))], "SUBJECT_ID bigint, GENDER string, DOB timestamp")
    admissions = spark.createDataFrame(
        [(1, 1, " emergency ", at("2130-01-01 00:00:00"), at("2130-01-01 01:30:00"), "x")],
        "SUBJECT_ID bigint, HADM_ID bigint, ADMISSION_TYPE string, EDREGTIME timestamp, EDOUTTIME timestamp, HAS_CHARTEVENTS_DATA string",
    )
    rows = {r["ICUSTAY_ID"]: r for r in context_features(unit_table(stays_table), patients, admissions).collect()}
    assert rows[11]["GENDER"] == "UNKNOWN" and rows[11]["AGE"] == 70
    assert rows[11]["ADMISSION_TYPE"] == " EMERGENCY " and rows[11]["ED_LOS_HOURS"] == 1.5
    assert rows[11]["HAS_CHARTEVENTS_DATA"] is None
    assert rows[21]["GENDER"] is None and rows[21]["AGE"] is None and rows[21]["ADMISSION_TYPE"] is None
    assert rows[21]["DBSOURCE"] == "UNKNOWN" and rows[12]["FIRST_CAREUNIT"] == "UNKNOWN"


def test_duplicate_dimension_is_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "SUBJECT_ID bigint")
    with pytest.raises(ValueError, match="PATIENTS"):
        assert_unique(df, ["SUBJECT_ID"], "PATIENTS")
    assert_unique(df.distinct(), ["SUBJECT_ID"], "PATIENTS")
