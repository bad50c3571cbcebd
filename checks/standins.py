"""Clinical tables derived from the driver's TPC-H-like star and event stream.

Every SELECT runs unchanged on Spark and DuckDB and uses all rows of the tables
it reads. A user is a patient and an admission, a user's week is a stay; users
0 to 2 have no patient row and no admission row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["events", "lineitem", "orders", "customer", "part"]

STANDINS: dict[str, str] = {
    "icustays": """
SELECT user_id AS SUBJECT_ID, user_id AS HADM_ID, user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID,
  CASE WHEN user_id % 2 = 0 THEN 'metavision' ELSE 'carevue' END AS DBSOURCE,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE concat('unit', CAST(user_id % 5 AS STRING)) END AS FIRST_CAREUNIT,
  concat('Unit', CAST((user_id + EXTRACT(week FROM ts)) % 4 AS STRING)) AS LAST_CAREUNIT,
  CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL '1' DAY AS INTIME,
  CASE WHEN user_id % 20 = 0 THEN NULL ELSE MAX(ts) + INTERVAL '2' DAY END AS OUTTIME,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(1.5 + user_id % 14 AS DOUBLE) END AS LOS
FROM events GROUP BY user_id, EXTRACT(week FROM ts), date_trunc('week', ts)""",
    "chartevents": """
SELECT user_id AS SUBJECT_ID, user_id AS HADM_ID, user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID,
  CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS ITEMID,
  ts AS CHARTTIME,
  CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS VALUENUM
FROM events""",
    "d_items": """
SELECT DISTINCT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS BIGINT) AS ITEMID,
  event_type AS LABEL, 'events' AS CATEGORY, 'unit' AS UNITNAME
FROM events WHERE event_type <> 'error'""",
    "patients": """
SELECT c_custkey + 3 AS SUBJECT_ID, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lower(c_mktsegment) END AS GENDER,
  CAST(DATE '1890-01-01' + CAST((c_custkey * 400) % 60000 AS INT) AS TIMESTAMP) AS DOB
FROM customer""",
    "admissions": """
SELECT CAST(FLOOR(o_custkey / 10) AS BIGINT) + 3 AS SUBJECT_ID, CAST(FLOOR(o_custkey / 10) AS BIGINT) + 3 AS HADM_ID,
  MIN(o_orderpriority) AS ADMISSION_TYPE, MAX(o_orderpriority) AS ADMISSION_LOCATION,
  CASE WHEN CAST(FLOOR(o_custkey / 10) AS BIGINT) % 4 = 0 THEN '' ELSE concat(' ', lower(MIN(o_orderstatus)), ' ') END AS INSURANCE,
  CASE WHEN CAST(FLOOR(o_custkey / 10) AS BIGINT) % 3 = 0 THEN NULL ELSE 'engl' END AS LANGUAGE,
  concat('r', CAST(COUNT(*) % 4 AS STRING)) AS RELIGION,
  lower(MAX(o_orderstatus)) AS MARITAL_STATUS,
  concat('group ', CAST(CAST(FLOOR(o_custkey / 10) AS BIGINT) % 6 AS STRING)) AS ETHNICITY,
  CASE WHEN CAST(FLOOR(o_custkey / 10) AS BIGINT) % 5 = 0 THEN NULL ELSE MIN(o_orderdate) END AS EDREGTIME,
  MIN(o_orderdate) + INTERVAL '5' HOUR AS EDOUTTIME,
  CASE WHEN CAST(FLOOR(o_custkey / 10) AS BIGINT) % 6 = 0 THEN 'x' ELSE CAST(COUNT(*) % 2 AS STRING) END AS HAS_CHARTEVENTS_DATA
FROM orders GROUP BY CAST(FLOOR(o_custkey / 10) AS BIGINT)""",
    "labevents": """
SELECT l_suppkey AS HADM_ID, CAST(l_quantity AS BIGINT) AS ITEMID,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST((l_orderkey * 7 + l_linenumber) % 720 AS INT) AS CHARTTIME,
  l_extendedprice AS VALUENUM
FROM lineitem""",
    "d_labitems": """
SELECT CAST(p_size AS BIGINT) + 3 AS ITEMID, MIN(p_name) AS LABEL, MIN(p_brand) AS FLUID, MIN(p_type) AS CATEGORY
FROM part GROUP BY p_size""",
    "outputevents": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(CASE event_type WHEN 'purchase' THEN 3 ELSE 5 END AS BIGINT) AS ITEMID,
  ts AS CHARTTIME, value AS VALUE
FROM events WHERE event_type IN ('purchase', 'error')""",
    "inputevents_cv": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(EXTRACT(hour FROM ts) AS BIGINT) AS ITEMID,
  ts AS CHARTTIME, value AS AMOUNT
FROM events WHERE event_type = 'view'""",
    "inputevents_mv": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(EXTRACT(hour FROM ts) AS BIGINT) AS ITEMID,
  ts AS STARTTIME, value AS AMOUNT
FROM events WHERE event_type <> 'view'""",
    "prescriptions": """
SELECT l_suppkey AS HADM_ID,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(' ', p_name, '-', p_type, '%') END AS DRUG,
  CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE p_brand END AS DRUG_NAME_GENERIC,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST((l_orderkey + l_linenumber) % 30 AS INT) AS STARTDATE
FROM lineitem JOIN part ON l_partkey = p_partkey""",
}


# Event tables with more codes than the limits select; many codes tie at the cut.
MANY_CODES = {
    "chartevents": """
SELECT user_id AS SUBJECT_ID, user_id AS HADM_ID, user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID,
  CAST(event_id % 97 AS BIGINT) AS ITEMID, ts AS CHARTTIME,
  CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS VALUENUM
FROM events""",
    "outputevents": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(event_id % 31 AS BIGINT) AS ITEMID, ts AS CHARTTIME, value AS VALUE
FROM events""",
    "inputevents_cv": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(event_id % 41 AS BIGINT) AS ITEMID, ts AS CHARTTIME, value AS AMOUNT
FROM events WHERE event_id % 2 = 0""",
    "inputevents_mv": """
SELECT user_id * 100 + EXTRACT(week FROM ts) AS ICUSTAY_ID, CAST(event_id % 43 AS BIGINT) AS ITEMID, ts AS STARTTIME, value AS AMOUNT
FROM events WHERE event_id % 2 = 1""",
}


def standin_tables(spark: SparkSession, sf_dir: str, variant: str | None = None) -> dict[str, DataFrame]:
    """Lazy clinical tables over ``sf_dir``; the session works in UTC.

    ``variant="many"`` reads the event tables with many codes.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
    texts = STANDINS | (MANY_CODES if variant == "many" else {})
    return {name: spark.sql(text) for name, text in texts.items()}
