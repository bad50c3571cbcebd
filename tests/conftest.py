import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staylens.session import build_session, drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


def at(text):
    return datetime.fromisoformat(text)


STAY_SCHEMA = (
    "SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, DBSOURCE string, FIRST_CAREUNIT string, "
    "LAST_CAREUNIT string, INTIME timestamp, OUTTIME timestamp, LOS double"
)


@pytest.fixture(scope="session")
def stays_table(spark):
    """Stay 11 and 12 share admission 1; stay 31 has neither LOS nor exit."""
    rows = [
        (1, 1, 11, "carevue", " micu ", "SICU", at("2130-01-01 10:00:00"), at("2130-01-04 10:00:00"), 2.5),
        (1, 1, 12, "carevue", None, "SICU", at("2130-01-01 20:00:00"), at("2130-01-03 08:00:00"), None),
        (2, 2, 21, None, "", "MICU", at("2130-05-01 00:00:00"), at("2130-05-02 12:00:00"), None),
        (3, 3, 31, "metavision", "CCU", "CCU", at("2130-06-01 00:00:00"), None, None),
        (4, 4, None, "metavision", "CCU", "CCU", at("2130-06-01 00:00:00"), None, 1.0),
        (5, 5, 51, "metavision", "CCU", "CCU", None, None, 1.0),
    ]
    return spark.createDataFrame(rows, STAY_SCHEMA)
