"""Registered queries with SQL give the same rows on both engines."""

import pandas as pd
import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR)
    left = pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns, dtype=object)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    right = pd.DataFrame(result.fetchall(), columns=columns, dtype=object)
    assert compare(left, right) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
