"""Every registered query against its SQL, on the smallest test tables."""

import pytest
from check import connect, difference

import __spark_entry__ as entry
from txrisk import oracles as O

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(SQL) <= set(QUERIES)
    # the training-data queries without SQL are tested against plain versions
    assert set(QUERIES) - set(SQL) <= set(entry._training_data())


def test_filtered_months_have_gaps(spark):
    months = QUERIES["monthly_resample_filtered"](spark, "/root/testdata/sf0.01").collect()
    counts = [r["transaction_count"] for r in months]
    assert min(counts) == 0 < max(counts)


@pytest.mark.parametrize("name", list(SQL))
def test_equal(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", list(O.ORDER))
def test_order(spark, sf_dir, con, name):
    """The rows as they come, beside the SQL sorted by what the report is sorted by."""
    df = QUERIES[name](spark, sf_dir)
    columns = ", ".join(df.columns)
    result = con.execute(f"SELECT {columns} FROM ({SQL[name]}) ORDER BY {O.ORDER[name]}")
    assert [tuple(r) for r in df.collect()] == result.fetchall()


def test_entry(spark):
    got = entry.entry(spark).collect()
    assert sum(r["transaction_count"] for r in got) == 1468
    assert sum(r["flagged_count"] for r in got) == 30
