"""Every registered query against its SQL, and the driver's contract."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as contract
from assay.plans.feeds import TABLES
from assay.plans.oracle import ORACLE
from assay.plans.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"column_profile_approx"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    return value.isoformat() if isinstance(value, datetime.datetime) else repr(value)


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_only_sketches_lack_sql():
    assert set(REGISTRY) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(REGISTRY) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_answers(spark):
    assert contract.entry(spark).columns == ["fiscal_quarter", "region", "revenue", "cancelled_revenue", "sale_lines"]


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


def test_estimates_are_close_to_exact_counts(spark, db):
    estimates = contract.queries()["column_profile_approx"](spark, FOLDER).where("table_name = 'lineitem'")
    for row in estimates.collect():
        exact = db.execute(f"SELECT count(DISTINCT {row.column_name}) FROM lineitem").fetchall()[0][0]
        assert abs(row.approx_distinct - exact) <= max(2, 0.08 * exact), row
