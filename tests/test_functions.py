import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.functions import calendar, text
from assay.types import catalogue_type, money, share
from conftest import rows


@pytest.mark.parametrize(
    "native, expected",
    [
        ("decimal(19,4)", "DECIMAL"),
        ("numeric(10,2)", "DECIMAL"),
        ("float", "DOUBLE"),
        ("double", "DOUBLE"),
        ("bigint", "INT"),
        ("smallint", "INT"),
        ("datetime2", "TIMESTAMP"),
        ("timestamp_ntz", "TIMESTAMP"),
        ("date", "DATE"),
        ("bit", "BOOLEAN"),
        ("boolean", "BOOLEAN"),
        ("nvarchar(50)", "STRING"),
        ("array<float>", "STRING"),
    ],
)
def test_catalogue_type(native, expected):
    assert catalogue_type(native) == expected


@pytest.mark.parametrize("column", ["FiscalYearLabel", "RevenueUsd", "Country", "RevenueAtCarriedRate"])
def test_names_survive_the_round_trip(column):
    assert text.pascal_case(text.snake_case(column)) == column


def test_email_conform(spark):
    df = spark.createDataFrame([(" Ann@X.com ",), ("ann@x.com",), ("  ",), (None,)], "email string")
    assert rows(df.select(text.conform_email(F.col("email")))) == rows(
        spark.createDataFrame([("ann@x.com",), ("ann@x.com",), (None,), (None,)], "email string")
    )


def test_fiscal_labels_on_both_sides_of_the_boundaries(spark):
    days = [(dt.date(2026, 6, 30),), (dt.date(2026, 7, 1),), (dt.date(2026, 3, 31),), (dt.date(2026, 4, 1),)]
    df = spark.createDataFrame(days, "day date")
    found = [r[0] for r in df.select(calendar.fiscal_quarter_label(F.col("day"))).collect()]
    assert found == ["FY27 Q1", "FY27 Q2", "FY26 Q4", "FY27 Q1"]


def test_fiscal_year_starting_in_january_is_the_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2026, 12, 31),)], "day date")
    found = df.select(
        calendar.fiscal_year(F.col("day"), 1), calendar.fiscal_quarter(F.col("day"), 1)
    ).collect()
    assert [tuple(r) for r in found] == [(2026, 1), (2026, 4)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_utc_date_honours_the_offset_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [("2026-07-01T02:30:00+05:30",), ("2026-06-30T20:00:00-08:00",), ("not a time",)], "t string"
        )
        found = [r[0] for r in df.select(calendar.utc_date(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [dt.date(2026, 6, 30), dt.date(2026, 7, 1), None]


def test_utc_date_before_1970(spark):
    df = spark.createDataFrame([("1969-12-31T23:00:00+00:00",)], "t string")
    assert df.select(calendar.utc_date(F.col("t"))).first()[0] == dt.date(1969, 12, 31)


def test_money_is_exact_and_null_where_it_does_not_parse(spark):
    df = spark.createDataFrame([("12.50",), ("$3",), (None,)], "t string").select(money("t").alias("m"))
    assert [r[0] for r in df.collect()] == [Decimal("12.5000"), None, None]
    assert dict(df.dtypes)["m"] == "decimal(19,4)"


def test_share_is_blank_on_zero(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(3)), (Decimal(1), Decimal(0))], "a decimal(19,4), b decimal(19,4)")
    assert [r[0] for r in df.select(share("a", "b")).collect()] == [Decimal("0.333333333"), None]
