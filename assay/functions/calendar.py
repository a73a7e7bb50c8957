"""Dates: the fiscal calendar, and the UTC day of an offset timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4
SECONDS_PER_DAY = 86400


def fiscal_year(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """The calendar year in which the fiscal year of ``day`` ends."""
    return F.year(F.add_months(day, (13 - start_month) % 12))


def fiscal_quarter(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.quarter(F.add_months(day, 1 - start_month))


def fiscal_year_label(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """``FY27`` for any day of the fiscal year ending in 2027."""
    return F.format_string("FY%02d", F.pmod(fiscal_year(day, start_month), F.lit(100)))


def fiscal_quarter_label(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """``FY27 Q2``."""
    return F.format_string(
        "FY%02d Q%d",
        F.pmod(fiscal_year(day, start_month), F.lit(100)),
        fiscal_quarter(day, start_month),
    )


def utc_date(timestamp_text: Column) -> Column:
    """UTC calendar day of an ISO timestamp carrying its own offset; NULL if malformed.

    Counted from the instant, so the answer does not hang on the session time zone
    when the text carries an offset.
    """
    seconds = F.unix_seconds(F.try_to_timestamp(timestamp_text))
    days = F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def is_weekday(day: Column) -> Column:
    return ~F.dayofweek(day).isin(1, 7)
