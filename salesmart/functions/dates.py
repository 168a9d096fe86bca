"""Date functions: API text parsing, MySQL-style week numbers, fiscal periods, month bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_api_date(c: Column) -> Column:
    """Timestamp text (padded or unpadded month/day, optional time) to a date; junk -> null."""
    return F.to_date(F.try_to_timestamp(c))


def sunday_week(d: Column) -> Column:
    """Week of year 01-53 with Sunday as first day; days before the year's first Sunday
    belong to the last week of the previous year (MySQL ``%V``)."""
    sunday = F.date_sub(d, F.dayofweek(d) - 1)
    week = F.floor((F.dayofyear(sunday) - 1) / 7) + 1
    return F.lpad(week.cast("string"), 2, "0")


def fiscal_year(d: Column, start_month: int = 7) -> Column:
    """Fiscal year named by its end: with a July start, 2023-07-01 is in FY 2024."""
    if start_month == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)


def fiscal_quarter(d: Column, start_month: int = 7) -> Column:
    """Quarter 1-4 counted from the fiscal start month."""
    return (F.pmod(F.month(d) - start_month, F.lit(12)) / 3).cast("int") + 1


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def fiscal_year_start(fy: int, start_month: int = 7) -> str:
    """First day of fiscal year ``fy`` as ISO text."""
    if start_month == 1:
        return f"{fy:04d}-01-01"
    return f"{fy - 1:04d}-{start_month:02d}-01"


def month_bounds(year: int, month: int) -> tuple[str, str]:
    """Half-open [first day, first day of next month) as ISO text; December rolls over."""
    start = f"{year:04d}-{month:02d}-01"
    end = f"{year + 1:04d}-01-01" if month == 12 else f"{year:04d}-{month + 1:02d}-01"
    return start, end
