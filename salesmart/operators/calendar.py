"""Calendar dimension: day series, date attributes, fiscal periods.

A calendar has one row per day, so it is small whatever the fact size (36,525 rows for a
century). It is generated with ``spark.range`` or a ``sequence`` over the covered span;
the span can be fixed or derived from the fact's dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import fiscal_quarter, fiscal_year, sunday_week
from salesmart.schema import CALENDAR_END, CALENDAR_START, FISCAL_START_MONTH


def number_series(spark: SparkSession, n: int) -> DataFrame:
    """Integers 0 .. n-1 as ``number`` (bigint)."""
    return spark.range(n).select(F.col("id").alias("number"))


def day_offsets(df: DataFrame, col: str = "date") -> DataFrame:
    """Integers 0 .. (days spanned by ``col``) - 1: one number per day from the first to the
    last date in the data."""
    span = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return span.select(F.explode(F.sequence(F.lit(0), F.datediff("hi", "lo"))).alias("number")) \
               .select(F.col("number").cast("long").alias("number"))


def date_series(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Days from ``start`` to ``end`` inclusive; ``date_id`` is the day offset from start."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    n = (last - first).days + 1
    return spark.range(max(n, 0)).select(
        F.col("id").alias("date_id"), F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def covering_date_series(df: DataFrame, col: str = "date") -> DataFrame:
    """Days of every whole calendar year that holds a date of ``col``."""
    span = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    bounds = span.select(F.trunc("lo", "year").alias("start"),
                         F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("end"))
    days = bounds.select("start", F.explode(F.sequence("start", "end")).alias("date"))
    return days.select(F.datediff("date", "start").cast("long").alias("date_id"), "date")


def calendar_attributes(df: DataFrame, col: str = "date") -> DataFrame:
    """Year, month name and number, day of month, weekday name and number (1 = Sunday),
    weekend flag, day of year, Sunday-based week, quarter, previous and next day."""
    d = F.col(col)
    day_name = F.date_format(d, "EEEE")
    attrs: dict[str, Column] = {
        "year": F.year(d),
        "month": F.date_format(d, "MMMM"),
        "month_of_year": F.date_format(d, "MM"),
        "day_of_month": F.dayofmonth(d),
        "day": day_name,
        "day_of_week": F.dayofweek(d),
        "weekend": F.when(day_name.isin("Saturday", "Sunday"), F.lit("Weekend"))
                    .otherwise(F.lit("Weekday")),
        "day_of_year": F.dayofyear(d),
        "week_of_year": sunday_week(d),
        "quarter": F.quarter(d),
        "previous_day": F.date_sub(d, 1),
        "next_day": F.date_add(d, 1),
    }
    return df.select("*", *[v.alias(k) for k, v in attrs.items()])


def fiscal_columns(df: DataFrame, col: str = "date", start_month: int = FISCAL_START_MONTH) -> DataFrame:
    return df.select("*", fiscal_year(F.col(col), start_month).alias("financial_year"),
                     fiscal_quarter(F.col(col), start_month).alias("financial_quarter"))


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
             start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Full calendar dimension over a fixed range."""
    return fiscal_columns(calendar_attributes(date_series(spark, start, end)), start_month=start_month)


def calendar_for(df: DataFrame, col: str = "date", start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Full calendar dimension over the whole years the data covers."""
    return fiscal_columns(calendar_attributes(covering_date_series(df, col)), start_month=start_month)
