"""Sources, slices and conformance on edge rows."""

import datetime as dt

from salesmart.operators.clean import conform
from salesmart.schema import SALES_COLUMNS
from salesmart.sources.slices import (filter_retailer, merge_windows, slice_fiscal_year,
                                      slice_month)


def test_retailer_predicate_case_rules(spark):
    names = ["HY-VEE FOOD STORE #1", "hy-vee #2", "Hy-Vee Wine & Spirits", "WALL TO WALL WINE AND SPIRITS #3",
             "wall to wall wine and spirits #4", "FAREWAY #5", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    kept = {r.name for r in filter_retailer(df).collect()}
    assert kept == {"HY-VEE FOOD STORE #1", "hy-vee #2", "Hy-Vee Wine & Spirits",
                    "WALL TO WALL WINE AND SPIRITS #3"}


def test_merge_windows_joins_adjacent_months():
    assert merge_windows([(1997, 12), (1998, 1), (1996, 2), (1997, 11), (1998, 1)]) == [
        ("1996-02-01", "1996-03-01"), ("1997-11-01", "1998-02-01")]
    assert merge_windows([]) == []


def test_month_and_fiscal_year_bounds(spark):
    days = [dt.date(1998, 6, 30), dt.date(1998, 7, 1), dt.date(1998, 12, 31), dt.date(1999, 1, 1),
            dt.date(1999, 6, 30), dt.date(1999, 7, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert [r.date for r in slice_month(df, 1998, 12).collect()] == [dt.date(1998, 12, 31)]
    fy = sorted(r.date for r in slice_fiscal_year(df, 1999).collect())
    assert fy == [dt.date(1998, 7, 1), dt.date(1998, 12, 31), dt.date(1999, 1, 1), dt.date(1999, 6, 30)]


def test_conform_flags_rows_that_do_not_convert(spark):
    good = ["A", "2024-01-02T00:00:00.000", "1", "N", "AD", "C", "50010", "CO", "1011100", "W", "3",
            "V", "12", "I", "750", "3.50", "5.25", "2"]
    bad = list(good)
    bad[0], bad[6], bad[15] = "B", "5OO10", "cheap"
    cols = ", ".join(f"{c} string" for c in SALES_COLUMNS)
    rows = {r.invoice_line_no: r for r in conform(spark.createDataFrame([tuple(good), tuple(bad)], cols)).collect()}
    assert rows["A"]._rejected is False and rows["A"].zipcode == 50010
    assert rows["B"]._rejected is True and rows["B"].zipcode is None and rows["B"].state_bottle_cost is None
