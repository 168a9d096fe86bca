"""Dimensions, calendar, profiling operators and run log on small inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import calendar as cal
from salesmart.operators.model import dim_items, dim_stores, fact_transactions, latest_per_key
from salesmart.operators.profile import (derive_placeholders, describe, duplicate_stats,
                                         infer_numeric_types, key_collision_count, missing_values)
from salesmart.operators.quality import check_fk, check_not_null, update_from
from salesmart.operators.runlog import format_duration, new_records
from tests.test_load import frame, sales_row


def test_calendar_reference_range(spark):
    c = cal.calendar(spark, "2020-01-01", "2025-12-31")
    rows = c.orderBy("date_id").collect()
    assert len(rows) == 2192 and rows[0].date_id == 0 and rows[-1].date_id == 2191
    first = rows[0]
    assert (first.month, first.month_of_year, first.day, first.day_of_week, first.weekend,
            first.week_of_year, first.financial_year, first.financial_quarter) == \
        ("January", "01", "Wednesday", 4, "Weekday", "52", 2020, 3)
    assert rows[0].previous_day == dt.date(2019, 12, 31) and rows[0].next_day == dt.date(2020, 1, 2)
    assert c.select("date").distinct().count() == 2192


def test_calendar_for_covers_whole_years(spark):
    df = spark.createDataFrame([(dt.date(1999, 3, 4),), (dt.date(2001, 7, 8),)], "date date")
    c = cal.calendar_for(df)
    assert c.agg(F.min("date"), F.max("date")).first() == (dt.date(1999, 1, 1), dt.date(2001, 12, 31))


def test_latest_per_key_ties_are_deterministic(spark):
    rows = [sales_row("I2", dt.date(2024, 1, 5), name="B"), sales_row("I1", dt.date(2024, 1, 5), name="A"),
            sales_row("I0", dt.date(2024, 1, 1), name="OLD")]
    stores = dim_stores(frame(spark, rows)).collect()
    assert [(s.store_id, s.store_name, s.zipcode) for s in stores] == [(1, "B", "50010")]


def test_latest_per_key_hot_key(spark):
    # one key holds every row; the aggregate still returns one row with the latest payload
    df = spark.range(30000).select((F.lit(1)).alias("k"), F.col("id").alias("o"),
                                   (F.col("id") * 3).alias("p"))
    (row,) = latest_per_key(df, "k", ["o"], ["p"]).collect()
    assert row.p == 29999 * 3


def test_fk_check_reports_orphans(spark):
    sales = frame(spark, [sales_row("A", dt.date(2024, 1, 1)), sales_row("B", dt.date(2030, 1, 1))])
    fact = fact_transactions(sales)
    orphans = check_fk(fact, cal.calendar(spark, "2020-01-01", "2025-12-31"), "date", "date").collect()
    assert [(r.date, r.orphan_rows) for r in orphans] == [(dt.date(2030, 1, 1), 1)]
    assert check_fk(fact, dim_stores(sales), "store_id", "store_id").count() == 0
    assert check_fk(fact, dim_items(sales), "item_id", "item_id").count() == 0


def test_check_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {(r.column_name, r.null_rows) for r in check_not_null(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}


def test_update_from_keeps_or_nulls(spark):
    items = spark.createDataFrame([(1, 10, "old"), (2, 20, "old2"), (3, None, "x")],
                                  "item_id int, category_code int, label string")
    updates = spark.createDataFrame([(10, "new", "T"), (10, "new", "T")],
                                    "category_code int, label string, liquor_type string")
    out = {r.item_id: (r.label, r.liquor_type) for r in
           update_from(items, updates, "category_code", ["label", "liquor_type"]).collect()}
    assert out == {1: ("new", "T"), 2: ("old2", None), 3: ("x", None)}


def test_placeholder_derivation(spark):
    df = spark.createDataFrame([("12", "a"), ("345", "1"), ("999", None), ("88", None), ("7", None),
                                (None, None)], "n string, t string")
    got = {r.column_name: r.placeholder for r in derive_placeholders(df, ["n", "t"]).collect()}
    assert got == {"n": "99", "t": "UNKNOWN"}


def test_numeric_type_inference(spark):
    df = spark.createDataFrame([("1", "1.5", "1", "x", "NaN"), ("2.0", "2", None, "1", "1")],
                               "a string, b string, c string, d string, e string")
    got = {r.column_name: r.dtype for r in infer_numeric_types(df).collect()}
    assert got == {"a": "int", "b": "float"}


def test_describe_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    (r,) = describe(df, ["v"]).collect()
    assert (r["count"], r.p25, r.p50, r.p75, r.std, r["max"]) == \
        (4, Decimal("1.7500"), Decimal("2.5000"), Decimal("4.7500"), Decimal("4.0825"), Decimal("10.0000"))
    assert r.mean == Decimal("4.0000")


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    (s,) = duplicate_stats(df).collect()
    assert (s.n_rows, s.dup_rows, str(s.pct_dup)) == (5, 3, "60.0000")
    assert key_collision_count(df, "b").first()[0] == 5      # nulls collide too, as in pandas
    mv = missing_values(df).collect()
    assert [(r.column_name, r.missing_values, str(r.pct_of_total)) for r in mv] == [("b", 2, "40.0000")]


def test_format_duration(spark):
    df = spark.createDataFrame([(Decimal("2626.088"),), (Decimal("59.9996"),), (Decimal("90061.5"),)],
                               "s decimal(20,4)")
    assert [r[0] for r in df.select(format_duration(F.col("s"))).collect()] == \
        ["00:43:46.088", "00:00:60.000", "25:01:01.500"]   # seconds round up to 60, as divmod + %06.3f do


def test_new_records(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1), 100), (dt.datetime(2024, 2, 1), 130)],
                                "process_start_time timestamp_ntz, record_count long")
    assert [r.new_records_added for r in new_records(log).orderBy("process_start_time").collect()] == [0, 30]


def test_describe_approx_quartiles(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("int").alias("v"))
    exact = describe(df, ["v"]).first()
    approx = describe(df, ["v"], approx_accuracy=10000).first()
    assert exact.p50 == Decimal("500.5000")
    assert abs(approx.p50 - exact.p50) <= 1 and approx["count"] == 1000


def test_profile_raw_equals_the_separate_operators(spark):
    from salesmart import demo
    from salesmart.operators.clean import fill_placeholders
    from salesmart.operators.profile import profile_raw
    from tests.conftest import SF_SMALL
    raw = demo.raw_sales_view(spark, SF_SMALL)
    one = profile_raw(raw)

    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    assert rows(one["missing_values"]) == rows(missing_values(raw))
    assert rows(one["placeholders"]) == rows(derive_placeholders(raw))
    assert rows(one["numeric_types"]) == rows(infer_numeric_types(fill_placeholders(raw)))
    assert dict(rows(one["placeholders"]))["zipcode"] == "99999"


def test_update_from_with_a_hot_key(spark):
    # a third of the rows share one key; results equal a plain join
    rows = [(i, 7 if i % 3 == 0 else i, f"old{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "item_id int, category_code int, label string")
    updates = spark.createDataFrame([(7, "hot"), (4, "four"), (99999, "none")],
                                    "category_code int, label string")
    got = {r.item_id: r.label for r in update_from(df, updates, "category_code", ["label"]).collect()}
    assert len(got) == 3000
    assert got[0] == got[3] == "hot" and got[4] == "four" and got[5] == "old5"


def test_merged_dimensions_equal_a_rebuild(spark, tmp_dir):
    from salesmart.operators.model import update_dimensions
    day = dt.date
    other = sales_row("I3", day(2024, 2, 1), name="C")
    other = other[:12] + (77,) + other[13:]                                       # another item
    batches = [[sales_row("I1", day(2024, 1, 5), name="A"), sales_row("I2", day(2024, 1, 5), name="B")],
               [sales_row("I0", day(2023, 1, 1), name="LATE ARRIVAL")],           # older than what is stored
               [other],
               [other]]                                                           # repeated
    seen = []
    for batch in batches:
        seen += batch
        dims = update_dimensions(frame(spark, batch), tmp_dir)
        whole = frame(spark, seen)
        assert sorted(dims["stores"].collect()) == sorted(dim_stores(whole).collect())
        assert sorted(dims["items"].collect()) == sorted(dim_items(whole).collect())
    empty = update_dimensions(frame(spark, batches[0]).limit(0), tmp_dir)
    assert sorted(empty["stores"].collect()) == sorted(dim_stores(frame(spark, seen)).collect())


def test_refresh_that_fails_leaves_the_old_tables(spark, tmp_dir):
    import pytest
    from functools import partial
    from salesmart.sources.sinks import refresh_table, refresh_tables, write_checked
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    refresh_table(spark.range(3), a)
    refresh_table(spark.range(4), b)
    bad = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        refresh_tables(spark, {a: partial(write_checked, spark.range(9)), b: partial(write_checked, bad)})
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (3, 4)
    # a table may be refreshed from itself, and to nothing
    refresh_table(spark.read.parquet(a).union(spark.range(10, 12)), a)
    assert spark.read.parquet(a).count() == 5
    refresh_table(spark.range(0), b)
    assert spark.read.parquet(b).count() == 0


def test_interrupted_swap_is_mended(spark, tmp_dir):
    from salesmart.operators.quality import rename_table, table_exists
    from salesmart.sources.sinks import OLD, refresh_table, restore_table
    path = f"{tmp_dir}/t"
    refresh_table(spark.range(3), path)
    rename_table(spark, path, path + OLD)            # a run that ended between the two renames
    assert restore_table(spark, path) and not restore_table(spark, path)
    rename_table(spark, path, path + OLD)
    refresh_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and not table_exists(spark, path + OLD)
