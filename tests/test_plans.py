"""Plan shape: pushdown, pruning, join strategy, partial aggregation."""

import contextlib
import io

from salesmart import demo
from salesmart.operators.load import first_per_key
from salesmart.operators.model import dim_stores
from salesmart.sources.slices import slice_month
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_month_slice_pushed_to_scan(spark):
    p = plan(slice_month(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
                         .withColumnRenamed("l_shipdate", "date"), 1998, 12))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_adapter_prunes_columns_and_does_not_shuffle_lineitem(spark):
    p = plan(demo.sales_view(spark, SF_SMALL).select("store", "sale_bottles"))
    assert "ReadSchema: struct<l_orderkey" not in p          # unused lineitem columns pruned
    assert "l_suppkey:bigint,l_quantity:double>" in p
    # small dimensions are broadcast at planning time; no exchange feeds the lineitem scan
    initial = p.split("== Initial Plan ==")[-1] if "Initial Plan" in p else p
    assert "SortMergeJoin" not in initial.split("\n\n")[0]


def test_dedupe_and_latest_reduce_before_the_shuffle(spark):
    sales = demo.sales_view(spark, SF_SMALL)
    # first row per key: a partial group limit runs before the exchange
    p = plan(first_per_key(sales))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange")      # listed below it = runs before it
    # latest row per store: a partial aggregate runs before the exchange
    p = plan(dim_stores(sales))
    assert "Window" not in p and p.count("Aggregate") >= 2 and "Exchange" in p


def test_layer_month_slice_prunes_partitions(spark, tmp_dir):
    from salesmart.operators.clean import clean_sales
    from salesmart.sources.layers import append_to_layer, create_layer, layer_months, read_layer
    path = f"{tmp_dir}/layer"
    create_layer(spark, path)
    append_to_layer(clean_sales(demo.raw_sales_view(spark, SF_SMALL)), path)
    sliced = layer_months(read_layer(spark, path), [(1998, 12)])
    p = plan(sliced)
    assert "PartitionFilters: [isnotnull(sale_month" in p and "1998-12" in p
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,1998-12-01)" in p
    assert sliced.count() == sliced.filter("date >= '1998-12-01' and date < '1999-01-01'").count() > 0


def test_skipped_report_joins_on_whole_rows(spark):
    from salesmart.operators.load import skipped_rows
    sales = demo.sales_view(spark, SF_SMALL)
    p = plan(skipped_rows(sales, sales.limit(0)))
    keys = [line for line in p.splitlines() if line.startswith("Left keys")]
    # the distinct rows meet the winners on every column (null-safe), not on the key alone
    assert any("sale_bottles" in line and "im_desc" in line for line in keys), keys


def test_window_table_prunes_month_folders(spark, tmp_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    from salesmart.operators.clean import clean_sales
    from salesmart.operators.windows import month_windows
    from salesmart.sources.layers import append_to_layer, layer_windows, read_layer
    append_to_layer(clean_sales(demo.raw_sales_view(spark, SF_SMALL)), f"{tmp_dir}/layer")
    marks = spark.range(1).select(F.lit(dt.date(1998, 3, 9)).alias("high_water_mark"))
    marks.write.parquet(f"{tmp_dir}/marks")
    windows = month_windows(spark.read.parquet(f"{tmp_dir}/marks"), F.lit(dt.date(1998, 7, 2)))
    layer = read_layer(spark, f"{tmp_dir}/layer")
    due = layer_windows(layer, windows.union(windows))
    assert "dynamicpruning" in plan(due)
    expected = layer.filter("date >= '1998-04-01' and date < '1998-07-01'")
    assert due.count() == expected.count() > 0 and due.exceptAll(expected.select(due.columns)).isEmpty()


def test_each_raw_number_is_tested_once(spark):
    from salesmart.operators.clean import clean_sales, typed_with_rejects
    from salesmart.schema import NUMERIC_TYPES
    raw = demo.raw_sales_view(spark, SF_SMALL)
    for df in (clean_sales(raw), typed_with_rejects(raw).filter("reject_reason is null and positive_money")):
        assert plan(df).count("RLIKE") == len(NUMERIC_TYPES)
