"""End-to-end: land raw records, load both layers incrementally, build the mart, log runs."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart import demo
from salesmart.operators.clean import clean_sales, loadable_rows, typed_with_rejects
from salesmart.operators.windows import month_list
from salesmart.plans.workflow import build_mart, log_run, run_incremental
from salesmart.schema import RAW_SALES_SCHEMA, SALES_COLUMNS
from salesmart.sources.layers import read_layer
from tests.conftest import SF_SMALL


def _record(**changes):
    row = dict.fromkeys(SALES_COLUMNS, "1") | {
        "invoice_line_no": "INV-1", "date": "2024-01-05T00:00:00.000", "name": "HY-VEE #1",
        "state_bottle_cost": "1.10", "state_bottle_retail": "2.20", "sale_bottles": "12"}
    return tuple((row | changes)[c] for c in SALES_COLUMNS)


def test_money_is_tested_before_it_is_rounded(spark):
    raw = spark.createDataFrame([
        _record(invoice_line_no="sub-cent", state_bottle_cost="0.004"),
        _record(invoice_line_no="whole", sale_bottles="12.0"),
        _record(invoice_line_no="cut", sale_bottles="12.7"),
        _record(invoice_line_no="less than one", sale_bottles="0.7"),
        _record(invoice_line_no="zero", state_bottle_cost="0.00"),
        _record(invoice_line_no="negative", state_bottle_retail="-0.004"),
        _record(invoice_line_no="no cost", state_bottle_cost=None),
        _record(invoice_line_no="no date", date="soon")], RAW_SALES_SCHEMA)
    want = {"sub-cent": ("0.00", 12), "whole": ("1.10", 12), "cut": ("1.10", 12)}
    for kept in (clean_sales(raw), loadable_rows(typed_with_rejects(raw))):
        assert {r.invoice_line_no: (str(r.state_bottle_cost), r.sale_bottles) for r in kept.collect()} == want


def test_load_accounts_for_every_record_and_repeats_alike(spark, tmp_dir):
    rows = [_record(), _record(), _record(state_bottle_cost="9.99"), _record(invoice_line_no=None),
            _record(invoice_line_no="bad", date="soon"), _record(invoice_line_no="free", sale_bottles="0"),
            _record(invoice_line_no="other", name="SOME STORE")]
    spark.createDataFrame(rows, RAW_SALES_SCHEMA).write.json(f"{tmp_dir}/landing")
    for inserted in (1, 0):
        run_incremental(spark, f"{tmp_dir}/landing", tmp_dir, dt.date(2024, 2, 5), f"{tmp_dir}/scratch",
                        months=[(2024, 1)]).collect()
        rejects = {r.reject_reason for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()}
        assert rejects == {"missing invoice_line_no", "unparseable date"}
        skipped = spark.read.parquet(f"{tmp_dir}/skipped").agg(F.sum("copies")).first()[0]
        assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 2
        # seven records: two rejects, one not positive, one of another retailer, the rest loaded or reported
        assert skipped + inserted == 3
        assert read_layer(spark, f"{tmp_dir}/stg/sales").count() == 1


def test_backfill_resume_model_and_log(spark, tmp_dir):
    raw = demo.raw_sales_view(spark, SF_SMALL).withColumn("sale_month", F.substring("date", 1, 7))
    landing = f"{tmp_dir}/landing"
    raw.write.partitionBy("sale_month").json(landing)
    clean = clean_sales(demo.raw_sales_view(spark, SF_SMALL))
    first, last = clean.agg(F.min("date"), F.max("date")).first()
    run_date = dt.date(last.year + (last.month == 12), last.month % 12 + 1, 5)

    # first run: empty layers -> fiscal years back from the run date, complete months only
    base = f"{tmp_dir}/layers"
    months = month_list(None, run_date)
    loaded = {r.layer: r for r in run_incremental(spark, landing, base, run_date, f"{tmp_dir}/b1",
                                                  month_col="sale_month").collect()}
    lo = dt.date(months[0][0], months[0][1], 1)
    expected = clean.filter((F.col("date") >= F.lit(lo))).select("invoice_line_no").distinct().count()
    assert loaded["staging"].rows_before == 0
    assert loaded["staging"].rows_after == loaded["integration"].rows_after == expected

    # a backfill of every month only adds the keys not stored yet
    all_months = sorted({(d.year, d.month) for (d,) in clean.select("date").distinct().collect()})
    again = {r.layer: r for r in run_incremental(spark, landing, base, run_date, f"{tmp_dir}/b2",
                                                 month_col="sale_month", months=all_months).collect()}
    total = clean.select("invoice_line_no").distinct().count()
    assert again["staging"].rows_before == expected and again["staging"].rows_after == total

    # a resume run right after has nothing due
    resume = run_incremental(spark, landing, base, run_date, f"{tmp_dir}/b3", month_col="sale_month")
    assert all(r.rows_before == r.rows_after == total for r in resume.collect())

    # keys are unique in both layers
    for layer in ("stg", "int"):
        t = spark.read.parquet(f"{base}/{layer}/sales")
        assert t.count() == t.select("invoice_line_no").distinct().count() == total

    counts = {r.table_name: r.n_rows for r in
              build_mart(spark.read.parquet(f"{base}/int/sales"), f"{tmp_dir}/mart").collect()}
    assert counts["transactions"] == total
    assert counts["fk_store"] == counts["fk_item"] == counts["fk_date"] == 0
    fact = spark.read.parquet(f"{tmp_dir}/mart/transactions")
    assert "margin" in fact.columns and fact.filter(F.col("revenue").isNull()).count() == 0
    stores = spark.read.parquet(f"{tmp_dir}/mart/stores")
    assert stores.filter(F.col("store_format").isNull() | F.col("full_address").isNull()).count() == 0

    # two logged runs: the second reports the growth since the first
    start = dt.datetime(2024, 3, 20, 22, 57, 44)
    log_run(spark, f"{base}/stg/sales", f"{tmp_dir}/log", start, start + dt.timedelta(seconds=61.5))
    log = log_run(spark, f"{base}/stg/sales", f"{tmp_dir}/log", start + dt.timedelta(days=1),
                  start + dt.timedelta(days=1, seconds=2626.088)).orderBy("process_start_time").collect()
    assert [r.new_records_added for r in log] == [0, 0]
    assert [r.total_duration for r in log] == ["00:01:01.500", "00:43:46.088"]
    assert log[0].data_start_date == first
