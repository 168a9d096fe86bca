"""Insert-if-absent loading, skipped report, layers, incremental windows, streaming."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from salesmart.operators.clean import clean_sales, fill_placeholders
from salesmart.operators import load
from salesmart.operators.load import append_new, first_per_key, load_layers, skipped_rows
from salesmart.operators.quality import create_layers
from salesmart.operators.windows import high_water_mark, month_list, month_windows
from salesmart.plans.workflow import load_records, run_id, run_incremental
from salesmart.schema import DIMENSION_COLUMNS, SALES_COLUMNS, SALES_SCHEMA
from salesmart.sources.layers import read_layer
from salesmart.sources.ledger import Ledger
from salesmart.sources.raw import read_landing
from salesmart.streaming.incremental import run_incremental_stream


def sales_row(key, day, name="HY-VEE #1", bottles=2):
    return (key, day, 1, name, "1 MAIN ST", "AMES", 50010, "STORY", 1011100, "WHISKEY", 10,
            "V", 100, "ITEM", 750, None, None, bottles)


def frame(spark, rows):
    from decimal import Decimal
    rows = [r[:15] + (Decimal("3.50"), Decimal("5.25")) + r[17:] for r in rows]
    return spark.createDataFrame(rows, SALES_SCHEMA)


def test_key_twice_in_batch_and_once_stored(spark):
    stored = frame(spark, [sales_row("A", dt.date(2024, 1, 1))])
    batch = frame(spark, [sales_row("A", dt.date(2024, 2, 1)), sales_row("A", dt.date(2024, 2, 2)),
                          sales_row("B", dt.date(2024, 2, 3), bottles=1),
                          sales_row("B", dt.date(2024, 2, 1), bottles=9)])
    inserted = append_new(batch, stored).collect()
    assert [(r.invoice_line_no, r.date, r.sale_bottles) for r in inserted] == [("B", dt.date(2024, 2, 1), 9)]
    skipped = {(r.invoice_line_no, r.date, r.copies, r.reason) for r in skipped_rows(batch, stored).collect()}
    assert skipped == {("A", dt.date(2024, 2, 1), 1, "key already stored"),
                       ("A", dt.date(2024, 2, 2), 1, "duplicate key in batch"),
                       ("B", dt.date(2024, 2, 3), 1, "duplicate key in batch")}


def test_every_batch_row_accounted_for_with_hot_copies(spark):
    # one key holds a third of the batch, as identical copies
    rows = [sales_row("HOT", dt.date(2024, 3, 1))] * 300 + \
           [sales_row(f"K{i}", dt.date(2024, 3, 1 + i % 20)) for i in range(600)]
    batch = frame(spark, rows)
    empty = spark.createDataFrame([], SALES_SCHEMA)
    inserted = append_new(batch, empty).count()
    skipped = skipped_rows(batch, empty)
    assert inserted == 601
    assert skipped.agg(F.sum("copies")).first()[0] == 299
    assert skipped.count() == 1            # the copies collapse to one report row


def test_null_key_never_inserted(spark):
    batch = frame(spark, [sales_row(None, dt.date(2024, 1, 1)), sales_row("X", dt.date(2024, 1, 1))])
    empty = spark.createDataFrame([], SALES_SCHEMA)
    assert [r.invoice_line_no for r in append_new(batch, empty).collect()] == ["X"]
    assert [r.reason for r in skipped_rows(batch, empty).collect()] == ["null key"]


def test_load_twice_inserts_nothing_second_time(spark, tmp_dir):
    layers = create_layers(spark, tmp_dir)
    batch = frame(spark, [sales_row(f"K{i % 7}", dt.date(2024, 1, 1 + i)) for i in range(20)])
    first = {r.layer: r.rows_after for r in load_layers(batch, layers).collect()}
    second = load_layers(batch, layers).collect()
    assert first == {"staging": 7, "integration": 7}
    assert all(r.rows_before == r.rows_after == 7 for r in second)


def test_month_windows_golden_cases(spark):
    assert month_list(None, dt.date(2024, 3, 20))[0] == (2020, 7)
    assert len(month_list(None, dt.date(2024, 3, 20))) == 44
    assert month_list(None, dt.date(2024, 3, 20))[-1] == (2024, 2)
    assert month_list(dt.date(2023, 12, 31), dt.date(2024, 3, 20)) == [(2024, 1), (2024, 2)]
    assert month_list(dt.date(2024, 2, 29), dt.date(2024, 3, 20)) == []
    marks = spark.createDataFrame([(None, dt.date(2024, 3, 20)), ], "high_water_mark date, run date")
    rows = month_windows(marks, F.col("run")).collect()
    assert len(rows) == 44 and rows[0].window_start == dt.date(2020, 7, 1)
    marks = spark.createDataFrame([(dt.date(2024, 2, 29), dt.date(2024, 3, 20))], "high_water_mark date, run date")
    assert month_windows(marks, F.col("run")).count() == 0


def test_high_water_mark_empty_is_null(spark):
    empty = spark.createDataFrame([], SALES_SCHEMA)
    assert high_water_mark(empty).first()[0] is None


def test_placeholders_leave_no_nulls(spark):
    raw = spark.createDataFrame([tuple([None] * 18)], ", ".join(f"{c} string" for c in SALES_COLUMNS))
    filled = fill_placeholders(raw).first().asDict()
    assert all(filled[c] is not None for c in DIMENSION_COLUMNS)
    assert filled["store"] == "9999" and filled["name"] == "UNKNOWN"


def test_clean_sales_from_json(spark, tmp_dir):
    records = [
        {"invoice_line_no": "A1", "date": "2020-7-01T00:00:00.000", "store": "12", "name": "HY-VEE #1",
         "zipcode": "50010", "category": "1011100", "vendor_no": "3", "itemno": "12.0",
         "bottle_volume_ml": "750", "state_bottle_cost": "3.50", "state_bottle_retail": "5.25",
         "sale_bottles": "6"},
        {"invoice_line_no": "A2", "date": "2020-07-02T00:00:00.000", "store": "12",
         "state_bottle_cost": "3.50", "state_bottle_retail": "5.25", "sale_bottles": "-1"},
    ]
    path = os.path.join(tmp_dir, "raw.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in records))
    from salesmart.sources.raw import read_raw_sales
    rows = clean_sales(read_raw_sales(spark, path)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.date == dt.date(2020, 7, 1) and r.itemno == 12 and r.address == "UNKNOWN"
    assert r.category_name == "UNKNOWN" and str(r.state_bottle_cost) == "3.50"


def record(key, day, bottles="2", name="HY-VEE"):
    return json.dumps({"invoice_line_no": key, "date": day, "store": "1", "name": name, "bottle_volume_ml": "750",
                       "state_bottle_cost": "3.50", "state_bottle_retail": "5.25", "sale_bottles": bottles})


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines))


def test_stream_loads_new_files_only_once(spark, tmp_dir):
    landing, base, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "base", "ckpt"))
    land(landing, "m1.json", [record("A", "2024-01-02T00:00:00.000"), record("B", "2024-01-03T00:00:00.000"),
                              record("X", "2024-01-03T00:00:00.000", name="FAREWAY")])
    assert run_incremental_stream(spark, landing, base, ckpt).count() == 2
    land(landing, "m2.json", [record("A", "2024-02-01T00:00:00.000"), record("C", "2024-02-02T00:00:00.000"),
                              record("D", "someday"), '{"invoice_line_no": "E", "name": "HY-VEE"', "[1"])
    out = run_incremental_stream(spark, landing, base, ckpt)
    assert sorted((r.invoice_line_no, r.date.month) for r in out.collect()) == [("A", 1), ("B", 1), ("C", 2)]
    rejects = spark.read.parquet(f"{base}/rejects").collect()
    assert sorted((r.run, r.reject_reason) for r in rejects) == [
        ("batch-1", "malformed record"), ("batch-1", "malformed record"), ("batch-1", "unparseable date")]
    assert [(r.run, r.invoice_line_no, r.reason) for r in spark.read.parquet(f"{base}/skipped").collect()] == [
        ("batch-1", "A", "key already stored")]
    # a re-run with nothing new changes nothing, and a replayed batch replaces its reports
    assert run_incremental_stream(spark, landing, base, ckpt).count() == 3
    replayed = read_landing(spark, f"{landing}/m2.json")
    load_records(spark, replayed, base, "batch-1", None, f"{base}/scratch").collect()
    assert read_layer(spark, f"{base}/stg/sales").count() == 3
    assert spark.read.parquet(f"{base}/rejects").count() == 3


def account(spark, base):
    return {(r.run, r.outcome): r.n_rows for r in spark.read.parquet(f"{base}/account").collect() if r.n_rows}


def test_every_landed_line_is_accounted_for_over_several_runs(spark, tmp_dir):
    landing, base = f"{tmp_dir}/landing", f"{tmp_dir}/base"
    lines = [record("A", "2024-01-02T00:00:00.000")] * 3 + [
        record("B", "2024-01-05T00:00:00.000", bottles="-1"), record("C", "2024-02-05T00:00:00.000"),
        record("D", "2024-02-05T00:00:00.000", bottles="many"), record("E", None), record("E", None),
        record("F", "2024-03-05T00:00:00.000"), record("G", "2024-02-07T00:00:00.000", name="FAREWAY"),
        record(None, "2024-03-05T00:00:00.000"), '{"invoice_line_no": "H", "date": "2024-01-09T00:00:00.000"', "no json", "no json"]
    land(landing, "page.json", lines)

    def run(*months):
        run_incremental(spark, landing, base, dt.date(2024, 4, 2), f"{tmp_dir}/scratch", months=[(2024, m) for m in months]).collect()

    run(1)
    run(2)
    once = {("2024-01", "inserted"): 1, ("2024-01", "skipped"): 2, ("2024-01", "not positive"): 1, ("2024-01", "rejected"): 5,
            ("2024-02", "inserted"): 1, ("2024-02", "other retailer"): 1, ("2024-02", "rejected"): 1,
            ("2024-02", "rejected before"): 5}
    assert account(spark, base) == once
    assert sum(n for (_, o), n in once.items() if o != "rejected before") == len(lines) - 2      # all but March's
    # months 1 and 3, then 1 to 3: other names, no reject twice, no report replaced
    run(1, 3)
    run(1, 2, 3)
    rejects = spark.read.parquet(f"{base}/rejects").collect()
    assert sorted((r.run, r.reject_reason, r.copies) for r in rejects) == [
        ("2024-01", "malformed record", 1), ("2024-01", "malformed record", 2), ("2024-01", "missing date", 2),
        ("2024-01+2024-03", "missing invoice_line_no", 1), ("2024-02", "bad sale_bottles", 1)]
    assert {r.raw_record for r in rejects if r.reject_reason == "malformed record"} == {lines[-3], "no json"}
    # the same run again: nothing inserted, the same rejects
    run(1)
    assert len(spark.read.parquet(f"{base}/rejects").collect()) == len(rejects)
    assert account(spark, base)[("2024-01", "skipped")] == 3
    assert sorted(r.invoice_line_no for r in read_layer(spark, f"{base}/stg/sales").collect()) == ["A", "C", "F"]


def test_run_ids_name_all_months():
    assert run_id([(2023, 12), (2024, 1), (2024, 3)]) == "2023-12..2024-01+2024-03"
    assert run_id([(2024, 1), (2024, 3)]) != run_id([(2024, 1), (2024, 2), (2024, 3)])
    odd = [(y, m) for y in range(1990, 2024) for m in (1, 3, 5)]
    assert len(run_id(odd)) < 120 and run_id(odd) != run_id(odd[:-1])


def test_stored_keys_are_not_shuffled(spark, tmp_dir):
    layers = create_layers(spark, tmp_dir)
    batch = frame(spark, [sales_row(f"K{i}", dt.date(2024, 1, 1 + i % 9)) for i in range(50)])
    load_layers(batch, layers)
    ledger = Ledger(spark, tmp_dir, layers)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = ledger.mark_stored(first_per_key(batch))
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert marked.filter("in_staging and in_integration").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Bucketed: true" in plan
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    above = []                                           # the operators from the stored keys up to the join
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            above.append(line)
            depth = d
        if "Join" in line:
            break
    assert above and not any("Exchange" in line for line in above), plan


def test_figures_come_from_the_writes_and_survive_an_interrupted_run(spark, tmp_dir, monkeypatch):
    layers = create_layers(spark, tmp_dir)

    def batch(first, n):
        return frame(spark, [sales_row(f"K{i}", dt.date(2024, 1 + i % 3, 1)) for i in range(first, first + n)])

    load_layers(batch(0, 10), layers, run="one")
    stats = {r.layer: tuple(r)[1:] for r in Ledger(spark, tmp_dir, layers).stats().collect()}
    assert stats == dict.fromkeys(layers, (10, dt.date(2024, 1, 1), dt.date(2024, 3, 1)))
    # the second layer's write fails: staging has rows that neither log nor keys know
    real = load.append_to_layer

    def failing(rows, path):
        if "/int/" in path:
            raise RuntimeError("lost")
        return real(rows, path)

    monkeypatch.setattr(load, "append_to_layer", failing)
    with pytest.raises(RuntimeError):
        load_layers(batch(5, 10), layers, run="two")
    monkeypatch.setattr(load, "append_to_layer", real)
    got = {r.layer: (r.rows_before, r.rows_after) for r in load_layers(batch(5, 10), layers, run="two").collect()}
    assert got == {"staging": (15, 15), "integration": (10, 15)}
    for layer, path in layers.items():
        t = read_layer(spark, path)
        assert t.count() == t.select("invoice_line_no").distinct().count() == 15
    assert {r.layer: r.record_count for r in Ledger(spark, tmp_dir, layers).stats().collect()} == dict.fromkeys(layers, 15)


def test_first_per_key_prefers_earliest_date(spark):
    batch = frame(spark, [sales_row("A", dt.date(2024, 2, 1), name="LATE"),
                          sales_row("A", dt.date(2024, 1, 1), name="EARLY")])
    assert first_per_key(batch).first().name == "EARLY"


def test_hot_key_with_distinct_rows(spark):
    # a third of the batch shares one key but every row differs: one winner, the rest skipped
    hot = [sales_row("HOT", dt.date(2024, 1, 1 + i % 28), bottles=1 + i) for i in range(400)]
    rest = [sales_row(f"K{i}", dt.date(2024, 2, 1)) for i in range(800)]
    batch = frame(spark, hot + rest)
    empty = spark.createDataFrame([], SALES_SCHEMA)
    inserted = {r.invoice_line_no: r for r in append_new(batch, empty).collect()}
    assert len(inserted) == 801
    assert (inserted["HOT"].date, inserted["HOT"].sale_bottles) == (dt.date(2024, 1, 1), 1)
    skipped = skipped_rows(batch, empty)
    assert skipped.agg(F.sum("copies")).first()[0] == 399
    assert skipped.filter(F.col("invoice_line_no") != "HOT").count() == 0


def test_run_log_as_csv(spark, tmp_dir):
    from salesmart.operators.runlog import append_run_log, read_run_log, run_log_row, table_stats
    stats = table_stats(frame(spark, [sales_row("A", dt.date(2024, 1, 1))]))
    start = dt.datetime(2024, 3, 20, 22, 57, 44)
    for k in range(2):
        previous = read_run_log(spark, f"{tmp_dir}/log", "csv") if k else None
        row = run_log_row(stats, start + dt.timedelta(days=k), start + dt.timedelta(days=k, seconds=5), previous)
        append_run_log(row, f"{tmp_dir}/log", "csv")
    log = read_run_log(spark, f"{tmp_dir}/log", "csv").orderBy("process_start_time").collect()
    assert [(r.record_count, r.new_records_added, r.total_duration) for r in log] == \
        [(1, 0, "00:00:05.000"), (1, 0, "00:00:05.000")]


def test_rejected_rows(spark):
    from salesmart.operators.clean import rejected_rows
    cols = ", ".join(f"{c} string" for c in SALES_COLUMNS)
    good = ["A", "2024-01-02T00:00:00.000", "1", "N", "AD", "C", "50010", "CO", "1011100", "W", "3",
            "V", "12", "I", "750", "3.50", "5.25", "2"]
    bad_date = list(good); bad_date[0], bad_date[1] = "B", "not a date"
    no_date = list(good); no_date[0], no_date[1] = "C", None
    bad_num = list(good); bad_num[0], bad_num[14] = "D", "7.5ml"
    no_cost = list(good); no_cost[0], no_cost[15] = "E", None
    negative = list(good); negative[0], negative[17] = "F", "-3"
    raw = spark.createDataFrame([tuple(r) for r in (good, bad_date, no_date, bad_num, no_cost, negative)], cols)
    got = {r.invoice_line_no: r.reject_reason for r in rejected_rows(raw).collect()}
    assert got == {"B": "unparseable date", "C": "missing date", "D": "bad bottle_volume_ml",
                   "E": "missing state_bottle_cost"}
    # the cleaning keeps only the typable record with positive measures
    assert [r.invoice_line_no for r in clean_sales(raw).collect()] == ["A"]
