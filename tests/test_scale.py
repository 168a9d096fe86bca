"""What a step shuffles and writes: landings, digests, dimensions and due months."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from salesmart import demo
from salesmart.operators.load import (first_per_key, first_per_key_staged, load_layers, mark_batch, skipped_marked,
                                      skipped_rows)
from salesmart.operators.profile import drop_full_duplicates, duplicate_stats
from salesmart.operators.clean import clean_sales
from salesmart.operators import load, quality
from salesmart.operators.quality import create_layers
from salesmart.operators.staged import stage
from salesmart.plans import catalog
from salesmart.plans.workflow import new_rejects
from salesmart.schema import SALES_COLUMNS, SALES_SCHEMA
from salesmart.sources import sinks
from salesmart.sources.layers import read_layer
from salesmart.sources.ledger import Ledger
from salesmart.sources.raw import read_raw_sales
from tests.conftest import SF_SMALL
from tests.test_load import frame, sales_row
from tests.test_plans import plan


def test_landing_is_compressed_in_bounded_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks, "LANDING_FILE_ROWS", 40, raising=False)
    rows = spark.range(100).coalesce(1).select(*(F.concat(F.lit(f"{c} "), F.col("id")).alias(c) for c in SALES_COLUMNS))
    sinks.write_raw_json(rows, f"{tmp_dir}/landing")
    files = glob.glob(f"{tmp_dir}/landing/part-*")
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    assert read_raw_sales(spark, f"{tmp_dir}/landing").exceptAll(rows).isEmpty()


def test_adapter_shuffles_numbers_only(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(demo.sales_view(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = [b for b in p.split("\n\n") if "hashpartitioning(l_partkey" in b]
    assert moved and not any("n_name" in b or "r_name" in b for b in moved), moved


def test_wide_duplicates_are_counted_by_digest(spark):
    schema = "a string, b string, c int, d double, e date, f string"
    day = dt.date(2024, 1, 1)
    rows = [("x", None, 1, 0.0, day, "y"), ("x", None, 1, -0.0, day, "y"), (None, "x", 1, 0.0, day, "y"),
            ("x", "", 1, 0.0, day, "y"), ("", "x", 1, 0.0, day, "y"), (None,) * 6, (None,) * 6, ("xy", None, 1, 0.0, day, "")]
    df = spark.createDataFrame(rows, schema)
    got = duplicate_stats(df).first()
    assert (got.n_rows, got.dup_rows) == (8, 2)
    assert "xxhash64" in plan(duplicate_stats(df))
    moved = [b for b in plan(duplicate_stats(df)).split("\n\n") if ") Exchange" in b]
    assert not any("f#" in b for b in moved), moved


def test_copies_come_from_one_evaluation(spark):
    p = plan(catalog._with_copies(spark, SF_SMALL))
    assert p.split("\n\n")[0].count("lineitem") + p.split("\n\n")[0].count("Union") == 0
    assert len([b for b in p.split("\n\n") if "Scan parquet" in b and "l_orderkey" in b]) == 1


def _evaluations(monkeypatch):
    seen, real = [], catalog.clean

    def counted(spark, sf):
        seen.append(sf)
        return real(spark, sf)

    monkeypatch.setattr(catalog, "clean", counted)
    return seen


def test_dimensions_and_due_months_clean_once(spark, monkeypatch):
    seen = _evaluations(monkeypatch)
    catalog.q_dim_items_merged(spark, SF_SMALL)
    assert len(seen) == 1
    catalog.q_extract_due_months(spark, SF_SMALL)
    assert len(seen) == 2


def _tied_batch(spark):
    """Keys once, twice on several days, on one day with different rows, as copies, and without a key."""
    rows = [sales_row(f"K{i % 40}", dt.date(2024, 1, 1 + i % 3), bottles=9 - i % 5) for i in range(300)]
    rows += [sales_row("HOT", dt.date(2024, 2, 1), name=f"N{i % 2}") for i in range(50)]
    rows += [sales_row("ONE", dt.date(2024, 2, 2)), sales_row(None, dt.date(2024, 2, 2)), sales_row(None, dt.date(2024, 2, 2))]
    rows += [sales_row("UNDATED", None, name="B"), sales_row("UNDATED", None, name="A"), sales_row("UNDATED", dt.date(2024, 1, 1))]
    return frame(spark, rows).repartition(5)


def test_staged_rows_are_the_first_of_their_keys(spark, tmp_dir):
    batch = _tied_batch(spark)
    got, expected = first_per_key_staged(batch, f"{tmp_dir}/s"), first_per_key(batch)
    assert got.count() == expected.count() == 43
    assert got.exceptAll(expected).isEmpty()
    assert "hashpartitioning" not in plan(got)              # rows are marked by broadcast, not shuffled
    by_store = first_per_key_staged(batch, f"{tmp_dir}/t", "store", ["sale_bottles"])
    assert by_store.collect() == first_per_key(batch, "store", ["sale_bottles"]).collect()
    empty = first_per_key_staged(spark.createDataFrame([], SALES_SCHEMA), f"{tmp_dir}/e")
    assert empty.count() == 0


def test_marked_batch_gives_the_skipped_report_without_shuffling_it(spark, tmp_dir):
    layers = create_layers(spark, tmp_dir)
    ledger = Ledger(spark, tmp_dir, layers)
    batch = _tied_batch(spark)
    held = batch.filter("invoice_line_no in ('HOT', 'K1', 'K7')").select("invoice_line_no").distinct()
    ledger._write_keys(held.select("invoice_line_no", F.lit("staging").alias("layer")), overwrite=False)
    marked = mark_batch(stage(batch, f"{tmp_dir}/rows"), ledger, f"{tmp_dir}/scratch")
    assert "hashpartitioning" not in plan(marked)
    assert marked.filter("_winner").count() == 43 and marked.filter("_winner and in_staging").count() == 3
    assert not marked.filter("in_integration").count()
    for layer, target in (("staging", held), ("integration", held.limit(0))):
        got = skipped_marked(marked, layer, SALES_COLUMNS)
        expected = skipped_rows(batch, target)
        assert got.count() == expected.count() and got.exceptAll(expected).isEmpty()


def test_distinct_rows_shuffle_digests_only(spark, tmp_dir):
    batch = _tied_batch(spark)
    got = drop_full_duplicates(batch, f"{tmp_dir}/d")
    assert got.columns == batch.columns and got.count() == batch.distinct().count() < batch.count()
    assert got.exceptAll(batch.distinct()).isEmpty()
    assert "hashpartitioning" not in plan(got)


def test_rejects_shuffle_no_texts(spark, tmp_dir):
    records = [(f"K{i % 30}", "a.json", "rejected", "missing date", f"text {i % 30}") for i in range(40)]
    records += [("K1", "b.json", "rejected", "missing date", "text 1"), (None, "b.json", "rejected", "malformed record", "["),
                ("K2", "b.json", "loadable", None, None)]
    staged = stage(spark.createDataFrame(records, "invoice_line_no string, source_file string, outcome string, "
                                                  "reject_reason string, raw_record string").repartition(3), f"{tmp_dir}/rows")
    columns = ["invoice_line_no", "source_file", "reject_reason", "raw_record"]
    kept = staged.filter("raw_record = 'text 0' or raw_record = 'text 20'").select(*columns)
    got = new_rejects(staged, kept, f"{tmp_dir}/scratch")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(got.filter("copies = 1"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # what is shuffled by its text is what has copies, to meet their number
    assert p.count("Exchange hashpartitioning") <= 2 and "hashpartitioning(_h1" not in p, p
    assert sorted((r.source_file, r.raw_record, r.copies) for r in got.collect()) == sorted(
        [("a.json", f"text {i}", 2 if i < 10 else 1) for i in range(30) if i not in (0, 20)]
        + [("b.json", "text 1", 1), ("b.json", "[", 1)])
    assert new_rejects(staged, None, f"{tmp_dir}/again").count() == 32


def test_skipped_report_shuffles_only_rows_with_copies(spark, tmp_dir):
    ledger = Ledger(spark, tmp_dir, create_layers(spark, tmp_dir))
    batch = _tied_batch(spark)
    marked = mark_batch(stage(batch, f"{tmp_dir}/rows"), ledger, f"{tmp_dir}/scratch")
    got = skipped_marked(marked, "staging", SALES_COLUMNS, scratch=f"{tmp_dir}/skipped")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = [b for b in plan(got).split("\n\n") if "hashpartitioning" in b]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert moved and all("hashpartitioning(_row" in b for b in moved), moved
    assert {r.copies for r in got.collect()} > {1}
    assert got.exceptAll(skipped_rows(batch, batch.limit(0))).isEmpty()


def test_large_loads_write_layers_without_a_shuffle_by_month(spark, tmp_dir, monkeypatch):
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = {}
    for way, least in (("direct", 1), ("shuffled", 10**9)):
        monkeypatch.setattr(load, "FILE_ROWS", least)
        base = f"{tmp_dir}/{way}"
        layers = create_layers(spark, base)
        held = _tied_batch(spark).filter("invoice_line_no in ('HOT', 'K1')")
        load_layers(held, {"staging": layers["staging"]}, scratch=f"{base}/s0")
        Ledger(spark, base, layers).recover()
        counts = load_layers(_tied_batch(spark), layers, scratch=f"{base}/s1")
        got[way] = {r.layer: tuple(r) for r in counts.collect()}
        assert quality.table_exists(spark, f"{base}/s1/inserts") == (way == "shuffled")
        for layer, path in layers.items():
            assert read_layer(spark, path).select(*SALES_COLUMNS).exceptAll(first_per_key(_tied_batch(spark))).isEmpty()
        again = load_layers(_tied_batch(spark), layers, scratch=f"{base}/s2").collect()
        assert all(r.rows_before == r.rows_after == 43 for r in again)
    assert got["direct"] == got["shuffled"] == {"staging": ("staging", 2, 43), "integration": ("integration", 0, 43)}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split


def test_layer_figures_and_keys_move_once(spark, tmp_dir):
    ledger = Ledger(spark, tmp_dir, create_layers(spark, tmp_dir))
    moved = []
    ledger._insert_keys = lambda rows, overwrite: moved.append(rows)
    ledger.add_keys(spark.createDataFrame([("A", False, False), ("B", True, False), ("C", True, True)],
                                          "invoice_line_no string, in_staging boolean, in_integration boolean"))
    p = plan(moved[0])
    assert p.index("Generate") < p.index("Exchange"), p        # one row a key is shuffled, not one a layer
    assert sorted(map(tuple, moved[0].collect())) == [("A", "integration"), ("A", "staging"), ("B", "integration")]


def test_landing_load_reads_its_source_for_the_landing_only(spark, monkeypatch):
    reads, real = [], catalog.sales
    monkeypatch.setattr(catalog, "sales", lambda s, sf: reads.append(sf) or real(s, sf))
    monkeypatch.setattr(catalog.wf, "run_incremental", lambda *a, months, **k: spark.createDataFrame([(str(months),)], "m string"))
    catalog._landing_load(spark, SF_SMALL)
    assert len(reads) == 2                                      # the records and the broken lines


def test_skipped_report_of_a_query_moves_no_whole_rows(spark, tmp_dir):
    batch = _tied_batch(spark)
    held = batch.filter("invoice_line_no in ('HOT', 'K1', 'K7')")
    held = held.unionByName(held.limit(1)).unionByName(batch.filter("invoice_line_no is null"))
    for target in (held, held.limit(0)):
        got, expected = skipped_rows(batch, target, scratch=f"{tmp_dir}/s{target.count()}"), skipped_rows(batch, target)
        assert got.schema.simpleString() == expected.schema.simpleString() and got.count() == expected.count()
        assert got.exceptAll(expected).isEmpty()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = [b for b in plan(skipped_rows(batch, held, scratch=f"{tmp_dir}/p")).split("\n\n") if "hashpartitioning" in b]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert moved and all("hashpartitioning(_row" in b for b in moved), moved


def test_skipped_duplicates_cleans_once(spark, monkeypatch):
    seen = _evaluations(monkeypatch)
    catalog.q_skipped_duplicates(spark, SF_SMALL)
    assert len(seen) == 1


def _largest_method(spark, df):
    """Bytes of code of the largest method that Spark generates for the plan."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        physical = df.select("*")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    found = debug.codegenStringSeq(physical)
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size()))


def test_records_are_typed_in_methods_that_are_compiled(spark, tmp_dir):
    from salesmart.plans.workflow import staged_records
    from salesmart.sources.raw import read_landing
    spark.createDataFrame([("{}",)], "value string").write.text(f"{tmp_dir}/landing")
    landing = read_landing(spark, f"{tmp_dir}/landing")
    months = [(2024, m) for m in range(1, 13, 2)]
    for df in (staged_records(landing, months), clean_sales(landing)):
        assert 0 < _largest_method(spark, df) < 8000         # above, HotSpot interprets it


def test_numbers_are_parsed_in_due_months_only(spark, tmp_dir):
    from salesmart.plans.workflow import staged_records
    from salesmart.sources.raw import read_landing
    spark.createDataFrame([("{}",)], "value string").write.text(f"{tmp_dir}/landing")
    landing = read_landing(spark, f"{tmp_dir}/landing")
    staged = staged_records(landing, [(2024, 1)])
    found = staged._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("RLIKE") == 9
    # from the scan up: the date, the filter by month, the numbers
    assert found.rindex("RLIKE") < found.index("2024-02-01") < found.index("inline(array(struct(_parsed_date")


def test_marks_are_read_from_arrays(spark, tmp_dir):
    from salesmart.operators.staged import marked, row_bits
    staged = stage(spark.range(100_000, numPartitions=3).withColumn("k", F.xxhash64("id")), f"{tmp_dir}/rows")
    ids = staged.filter("k % 3 = 0")
    flags = {"third": F.lit(True), "sixth": F.col("k") % 2 == 0, "none": F.lit(False)}
    got = marked(staged, row_bits(ids, flags, f"{tmp_dir}/bits"))
    wrong = "third <> (k % 3 = 0) or sixth <> (k % 6 = 0) or none"
    assert got.count() == 100_000 and got.filter(wrong).isEmpty() and not got.filter("third").isEmpty()
    assert "conv(" not in plan(got)                 # no text is made of each row's byte
