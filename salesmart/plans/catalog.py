"""Registered queries: one per operator of the inventory, over the driver's tables.

Each query takes (spark, sf_dir) and returns a DataFrame. Inputs are the ``sales``
adapter (``demo.sales_view``) and its raw-text form; every query reads the whole tables.
Column names match the oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from salesmart import demo
from salesmart.functions.dates import fiscal_year
from salesmart.functions.numeric import div_round
from salesmart.functions.text import (clean_address, normalize_store_name, py_title,
                                      title_except_numbers)
from salesmart.functions.classify import classify_ordered, first_match
from salesmart.operators import calendar as cal
from salesmart.operators import clean as cl
from salesmart.operators import features as ft
from salesmart.operators import load as ld
from salesmart.operators import metrics as mt
from salesmart.operators import model as md
from salesmart.operators import profile as pf
from salesmart.operators import quality as qa
from salesmart.operators import runlog as rl
from salesmart.operators import windows as wn
from salesmart.operators.staged import stage
from salesmart.plans import workflow as wf
from salesmart.schema import (DIMENSION_COLUMNS, DIRECTIONS, MEASURE_COLUMNS, REFERENCE_RUN_ROWS,
                              REFERENCE_RUN_SECONDS, SALES_COLUMNS, STORE_FORMAT_DEFAULT,
                              STORE_FORMAT_EXACT, STORE_FORMATS, STORE_NAME_REWRITES)
from salesmart.session import scratch_path
from salesmart.sources.layers import append_to_layer, layer_windows, read_layer
from salesmart.sources import raw as src
from salesmart.sources import sinks
from salesmart.sources import slices as sl

Query = Callable[[SparkSession, str], DataFrame]

# Scenario parameters of the demo queries (dates fall inside the test data, 1995-2001).
STORED_BEFORE = "1999-01-01"       # rows before this date are already loaded
RELOAD_FROM = "1998-07-01"         # an overlapping reload starts here
SLICE_MONTH = (1998, 12)
SLICE_FY = 1999
WINDOWS = [(1996, 2), (1997, 11), (1997, 12), (1998, 1), (2000, 6)]
DIM_FY = 1999                      # dimensions of an earlier model build
FK_CALENDAR = ("1996-01-01", "2000-12-31")
DUP_COLUMNS = ["store", "vendor_no", "category_name"]
RUN_START = dt.datetime(2024, 3, 20, 22, 57, 44)
RUN_END = dt.datetime(2024, 3, 20, 23, 41, 30, 88000)
NOT_NULL_CALENDAR = ["date", "weekend", "previous_day", "next_day"]


def _d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return demo.sales_view(spark, sf)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return demo.raw_sales_view(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cl.clean_sales(raw(spark, sf))


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The already-loaded layer: first row per key of the cleaned rows before the cutoff."""
    return ld.first_per_key(clean(spark, sf).filter(F.col("date") < F.lit(_d(STORED_BEFORE))))


def reload_batch(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf).filter(F.col("date") >= F.lit(_d(RELOAD_FROM)))


# --- sources -------------------------------------------------------------------------

def q_raw_sales_roundtrip(spark, sf):
    path = scratch_path(spark, "raw-json")
    sinks.write_raw_json(raw(spark, sf), path)
    return src.read_raw_sales(spark, path)


def q_select_sales(spark, sf):
    return src.select_sales(sales(spark, sf))


def q_filter_retailer(spark, sf):
    return sl.filter_retailer(demo.retailer_mix(sales(spark, sf)))


def q_slice_month(spark, sf):
    return sl.slice_month(sales(spark, sf), *SLICE_MONTH)


def q_slice_fiscal_year(spark, sf):
    return sl.slice_fiscal_year(sales(spark, sf), SLICE_FY)


def q_extract_windows(spark, sf):
    return sl.extract_windows(sales(spark, sf), WINDOWS)


def q_read_store_names(spark, sf):
    path = scratch_path(spark, "stores")
    sinks.refresh_table(md.dim_stores(clean(spark, sf)), path)
    return src.read_table(spark, path, ["store_id", "store_name"])


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(clean(spark, sf), path)
    return src.read_csv(spark, path)


# --- load ----------------------------------------------------------------------------

def q_append_new_rows(spark, sf):
    return ld.append_new(reload_batch(spark, sf), stored(spark, sf))


def q_skipped_duplicates(spark, sf):
    base = scratch_path(spark, "skipped")
    # cleaned once, for the stored rows and the batch
    rows = stage(clean(spark, sf), f"{base}/rows")
    target = ld.first_per_key_staged(rows.filter(F.col("date") < F.lit(_d(STORED_BEFORE))), f"{base}/stored")
    return ld.skipped_rows(rows.filter(F.col("date") >= F.lit(_d(RELOAD_FROM))), target, scratch=f"{base}/batch")


def q_load_layers(spark, sf):
    base = scratch_path(spark, "layers")
    layers = qa.create_layers(spark, base)
    return ld.load_layers(clean(spark, sf), layers, scratch=f"{base}/batch")


def _lookup_rows(raw_df: DataFrame) -> DataFrame:
    order = F.array(*[F.lit(c) for c in SALES_COLUMNS])
    ph = pf.derive_placeholders(raw_df).select(
        F.lit("placeholders").alias("dictionary"),
        (F.array_position(order, F.col("column_name")) - 1).cast("int").alias("pos"),
        F.col("column_name").alias("key"), F.col("placeholder").alias("value"))
    nt = pf.infer_numeric_types(cl.fill_placeholders(raw_df)).select(
        F.lit("num_col_dtype_map").alias("dictionary"),
        (F.array_position(order, F.col("column_name")) - 1).cast("int").alias("pos"),
        F.col("column_name").alias("key"), F.col("dtype").alias("value"))
    return ph.unionByName(nt)


DICTIONARIES = ("placeholders", "num_col_dtype_map")


def q_lookup_roundtrip(spark, sf):
    rows, path, back = _lookup_rows(raw(spark, sf)), scratch_path(spark, "lookups"), None
    for name in DICTIONARIES:
        sinks.write_lookup(rows.filter(F.col("dictionary") == name).drop("dictionary"), f"{path}/{name}")
        own = src.read_lookup(spark, f"{path}/{name}").withColumn("dictionary", F.lit(name))
        back = own if back is None else back.unionByName(own)
    return back


def q_dictionary_roundtrip(spark, sf):
    """The derived dictionaries as JSON objects, read back in order."""
    rows, path, back = _lookup_rows(raw(spark, sf)), scratch_path(spark, "dictionaries"), None
    for name in DICTIONARIES:
        sinks.write_dictionary(rows.filter(F.col("dictionary") == name).drop("dictionary"), f"{path}/{name}.json")
        own = src.read_dictionary(spark, f"{path}/{name}.json").withColumn("dictionary", F.lit(name))
        back = own if back is None else back.unionByName(own)
    return back


def _with_gaps(spark, sf) -> DataFrame:
    """Raw records of which some lack the vendor, the category or the county."""
    store, item = F.col("store").cast("int"), F.col("itemno").cast("int")
    none = F.lit(None).cast("string")
    return raw(spark, sf).withColumns({
        "vendor_no": F.when(store % 7 == 1, none).otherwise(F.col("vendor_no")),
        "category": F.when(item % 11 == 2, none).otherwise(F.col("category")),
        "county": F.when(store % 5 == 3, none).otherwise(F.col("county"))})


def q_clean_with_derived(spark, sf):
    """Placeholders and numeric types derived from the records, written and read as dictionaries, and
    used by the cleaning in place of the fixed ones."""
    base = scratch_path(spark, "derived")
    records = _with_gaps(spark, sf)

    def through_file(name: str, derived: DataFrame, value: str) -> dict[str, str]:
        order = F.array(*(F.lit(c) for c in records.columns))
        sinks.write_dictionary(derived.select(F.array_position(order, F.col("column_name")).alias("pos"),
                                              F.col("column_name").alias("key"), F.col(value).alias("value")), f"{base}/{name}.json")
        return src.as_mapping(src.read_dictionary(spark, f"{base}/{name}.json"))

    placeholders = through_file("placeholders", pf.derive_placeholders(records), "placeholder")
    types = through_file("types", pf.infer_numeric_types(cl.fill_placeholders(records, placeholders)), "dtype")
    return cl.clean_sales(records, placeholders, types)


# --- schema and constraints -----------------------------------------------------------

def q_conform_sales(spark, sf):
    return cl.conform(raw(spark, sf))


def q_create_like(spark, sf):
    base = scratch_path(spark, "like")
    stg = f"{base}/stg/sales"
    sinks.refresh_table(ld.first_per_key_staged(clean(spark, sf), f"{base}/batch"), stg)
    qa.create_like(spark, stg, f"{base}/int/sales")
    parts = []
    for layer, path in (("staging", stg), ("integration", f"{base}/int/sales")):
        table = spark.read.parquet(path)
        cols = qa.schema_report(table)
        n = table.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(cols.withColumn("layer", F.lit(layer))
                         .join(n.withColumn("layer", F.lit(layer)), "layer"))
    return parts[0].unionByName(parts[1])


def q_check_unique_sales(spark, sf):
    return qa.check_unique(sales(spark, sf), "invoice_line_no")


def _fy_dims(spark, sf):
    c = clean(spark, sf)
    earlier = sl.slice_fiscal_year(c, DIM_FY)
    return md.fact_transactions(c), md.dim_stores(earlier), md.dim_items(earlier)


def q_check_fk_store(spark, sf):
    # stores built from the retailer-filtered extract, fact from every cleaned row: the
    # check reports the stores of other retailers
    c = clean(spark, sf)
    stores = md.dim_stores(sl.filter_retailer(demo.retailer_mix(c)))
    return qa.check_fk(md.fact_transactions(c), stores, "store_id", "store_id")


def q_check_fk_item(spark, sf):
    fact, _, items = _fy_dims(spark, sf)
    return qa.check_fk(fact, items, "item_id", "item_id")


def q_check_fk_calendar(spark, sf):
    fact = md.fact_transactions(clean(spark, sf))
    return qa.check_fk(fact, cal.calendar(spark, *FK_CALENDAR), "date", "date")


def q_check_not_null_calendar(spark, sf):
    c = qa.apply_defaults(cal.calendar_for(sales(spark, sf)),
                          {"weekend": "Weekday", "previous_day": "1970-01-01",
                           "next_day": "1970-01-01"})
    return qa.check_not_null(c, NOT_NULL_CALENDAR)


def q_check_not_null_landed(spark, sf):
    """Nulls per column of a landing that has some."""
    return qa.check_not_null(_landed(spark, sf), SALES_COLUMNS)


LANDED_DEFAULTS = {"date": "1970-01-01T00:00:00.000", "invoice_line_no": "NONE", "category_name": "UNKNOWN"}


def q_apply_defaults_landed(spark, sf):
    return qa.apply_defaults(_landed(spark, sf), LANDED_DEFAULTS)


def q_reset_model(spark, sf):
    """Two dimension tables are written, one is reset; what is left."""
    base, c = scratch_path(spark, "reset"), clean(spark, sf)
    dims = {"stores": md.dim_stores(c), "items": md.dim_items(c)}
    for name, df in dims.items():
        sinks.refresh_table(df, f"{base}/{name}")
    dropped = qa.reset_model(spark, [f"{base}/stores", f"{base}/never_built"])
    parts = [(n, f"{base}/{n}" in dropped, spark.read.parquet(f"{base}/{n}").count() if qa.table_exists(spark, f"{base}/{n}") else None)
             for n in ("stores", "items", "never_built")]
    return spark.createDataFrame(parts, "table_name string, dropped boolean, n_rows long")


def q_replace_column(spark, sf):
    replaced = qa.replace_column(sales(spark, sf), "city", F.upper("city"))
    return qa.replace_column(replaced, "city_length", F.length("city"))


def q_update_from_category(spark, sf):
    items = md.dim_items(clean(spark, sf))
    codes = items.select("category_code", "category").distinct() \
                 .withColumn("liquor_type", ft.liquor_type(F.col("category_code")))
    return qa.update_from(items, codes, "category_code", ["liquor_type"])


# --- profiling --------------------------------------------------------------------------

def q_duplicate_stats(spark, sf):
    return pf.duplicate_stats(sales(spark, sf).select(*DUP_COLUMNS))


def q_drop_full_duplicates(spark, sf):
    return pf.drop_full_duplicates(sales(spark, sf).select(*DUP_COLUMNS))


def _with_copies(spark, sf):
    """Sales of which those of every tenth store are there twice, all columns alike."""
    return _twice(sales(spark, sf), F.col("store") % 10 == 3)


def _twice(rows: DataFrame, again) -> DataFrame:
    """The rows, and those with ``again`` a second time, from one evaluation of ``rows``."""
    copies = F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("*", copies.alias("_copy")).drop("_copy")


def q_duplicate_rows(spark, sf):
    return pf.duplicate_stats(_with_copies(spark, sf))


def q_distinct_rows(spark, sf):
    return pf.drop_full_duplicates(_with_copies(spark, sf), scratch_path(spark, "distinct"))


def q_key_collisions(spark, sf):
    return pf.key_collision_count(sales(spark, sf), "invoice_line_no")


def q_missing_values(spark, sf):
    return pf.missing_values(sales(spark, sf))


def q_derive_placeholders(spark, sf):
    return pf.derive_placeholders(raw(spark, sf), DIMENSION_COLUMNS)


def q_date_castable(spark, sf):
    return pf.is_date_castable(raw(spark, sf))


def q_infer_numeric_types(spark, sf):
    return pf.infer_numeric_types(cl.fill_placeholders(raw(spark, sf)))


def q_describe_measures(spark, sf):
    return pf.describe(sales(spark, sf), MEASURE_COLUMNS)


def q_pct_negative(spark, sf):
    return pf.pct_where(sales(spark, sf), F.col("sale_bottles") < 0, "pct_negative")


def q_filter_non_negative(spark, sf):
    return cl.filter_non_negative(sales(spark, sf))


def q_to_numeric(spark, sf):
    return pf.to_numeric(raw(spark, sf).select("invoice_line_no", *MEASURE_COLUMNS))


def _stores_with_format(spark, sf):
    return ft.add_store_format(md.dim_stores(clean(spark, sf)))


def q_distinct_store_format(spark, sf):
    return pf.distinct_values(_stores_with_format(spark, sf), "store_format")


def q_names_with_slash(spark, sf):
    stores = md.dim_stores(clean(spark, sf))
    return pf.distinct_values(pf.filter_contains(stores, "store_name", "/"), "store_name")


def q_preview_sales(spark, sf):
    return pf.preview(sales(spark, sf), 5)


def q_row_count(spark, sf):
    return pf.shape(sales(spark, sf))


def q_sample_n(spark, sf):
    return pf.sample_n(sales(spark, sf), 100, seed=42)


def q_category_pairs(spark, sf):
    return pf.distinct_sorted(md.dim_items(clean(spark, sf)), ["category_code", "category"])


# --- cleaning ---------------------------------------------------------------------------

def q_fill_placeholders(spark, sf):
    return cl.fill_placeholders(raw(spark, sf))


def q_normalize_date(spark, sf):
    return cl.normalize_date(raw(spark, sf))


def q_cast_by_map(spark, sf):
    return cl.cast_by_map(raw(spark, sf))


def q_filter_positive(spark, sf):
    return cl.filter_positive(sales(spark, sf))


def q_clean_sales(spark, sf):
    return clean(spark, sf)


# --- incremental windows ----------------------------------------------------------------

def _marks(c: DataFrame, with_mark: bool) -> DataFrame:
    hwm = F.max(F.when(F.col("date") < F.lit(_d(STORED_BEFORE)), F.col("date"))) if with_mark \
        else F.lit(None).cast("date")
    return c.agg(hwm.alias("high_water_mark"), F.date_add(F.max("date"), 1).alias("run_date"))


def q_high_water_mark(spark, sf):
    return wn.high_water_mark(stored(spark, sf))


def q_extract_due_months(spark, sf):
    """Rows of a stored layer in the months after the mark, which stay a table (no list on the driver)."""
    path = scratch_path(spark, "layer")
    append_to_layer(clean(spark, sf), path)
    marks = scratch_path(spark, "marks")
    _marks(read_layer(spark, path), True).write.parquet(marks)
    windows = wn.month_windows(spark.read.parquet(marks), F.col("run_date"))
    return layer_windows(read_layer(spark, path), windows).drop("sale_month")


def q_windows_resume(spark, sf):
    return wn.month_windows(_marks(clean(spark, sf), True), F.col("run_date"))


def q_windows_initial(spark, sf):
    return wn.month_windows(_marks(clean(spark, sf), False), F.col("run_date"))


def q_incremental_load(spark, sf):
    """The shipped load: a backfill of the months before ``STORED_BEFORE``, then a run that takes its
    months from the high-water mark; what the second one inserted."""
    base = scratch_path(spark, "incremental")
    seen = Observation()
    sinks.write_raw_json(demo.to_raw_text(_with_span(sales(spark, sf), seen)), f"{base}/landing")
    first, last = seen.get["first"], seen.get["last"]
    cut, run_date = _d(STORED_BEFORE), last + dt.timedelta(days=1)
    earlier = [m for m in wn.months_between(first, last) if m < (cut.year, cut.month)]
    for months in (earlier, None):
        wf.run_incremental(spark, f"{base}/landing", base, run_date, f"{base}/scratch", months=months).collect()
    return read_layer(spark, f"{base}/int/sales").filter(F.col("sale_month") >= f"{cut:%Y-%m}").select(*SALES_COLUMNS)


def _with_span(rows: DataFrame, seen: Observation) -> DataFrame:
    """Rows whose first and last date are known when they are written, without reading them again."""
    return rows.observe(seen, F.min("date").alias("first"), F.max("date").alias("last"))


def _landed(spark, sf, seen: Observation | None = None) -> DataFrame:
    """Raw records as a landing holds them: other retailers mixed in, and records that cannot be
    typed, have sub-cent money or repeat a key, derived from the rows by their store and item."""
    rows = sales(spark, sf)
    text = demo.to_raw_text(demo.retailer_mix(_with_span(rows, seen) if seen else rows))
    store, item = F.col("store").cast("int"), F.col("itemno").cast("int")
    spoiled = text.withColumns({
        "date": F.when(store % 23 == 1, F.lit(None).cast("string")).when(store % 23 == 2, F.lit("soon"))
                 .otherwise(F.col("date")),
        "invoice_line_no": F.when(item % 41 == 3, F.lit(None).cast("string")).otherwise(F.col("invoice_line_no")),
        "state_bottle_cost": F.when(item % 29 == 4, F.lit("0.004")).when(item % 29 == 5, F.lit("dear"))
                              .otherwise(F.col("state_bottle_cost")),
        "sale_bottles": F.when(item % 31 == 6, F.concat("sale_bottles", F.lit(".7"))).otherwise(F.col("sale_bottles"))})
    return _twice(spoiled, store % 10 == 3)


def _broken_lines(spark, sf) -> DataFrame:
    """Lines of a landing that are no proper records: records cut short, with the fields before the
    cut readable, some of them twice."""
    rows = sales(spark, sf).filter((F.col("store") % 19 == 7) & (F.col("itemno") % 13 == 5))
    line = F.concat(F.lit('{"invoice_line_no":"'), "invoice_line_no", F.lit('","name":"HY-VEE","sale_bottles":"'))
    return _twice(rows.select(line.alias("value"), "store"), F.col("store") % 2 == 1).select("value")


def _landing_load(spark, sf) -> str:
    """The shipped load run twice over one landing: the months before ``STORED_BEFORE`` and those from
    ``RELOAD_FROM``, so that the second run meets stored keys. Returns the base folder."""
    base = scratch_path(spark, "landing-load")
    seen = Observation()
    sinks.write_raw_json(_landed(spark, sf, seen), f"{base}/landing")
    _broken_lines(spark, sf).write.mode("append").text(f"{base}/landing")
    span = seen.get["first"], seen.get["last"]
    cut, again = _d(STORED_BEFORE), _d(RELOAD_FROM)
    whole = wn.months_between(span[0], span[1])
    first = [m for m in whole if m < (cut.year, cut.month)]
    second = [m for m in whole if m >= (again.year, again.month)]
    for months in (first, second):
        wf.run_incremental(spark, f"{base}/landing", base, span[1], f"{base}/scratch", months=months).collect()
    return base


def q_load_landing(spark, sf):
    return read_layer(spark, f"{_landing_load(spark, sf)}/int/sales").select(*SALES_COLUMNS)


def q_load_rejects(spark, sf):
    rejects = spark.read.parquet(f"{_landing_load(spark, sf)}/rejects")
    return rejects.groupBy("run", "reject_reason").agg(F.sum("copies").alias("n_rows"))


def q_load_account(spark, sf):
    """What became of every landed line that the two runs had to account for."""
    return spark.read.parquet(f"{_landing_load(spark, sf)}/account").select("run", "outcome", "n_rows")


def q_load_skipped(spark, sf):
    return spark.read.parquet(f"{_landing_load(spark, sf)}/skipped").select("run", *SALES_COLUMNS, "copies", "reason")


def q_incremental_stream(spark, sf):
    from salesmart.streaming.incremental import run_incremental_stream
    base = scratch_path(spark, "stream")
    sinks.write_raw_json(_landed(spark, sf), f"{base}/landing")
    _broken_lines(spark, sf).write.mode("append").text(f"{base}/landing")
    return run_incremental_stream(spark, f"{base}/landing", base, f"{base}/checkpoint").select(*SALES_COLUMNS)


# --- calendar ---------------------------------------------------------------------------

def q_number_series(spark, sf):
    return cal.day_offsets(sales(spark, sf))


def q_date_series(spark, sf):
    return cal.covering_date_series(sales(spark, sf))


def q_calendar_attributes(spark, sf):
    return cal.calendar_attributes(cal.covering_date_series(sales(spark, sf)))


def q_calendar_fiscal(spark, sf):
    return cal.fiscal_columns(cal.covering_date_series(sales(spark, sf)))


def q_calendar(spark, sf):
    return cal.calendar_for(sales(spark, sf))


# --- model ------------------------------------------------------------------------------

def q_dim_stores(spark, sf):
    return md.dim_stores(clean(spark, sf))


def q_dim_items(spark, sf):
    return md.dim_items(clean(spark, sf))


def _merged(spark, sf, name):
    """A dimension brought up to date by three batches: the stored rows, a late one, an overlapping reload."""
    base = scratch_path(spark, "dimensions")
    # cleaned once: each batch is read twice, and its tables' broadcasts would go through the driver each time
    clean(spark, sf).write.option("compression", "zstd").parquet(f"{base}/sales")
    sales = spark.read.parquet(f"{base}/sales")
    before, after = (sales.filter(cond) for cond in (F.col("date") < F.lit(_d(STORED_BEFORE)),
                                                     F.col("date") >= F.lit(_d(STORED_BEFORE))))
    for batch in (ld.first_per_key(before), after, sales):
        dims = md.update_dimensions(batch, base)
    return dims[name]


def q_dim_stores_merged(spark, sf):
    return _merged(spark, sf, "stores")


def q_dim_items_merged(spark, sf):
    return _merged(spark, sf, "items")


def q_distinct_items(spark, sf):
    return md.distinct_items(clean(spark, sf))


def q_fact_transactions(spark, sf):
    return md.fact_transactions(clean(spark, sf))


def q_build_model_counts(spark, sf):
    # the cleaned rows are staged once (as the workflow's staging layer is) instead of
    # being recomputed from the driver tables in each of the seven counted branches
    path = scratch_path(spark, "model-sales")
    clean(spark, sf).write.parquet(path)
    return md.model_counts(md.build_model(spark.read.parquet(path), None, None))


def _mart(spark, sf, name):
    """A table of the mart that ``build_mart`` writes from the cleaned rows, read back."""
    base = scratch_path(spark, "mart")
    clean(spark, sf).write.parquet(f"{base}/sales")
    wf.build_mart(spark.read.parquet(f"{base}/sales"), base)
    return src.read_table(spark, f"{base}/{name}")


def q_mart_stores(spark, sf):
    return _mart(spark, sf, "stores")


def q_mart_items(spark, sf):
    return _mart(spark, sf, "items")


def q_mart_transactions(spark, sf):
    return _mart(spark, sf, "transactions")


# --- features ---------------------------------------------------------------------------

def _names(spark, sf):
    return sales(spark, sf).select("name").distinct()


def q_store_name_normalized(spark, sf):
    return _names(spark, sf).select(
        "name", normalize_store_name(F.col("name"), STORE_NAME_REWRITES).alias("normalized"))


def q_classify_store_format(spark, sf):
    normalized = q_store_name_normalized(spark, sf).select("normalized").distinct()
    return normalized.select("normalized", classify_ordered(
        F.col("normalized"), STORE_FORMATS, STORE_FORMAT_EXACT, STORE_FORMAT_DEFAULT)
        .alias("store_format"))


def q_classify_by_dictionary(spark, sf):
    """Store names classified by a dictionary that is read from a file when the query runs."""
    path = scratch_path(spark, "formats")
    sinks.write_dictionary(src.lookup_df(spark, STORE_FORMATS), path)
    formats = src.as_mapping(src.read_dictionary(spark, path))
    normalized = q_store_name_normalized(spark, sf).select("normalized").distinct()
    return normalized.select("normalized", first_match(F.col("normalized"), formats, STORE_FORMAT_DEFAULT).alias("store_format"))


def q_store_format(spark, sf):
    return _stores_with_format(spark, sf)


def q_liquor_type_lookup(spark, sf):
    cats = sales(spark, sf).select("category").distinct()
    return cats.select("category", ft.liquor_type(F.col("category")).alias("liquor_type"))


def q_liquor_type(spark, sf):
    return ft.add_liquor_type(md.dim_items(clean(spark, sf)))


def q_title_case(spark, sf):
    places = sales(spark, sf).select("city", "county", "address").distinct()
    return places.select("city", "county", "address",
                         py_title(F.col("city")).alias("city_title"),
                         py_title(F.col("county")).alias("county_title"),
                         py_title(F.col("address")).alias("address_title"))


def q_address_title(spark, sf):
    return sales(spark, sf).select("address").distinct().select(
        "address", title_except_numbers(F.col("address")).alias("address_words"))


def q_address_clean(spark, sf):
    return sales(spark, sf).select("address").distinct().select(
        "address", clean_address(F.col("address"), DIRECTIONS).alias("address_clean"))


def q_full_address(spark, sf):
    return ft.add_full_address(md.dim_stores(clean(spark, sf)))


def q_transaction_metrics(spark, sf):
    return mt.add_metrics(md.fact_transactions(clean(spark, sf)))


# --- run log ----------------------------------------------------------------------------

def _fy_counts(spark, sf):
    return clean(spark, sf).groupBy(fiscal_year(F.col("date")).alias("financial_year")) \
                           .agg(F.count(F.lit(1)).alias("n_rows"))


def q_table_stats(spark, sf):
    return rl.table_stats(clean(spark, sf))


def q_new_records(spark, sf):
    runs = _fy_counts(spark, sf)
    # one run per fiscal year; each run's table holds every row up to that year
    log = runs.select("financial_year",
                      F.sum("n_rows").over(Window.orderBy("financial_year")
                                           .rowsBetween(Window.unboundedPreceding, 0))
                      .cast("long").alias("record_count"))
    return rl.new_records(log, order_col="financial_year")


def q_format_duration(spark, sf):
    runs = _fy_counts(spark, sf)
    secs = div_round(F.col("n_rows").cast("decimal(20,0)") * F.lit(REFERENCE_RUN_SECONDS).cast("decimal(10,3)"),
                     3, F.lit(REFERENCE_RUN_ROWS), 0, 3)
    return runs.select("financial_year", "n_rows", secs.cast("decimal(20,3)").alias("reference_seconds"),
                       rl.format_duration(secs).alias("total_duration"))


def q_run_log_row(spark, sf):
    return rl.run_log_row(rl.table_stats(clean(spark, sf)), RUN_START, RUN_END)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
