"""Dimensional model: stores, items (latest version per key), fact, build-all.

``latest_per_key`` is an aggregate, not a window: ``max(struct(order..., payload...))``
per key. Its partial step runs before the shuffle, so a key with a third of all rows
still contributes one row per map task, and no task ever sorts a whole key group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.calendar import calendar, calendar_for
from salesmart.operators.quality import check_fk, table_exists
from salesmart.schema import CALENDAR_END, CALENDAR_START, FACT_COLUMNS
from salesmart.sources.sinks import refresh_table, restore_table

LATEST_ORDER = ("date", "invoice_line_no", "itemno")


def latest_per_key(df: DataFrame, key: str, order_cols: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """One row per key: the payload of the greatest row by ``order_cols`` (descending,
    nulls last), ties broken by the payload itself."""
    return _latest_rows(latest_state(df, key, order_cols, payload), key, payload)


def latest_state(df: DataFrame, key: str, order_cols: Sequence[str],
                 payload: Sequence[str]) -> DataFrame:
    """Per key the greatest (order, payload) struct, ``latest``. States of parts of a table merge
    (``merge_latest``) to the state of the whole, since a maximum of maxima is the maximum."""
    rank = F.struct(*[F.col(c) for c in list(order_cols) + [p for p in payload if p not in order_cols]])
    return df.groupBy(key).agg(F.max(rank).alias("latest"))


def merge_latest(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.unionByName(b).groupBy(key).agg(F.max("latest").alias("latest"))


def _latest_rows(state: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    return state.select(key, *[F.col(f"latest.{p}").alias(p) for p in payload])


STORE_PAYLOAD = ("name", "address", "zipcode", "city", "county")
ITEM_PAYLOAD = ("im_desc", "category", "category_name", "vendor_name")


def update_dimensions(batch: DataFrame, base: str,
                      order_cols: Sequence[str] = LATEST_ORDER) -> dict[str, DataFrame]:
    """Stores and items brought up to date with newly loaded sales: only the batch and the stored
    state (a row per key, under ``base``) are read, never the layer. Late and repeated batches give
    the same dimensions as a rebuild from all sales, in whatever order they come."""
    spark = batch.sparkSession
    out = {}
    for name, key, payload, rows in (("stores", "store", STORE_PAYLOAD, store_rows),
                                     ("items", "itemno", ITEM_PAYLOAD, item_rows)):
        path = f"{base.rstrip('/')}/{name}_state"
        state = latest_state(batch, key, order_cols, payload)
        restore_table(spark, path)
        if table_exists(spark, path):
            state = merge_latest(spark.read.schema(state.schema).parquet(path), state, key)
        refresh_table(state, path)
        out[name] = rows(_latest_rows(spark.read.schema(state.schema).parquet(path), key, payload))
    return out


def dim_stores(sales: DataFrame, order_cols: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Stores: latest name and address per store (SCD type 1)."""
    return store_rows(latest_per_key(sales, "store", order_cols, STORE_PAYLOAD))


def store_rows(latest: DataFrame) -> DataFrame:
    return latest.select(F.col("store").alias("store_id"), F.col("name").alias("store_name"),
                         "address", F.col("zipcode").cast("string").alias("zipcode"),
                         "city", "county")


def dim_items(sales: DataFrame, order_cols: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Items: latest description, category and vendor per item."""
    return item_rows(latest_per_key(sales, "itemno", order_cols, ITEM_PAYLOAD))


def item_rows(latest: DataFrame) -> DataFrame:
    return latest.select(F.col("itemno").alias("item_id"), F.col("im_desc").alias("item_name"),
                         F.col("category").alias("category_code"),
                         F.col("category_name").alias("category"),
                         F.col("vendor_name").alias("vendor"))


def distinct_items(sales: DataFrame) -> DataFrame:
    """Every distinct item attribute tuple, sorted by item (shows items with versions)."""
    return (sales.select(F.col("itemno").alias("item_id"), F.col("im_desc").alias("item_name"),
                         F.col("category").alias("category_code"),
                         F.col("category_name").alias("category"),
                         F.col("vendor_name").alias("vendor"))
                 .distinct().orderBy("item_id", "item_name", "category_code", "category", "vendor"))


def fact_transactions(sales: DataFrame) -> DataFrame:
    """Transactions fact: eight renamed columns."""
    return sales.select(F.col("invoice_line_no").alias("invoice_line_id"), "date",
                        F.col("store").alias("store_id"), F.col("itemno").alias("item_id"),
                        "bottle_volume_ml", F.col("state_bottle_cost").alias("bottle_cost"),
                        F.col("state_bottle_retail").alias("bottle_price"), "sale_bottles")


def write_fact(fact: DataFrame, path: str, partitions: int | None = None,
               then: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write the fact range-partitioned and sorted by date and invoice line, so date
    predicates skip files and row groups by their min/max statistics.

    The range key includes the invoice line, so the sampled bounds can split a date that
    holds a large share of all rows across several tasks and files. Without
    ``partitions`` the count is ``spark.sql.shuffle.partitions`` (sized by the deployment
    for its data volume), not the core count. ``then`` (for example the metrics) is a
    row-wise projection applied after the sort: the range sampler then evaluates only the
    plain fact columns, and the projection keeps the sort order.
    """
    keys = ["date", "invoice_line_id"]
    ranged = fact.repartitionByRange(partitions, *keys) if partitions else fact.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys)
    (then(ordered) if then else ordered).write.mode("overwrite").parquet(path)


def build_model(sales: DataFrame, calendar_start: str | None = CALENDAR_START,
                calendar_end: str | None = CALENDAR_END) -> dict[str, DataFrame]:
    """Calendar, stores, items, fact and the three foreign-key checks.

    With ``calendar_start``/``calendar_end`` set to None the calendar covers the whole
    years of the data.
    """
    if calendar_start and calendar_end:
        cal = calendar(sales.sparkSession, calendar_start, calendar_end)
    else:
        cal = calendar_for(sales)
    stores, items, fact = dim_stores(sales), dim_items(sales), fact_transactions(sales)
    return {
        "calendar": cal,
        "stores": stores,
        "items": items,
        "transactions": fact,
        "fk_store": check_fk(fact, stores, "store_id", "store_id"),
        "fk_item": check_fk(fact, items, "item_id", "item_id"),
        "fk_date": check_fk(fact, cal, "date", "date"),
    }


def model_counts(model: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for every table and check of ``build_model``; for the checks
    the count is the number of orphan fact rows."""
    parts = []
    for name, df in model.items():
        if name.startswith("fk_"):
            parts.append(df.agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).cast("long").alias("n_rows"))
                           .select(F.lit(name).alias("table_name"), "n_rows"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                           .select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


__all__ = ["latest_per_key", "latest_state", "merge_latest", "update_dimensions", "dim_stores", "dim_items", "distinct_items", "fact_transactions",
           "write_fact", "build_model", "model_counts", "FACT_COLUMNS"]
