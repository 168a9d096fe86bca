"""Run log: table statistics, new-record deltas, duration text, log rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import RUN_LOG_SCHEMA


def table_stats(df: DataFrame, col: str = "date") -> DataFrame:
    """Row count and first/last date in one pass."""
    return df.agg(F.count(F.lit(1)).alias("record_count"),
                  F.min(col).alias("data_start_date"), F.max(col).alias("data_end_date"))


def new_records(log: DataFrame, order_col: str = "process_start_time",
                count_col: str = "record_count") -> DataFrame:
    """``new_records_added`` = record count minus the previous run's; 0 for the first run.

    The log has one row per run, so its single ordered window is tiny.
    """
    w = Window.orderBy(F.col(order_col))
    prev = F.lag(F.col(count_col)).over(w)
    return log.withColumn("new_records_added",
                          F.coalesce(F.col(count_col) - prev, F.lit(0)).cast("long"))


def format_duration(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS.sss`` (hours keep growing past 99)."""
    s = seconds.cast(T.DecimalType(38, 6))
    hours = F.floor(s / 3600)
    rest = s - hours * 3600
    minutes = F.floor(rest / 60)
    secs = (rest - minutes * 60).cast("double")
    return F.format_string("%02d:%02d:%06.3f", hours.cast("long"), minutes.cast("long"), secs)


def _wall_clock(t: dt.datetime) -> Column:
    """A naive datetime as a timestamp without time zone (no session-zone shift)."""
    return F.to_timestamp_ntz(F.lit(t.isoformat(sep=" ")))


def run_log_row(stats: DataFrame, start: dt.datetime, end: dt.datetime,
                previous: DataFrame | None = None) -> DataFrame:
    """One log row from table stats and run times; new records are counted against the
    last logged run (0 when there is none)."""
    seconds = F.lit((end - start).total_seconds()).cast(T.DecimalType(20, 6))
    row = stats.select(
        F.lit(end.date()).alias("execution_date"),
        _wall_clock(start).alias("process_start_time"),
        _wall_clock(end).alias("process_end_time"),
        format_duration(seconds).alias("total_duration"),
        "data_start_date", "data_end_date",
        F.col("record_count").cast("long").alias("record_count"),
        F.lit(True).alias("_new"))
    log = row
    if previous is not None:
        cols = [f.name for f in RUN_LOG_SCHEMA.fields if f.name != "new_records_added"]
        log = previous.select(*cols, F.lit(False).alias("_new")).unionByName(row)
    return new_records(log).filter(F.col("_new")).drop("_new")


def append_run_log(row: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append log rows; ``fmt="csv"`` keeps a headered CSV log (each appended part file
    carries its header, so readers see one table)."""
    out = row.select(*[f.name for f in RUN_LOG_SCHEMA.fields]).coalesce(1).write.mode("append")
    if fmt == "csv":
        out.option("header", True).csv(path)
    else:
        out.format(fmt).save(path)


def read_run_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(RUN_LOG_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)
