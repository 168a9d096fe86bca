"""Writers: mart tables, CSV, dictionaries and raw landing files.

Every writer commits once per Spark job through the output committer; a lost executor
only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.session import shuffles_dropped

#: Suffixes of a table that is being written and of the one it replaces.
NEW, OLD = ".new", ".old"
#: Records of a landing file. A compressed file is read by one task, so this bounds the task.
LANDING_FILE_ROWS = 500_000


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet") -> None:
    """Full refresh of a derived table: written aside, checked, then swapped in (``refresh_tables``),
    so ``df`` may read the table itself."""
    refresh_tables(df.sparkSession, {path: lambda to: write_checked(df, to, partition_by, fmt)})


def refresh_tables(spark: SparkSession, writers: Mapping[str, Callable[[str], None]]) -> None:
    """Refresh the tables of some paths together. Each writer is given the path to write to, beside
    the table; no table is touched before all of them ended. If one fails, every old table stays. A
    swap that was interrupted between its two renames is mended by the next refresh or by
    ``restore_table``: the old table is then still there under its own name with ``OLD``."""
    from salesmart.operators.quality import delete_table, rename_table, table_exists
    paths = [p.rstrip("/") for p in writers]
    for path, write in zip(paths, writers.values()):
        restore_table(spark, path)
        delete_table(spark, path + NEW)
        write(path + NEW)
    for path in paths:
        if table_exists(spark, path):
            delete_table(spark, path + OLD)
            rename_table(spark, path, path + OLD)
        rename_table(spark, path + NEW, path)
    for path in paths:
        delete_table(spark, path + OLD)


def restore_table(spark: SparkSession, path: str) -> bool:
    """Put back the old table where a swap took it away and did not end."""
    from salesmart.operators.quality import rename_table, table_exists
    path = path.rstrip("/")
    if table_exists(spark, path) or not table_exists(spark, path + OLD):
        return False
    rename_table(spark, path + OLD, path)
    return True


def write_checked(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet") -> None:
    """Write a new table; an error unless it reads back with as many rows as the tasks wrote."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    found = df.sparkSession.read.schema(df.schema).format(fmt).load(path).count()
    if found != (seen.get.get("n") or 0):
        raise RuntimeError(f"{path}: {seen.get.get('n')} rows written, {found} read back")


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 fmt: str = "parquet") -> None:
    writer = df.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV. Each part file carries its own header, so appends stay readable."""
    df.write.mode(mode).option("header", True).csv(path)


def write_lookup(df: DataFrame, path: str) -> None:
    """A derived dictionary (pos, key, value) as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_dictionary(df: DataFrame, path: str) -> None:
    """A derived dictionary (pos, key, value) as one JSON object in the order of ``pos``, for
    ``read_dictionary`` and any JSON reader. A dictionary has few entries, which meet in one row."""
    def quoted(c: str):
        return F.regexp_replace(F.to_json(F.array(F.col(f"e.{c}"))), r"^\[|\]$", "")

    entries = df.select(F.struct("pos", "key", "value").alias("e")).select(
        "e", F.concat(quoted("key"), F.lit(": "), F.coalesce(quoted("value"), F.lit("null"))).alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("e.pos", "line"))), lambda x: x["line"])
    (entries.agg(F.concat(F.lit("{\n    "), F.array_join(lines, ",\n    "), F.lit("\n}")).alias("value"))
     .coalesce(1).write.mode("overwrite").text(path))


def write_raw_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw text records as JSON lines in gzip files of bounded length; null fields are left out, as an
    API omits them. Field names and repeated values make plain lines about ten times as long."""
    with shuffles_dropped(df.sparkSession):
        (df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", LANDING_FILE_ROWS)
         .json(path))
