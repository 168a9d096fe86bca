"""Schema and constraint operators as data-quality queries.

Checks return small reports (offending keys with counts), never the offending fact rows,
so their output is bounded by the number of distinct keys and each check pre-aggregates
the large side before it meets the small one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import SALES_SCHEMA


# --- C2 / C6: layers and model reset -------------------------------------------------

def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def rename_table(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _hadoop_path(spark, path)
    if not fs.rename(p, _hadoop_path(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def delete_table(spark: SparkSession, path: str) -> bool:
    """Delete a table folder if it is there."""
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def create_empty_table(spark: SparkSession, path: str, schema: T.StructType,
                       fmt: str = "parquet") -> None:
    """Create an empty table with ``schema`` at ``path`` unless it exists."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("errorifexists").format(fmt).save(path)


def create_like(spark: SparkSession, source_path: str, path: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE path LIKE source_path``: same columns and types, no rows."""
    schema = spark.read.format(fmt).load(source_path).schema
    create_empty_table(spark, path, schema, fmt)


def create_layers(spark: SparkSession, base: str, schema: T.StructType = SALES_SCHEMA) -> dict[str, str]:
    """Staging and integration sales layers with the same declared shape (integration is
    created like staging), each partitioned by sale month."""
    from salesmart.sources.layers import create_layer
    base = base.rstrip("/")
    paths = {"staging": f"{base}/stg/sales", "integration": f"{base}/int/sales"}
    for path in paths.values():
        create_layer(spark, path, schema)
    return paths


def reset_model(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Drop derived tables before a rebuild (``DROP TABLE IF EXISTS``). Names without '/'
    are catalog tables; others are table folders. Returns what was dropped."""
    dropped = []
    for path in paths:
        if "/" not in path:
            spark.sql(f"DROP TABLE IF EXISTS {path}")
            dropped.append(path)
            continue
        if delete_table(spark, path):
            dropped.append(path)
    return dropped


# --- C1 / C7: declared shape -----------------------------------------------------------

def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Replace the column if it exists, else add it."""
    return df.withColumn(name, expr)


def schema_report(df: DataFrame) -> DataFrame:
    """Column listing (position, name, type) as a frame; the schema is on the driver."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


# --- C3 / C4 / C5: key and null checks -------------------------------------------------

def check_unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Key values occurring more than once, with their row counts."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def check_fk(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values of ``fact`` (non-null) missing from ``dim``, with row counts.

    The fact is reduced to its distinct key values first (partial aggregate), so the
    anti join only sees one row per key value.
    """
    keys = (fact.filter(F.col(fk).isNotNull())
                .groupBy(fk).agg(F.count(F.lit(1)).alias("orphan_rows")))
    dim_keys = dim.select(F.col(pk).alias(fk))
    return keys.join(dim_keys, fk, "left_anti")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults: a null takes the default value (cast to the column type)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fixed = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])).alias(c)
             for c, v in defaults.items() if c in types}
    return df.select(*[fixed.get(c, F.col(c)) for c in df.columns])


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count per listed column, one pass: (column_name, null_rows)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "null_rows")


# --- C8: keyed update -------------------------------------------------------------------

def update_from(df: DataFrame, updates: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Set ``cols`` from ``updates`` where the key matches.

    An existing column keeps its old value on unmatched rows; a new column is null there.
    ``updates`` is reduced to one row per key first (the largest row, so the choice is
    deterministic). The join broadcasts the lookup rows of the heaviest keys of ``df`` (``joins.skew_safe_left_join``),
    so a key shared by a large share of the rows is split across tasks.
    """
    from salesmart.operators.joins import skew_safe_left_join
    one = (updates.groupBy(key)
                  .agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("_u")))
    upd = one.select(F.col(key), F.lit(True).alias("_matched"),
                     *[F.col(f"_u.{c}").alias(f"_new_{c}") for c in cols])
    joined = skew_safe_left_join(df, upd, key)
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    out = []
    for c in df.columns:
        if c in cols:
            out.append(F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [F.col(f"_new_{c}").alias(c) for c in cols if c not in df.columns]
    return joined.select(*out)
