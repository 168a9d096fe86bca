"""Readers: raw text records, headered CSV, mart tables and small lookup dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import RAW_SALES_SCHEMA, SALES_COLUMNS


def read_raw_sales(spark: SparkSession, path: str | Sequence[str], fmt: str = "json") -> DataFrame:
    """Raw sales records as 18 text columns.

    The explicit all-string schema means no inference pass over the files, an absent field
    reads as null and unknown fields are ignored. Dates and numbers stay text until the
    cleaning step.
    """
    reader = spark.read.schema(RAW_SALES_SCHEMA)
    if fmt == "json":
        return reader.json(path)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


#: Text of a record that is not proper JSON; null for every other record.
CORRUPT = "corrupt_record"
SOURCE_FILE = "source_file"


def landing_schema(month_col: str | None = None) -> T.StructType:
    """Raw fields, the corrupt-record column and, where the landing has one, the month folder."""
    more = [T.StructField(CORRUPT, T.StringType())]
    if month_col:
        more.append(T.StructField(month_col, T.StringType()))
    return T.StructType(RAW_SALES_SCHEMA.fields + more)


def read_landing(spark: SparkSession, path: str | Sequence[str], month_col: str | None = None,
                 stream_files: int | None = None, stream: bool = False) -> DataFrame:
    """Landed JSON lines with nothing lost: the raw fields as text, ``corrupt_record`` with the whole
    line where it is no proper record, and ``source_file``. A stream with ``stream``."""
    reader = spark.readStream if stream else spark.read
    if stream and stream_files:
        reader = reader.option("maxFilesPerTrigger", stream_files)
    reader = (reader.schema(landing_schema(month_col)).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    return reader.json(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def select_sales(df: DataFrame, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Keep the selected sales columns; on a file scan Catalyst prunes the rest."""
    return df.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV. Without a schema the types are inferred (one extra pass over the data)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A mart table by path (any name with a '/') or by catalog name, pruned to ``columns``."""
    df = spark.read.format(fmt).load(table) if "/" in table else spark.table(table)
    return df.select(*columns) if columns else df


def lookup_df(spark: SparkSession, mapping: Mapping | Sequence[tuple]) -> DataFrame:
    """A dictionary as a (pos, key, value) frame; ``pos`` keeps the dictionary order."""
    items = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    rows = [(i, str(k), None if v is None else str(v)) for i, (k, v) in enumerate(items)]
    schema = "pos int, key string, value string"
    return spark.createDataFrame(rows, schema)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary written by ``write_lookup``, back as (pos, key, value)."""
    return spark.read.schema("pos int, key string, value string").json(path)


#: A dictionary is configuration; one that is larger than this is data and has to be joined.
MAX_DICTIONARY = 10_000


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object, on however many lines, as (pos, key, value) in the object's own order. Values
    come as text (a null stays null, a nested value is its JSON); a key that is repeated keeps both
    rows. Text that is no object is an error."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select("value", F.from_json("value", "map<string,string>").alias("entries"))
    checked = parsed.select(F.coalesce(F.map_entries("entries"), F.raise_error(
        F.concat(F.lit("no JSON object: "), F.substring("value", 1, 80))).cast("array<struct<key:string,value:string>>"))
        .alias("entries"))
    rows = checked.select(F.posexplode("entries").alias("pos", "entry"))
    return rows.select("pos", F.col("entry.key").alias("key"), F.col("entry.value").alias("value"))


def as_mapping(dictionary: DataFrame) -> dict[str, str]:
    """A (pos, key, value) frame as a mapping in order, for the operators that take one. At most
    ``MAX_DICTIONARY`` entries; the last of a repeated key counts, as in a JSON parser."""
    rows = dictionary.orderBy("pos").limit(MAX_DICTIONARY + 1).collect()
    if len(rows) > MAX_DICTIONARY:
        raise ValueError(f"a dictionary has at most {MAX_DICTIONARY} entries; join larger ones")
    return {r.key: r.value for r in rows}
