"""Profiling: duplicates, missing values, placeholder and type inference, describe.

Whole-table and per-column statistics are single global aggregation passes: every column
gets its own aggregate buffers (no row expansion, no grouping by column name), each task
aggregates its split and only one partial row per task is merged. The one-row result is
then reshaped into one row per column. Buffers are bounded: counts, flags, a mode over at
most 20 digit counts, and (for exact quartiles) one count per distinct value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numeric import div_round, percent, text_to_long, to_double
from salesmart.operators.digests import row_digest
from salesmart.operators.staged import distinct_rows
from salesmart.session import scratch_path
from salesmart.schema import DIMENSION_COLUMNS, MEASURE_COLUMNS, NUMERIC_TYPES


#: Rows of more columns than this are compared by digest.
WIDE_COLUMNS = 4


# --- P1 / P2 / P3: duplicates -------------------------------------------------------------

def duplicate_stats(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier full row (null equals null): count and percent. Wide rows are
    grouped by their digest, so that the shuffle holds two numbers a row."""
    keys = row_digest(df) if len(df.columns) > WIDE_COLUMNS else [F.col(f"`{c}`") for c in df.columns]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = groups.agg(F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("dup_rows"))
    return totals.select(F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                         F.coalesce("dup_rows", F.lit(0)).cast("long").alias("dup_rows"),
                         percent(F.col("dup_rows"), F.col("n_rows")).alias("pct_dup"))


def drop_full_duplicates(df: DataFrame, scratch: str | None = None) -> DataFrame:
    """One row per distinct full row (copies collapse map-side before the shuffle). With ``scratch``, a
    folder in shared storage, the rows are written there once and only their digests are shuffled."""
    return distinct_rows(df, scratch) if scratch else df.distinct()


def key_collision_count(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once, every copy counted."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
                       .cast("long").alias("key_collision_rows"))


# --- P4: missing values ----------------------------------------------------------------

def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percent of rows per column, only columns with nulls."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot(["_rows"], cols, "column_name", "missing_values")
    return (long.filter(F.col("missing_values") > 0)
                .select("column_name", F.col("missing_values").cast("long").alias("missing_values"),
                        percent(F.col("missing_values"), F.col("_rows")).alias("pct_of_total")))


# --- P5: placeholders -------------------------------------------------------------------

def _per_column(row: DataFrame, fields: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """Reshape a one-row aggregate into one row per column: ``fields`` maps a column name to
    (output name, expression over the aggregate row) pairs."""
    items = [F.struct(F.lit(c).alias("column_name"), *[e.alias(n) for n, e in exprs])
             for c, exprs in fields.items()]
    return row.select(F.inline(F.array(*items)))


def _agg_name(c: str, what: str) -> str:
    return f"__{what}__{c}"


def derive_placeholders(df: DataFrame, cols: Sequence[str] = DIMENSION_COLUMNS) -> DataFrame:
    """Placeholder per column: when every non-null value is an integer, '9' repeated by the
    most common digit count (the smaller count wins a tie); otherwise 'UNKNOWN'."""
    # parse each value once: null for a null, -1 for non-integer text, else its digit count
    parsed = []
    for c in cols:
        v = F.col(c).cast("string")
        parsed.append(F.when(v.isNotNull(), F.coalesce(F.length(text_to_long(v).cast("string")),
                                                       F.lit(-1))).alias(c))
    digits = df.select(*parsed)
    aggs = []
    for c in cols:
        d = F.col(c)
        aggs.append(F.count_if(d == -1).alias(_agg_name(c, "bad")))
        aggs.append(F.mode(F.when(d > 0, d), True).alias(_agg_name(c, "mode")))
    row = digits.agg(*aggs)
    fields = {}
    for c in cols:
        bad, mode = F.col(_agg_name(c, "bad")), F.col(_agg_name(c, "mode"))
        fields[c] = [("placeholder", F.when((bad > 0) | mode.isNull(), F.lit("UNKNOWN"))
                      .otherwise(F.repeat(F.lit("9"), mode)))]
    return _per_column(row, fields)


# --- P6 / P7: type checks -----------------------------------------------------------------

def is_date_castable(df: DataFrame, col: str = "date") -> DataFrame:
    """True when every non-null value parses as a timestamp."""
    ok = F.col(col).isNull() | F.try_to_timestamp(F.col(col).cast("string")).isNotNull()
    return df.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("date_castable"))


def infer_numeric_types(df: DataFrame, exclude: Sequence[str] = ("date",)) -> DataFrame:
    """Text columns that are fully numeric: 'int' when every value is whole, else 'float'.

    A null, or any text that is not a finite number, makes the column non-numeric; such
    columns are not listed.
    """
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    numbers = df.select(*[to_double(F.col(c)).alias(c) for c in cols])   # parsed once
    aggs = []
    for c in cols:
        number = F.col(c)
        aggs.append(F.coalesce(F.bool_and(number.isNotNull()), F.lit(False)).alias(_agg_name(c, "num")))
        aggs.append(F.bool_and(F.coalesce(number % 1 == 0, F.lit(False))).alias(_agg_name(c, "whole")))
    row = numbers.agg(*aggs)
    fields = {c: [("numeric", F.col(_agg_name(c, "num"))),
                  ("dtype", F.when(F.col(_agg_name(c, "whole")), F.lit("int")).otherwise(F.lit("float")))]
              for c in cols}
    return _per_column(row, fields).filter(F.col("numeric")).select("column_name", "dtype")


def to_numeric(df: DataFrame, cols: Sequence[str] = MEASURE_COLUMNS,
               types: Mapping[str, str] = NUMERIC_TYPES) -> DataFrame:
    """Text measures to numbers: bigint when the column is 'int', else double."""
    def conv(c: str) -> Column:
        d = to_double(F.col(c))
        return d.cast("long") if types.get(c) == "int" else d
    converted = {c: conv(c).alias(c) for c in cols}
    return df.select(*[converted.get(c, F.col(c)) for c in df.columns])


# --- P8 / P9 / P10: describe and measure checks ------------------------------------------

QUARTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact quantiles with linear interpolation: (column_name, prob, value double).

    No task ever holds a column: values are counted (partial aggregation), and the counts are
    written in ranges of (column, value), so that equal parts of all distinct values lie in each.
    The parts' totals tell which part holds each rank that a quantile needs, and only in those
    parts, two for each quantile at most, counts are summed up to the rank. Columns without values
    give no rows.
    """
    spark = df.sparkSession
    number = T.DecimalType(38, 6)
    stacked = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast(number).alias("value"))
                                           for c in cols)))).filter(F.col("value").isNotNull())
    path = scratch_path(spark, "value-counts")
    (stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
     .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "column_name", "value")
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    counts = spark.read.schema("column_name string, value decimal(38,6), n long, part int").parquet(path)
    # a row for each column and part: the ranks it holds are [before, before + n)
    upto = Window.partitionBy("column_name").orderBy("part")
    parts = (counts.groupBy("column_name", "part").agg(F.sum("n").alias("n"))
             .select("column_name", "part", F.sum("n").over(upto).alias("end"), F.col("n").alias("inside"))
             .withColumn("before", F.col("end") - F.col("inside")))
    edges = []                                           # the ranks below and above the place, by nearness
    for p in probs:
        at = (F.col("total") - 1) * F.lit(float(p))
        above = at - F.floor(at)
        edges += [F.struct(F.lit(float(p)).alias("prob"), rank.cast("long").alias("rank"), weight.alias("weight"))
                  for rank, weight in ((F.floor(at), 1 - above), (F.floor(at) + 1, above))]
    ranks = (parts.groupBy("column_name").agg(F.max("end").alias("total"))
             .select("column_name", F.inline(F.array(*edges))).filter(F.col("weight") > 0))
    wanted = (ranks.join(parts, "column_name").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("end")))
              .select("column_name", "part", "prob", "rank", "weight", "before"))
    within = Window.partitionBy("column_name", "prob", "rank", "weight").orderBy("value")
    reached = (counts.join(wanted, ["column_name", "part"])
               .withColumn("end", F.col("before") + F.sum("n").over(within))
               .filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))))
    return (reached.groupBy("column_name", "prob")
            .agg(F.sum(F.col("value").cast("double") * F.col("weight")).alias("value")))


def describe(df: DataFrame, cols: Sequence[str] = MEASURE_COLUMNS, scale: int = 4,
             approx_accuracy: int | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    Mean, quartiles and std are shown at ``scale`` decimals; the mean is the exact sum over
    the count, rounded once. Quartiles are exact and distributed (see ``exact_quantiles``, which
    writes the value counts to the shared folder); with ``approx_accuracy`` a bounded quantile
    sketch in the same pass gives them instead (rank error about 1/accuracy).
    """
    common = T.DecimalType(38, 6)
    out = T.DecimalType(38, scale)
    aggs = []
    for c in cols:
        v = F.col(c).cast(common)
        aggs += [F.count(v).alias(_agg_name(c, "n")), F.sum(v).alias(_agg_name(c, "sum")),
                 F.stddev_samp(v.cast("double")).alias(_agg_name(c, "std")),
                 F.min(v).alias(_agg_name(c, "min")), F.max(v).alias(_agg_name(c, "max"))]
        if approx_accuracy:
            aggs.append(F.percentile_approx(v.cast("double"), list(QUARTILES), approx_accuracy).alias(_agg_name(c, "q")))
    row = df.agg(*aggs)
    fields = {}
    for c in cols:
        n = F.col(_agg_name(c, "n"))
        fields[c] = [
            ("count", n),
            ("mean", div_round(F.col(_agg_name(c, "sum")), 6, n, 0, scale, out)),
            ("std", F.col(_agg_name(c, "std")).cast(out)),
            ("min", F.col(_agg_name(c, "min")).cast(out)),
            ("max", F.col(_agg_name(c, "max")).cast(out))]
        if approx_accuracy:
            fields[c].append(("q", F.col(_agg_name(c, "q"))))
    found = _per_column(row, fields).filter(F.col("count") > 0)
    if not approx_accuracy:
        # one row for each column
        quartiles = exact_quantiles(df, cols).groupBy("column_name").agg(
            F.array(*(F.max(F.when(F.col("prob") == p, F.col("value"))) for p in QUARTILES)).alias("q"))
        found = found.join(quartiles, "column_name")
    return found.select("column_name", "count", "mean", "std", "min",
                        *(F.col("q")[i].cast(out).alias(name) for i, name in enumerate(("p25", "p50", "p75"))), "max")


def pct_where(df: DataFrame, cond: Column, name: str = "pct") -> DataFrame:
    """Percent of rows meeting ``cond``."""
    return df.agg(percent(F.count_if(F.coalesce(cond, F.lit(False))),
                          F.count(F.lit(1))).alias(name))


# --- P12 to P17: inspection -------------------------------------------------------------

def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def filter_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose text contains ``text``; nulls excluded."""
    return df.filter(F.col(col).contains(text))


def total_order(df: DataFrame, order: Sequence[str] | None = None) -> list[Column]:
    first = list(order or [])
    return [F.col(c).asc_nulls_first() for c in first + [c for c in df.columns if c not in first]]


def preview(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a total order (``order`` first, then all columns)."""
    return df.orderBy(*total_order(df, order)).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def sample_n(df: DataFrame, n: int = 100, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all rows when fewer): those with the least MD5 of seed and row text (columns
    joined by '|', a null as nothing), so the sample does not depend on how the rows are partitioned
    and any SQL engine can repeat it. Each task keeps its own ``n`` least, so only ``n`` rows per
    task reach the final merge."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *text).cast("binary")), *df.columns).limit(n)


def distinct_sorted(df: DataFrame, cols: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*(order or cols))


# --- one pass over raw records --------------------------------------------------------------

def profile_raw(raw: DataFrame, dims: Sequence[str] = DIMENSION_COLUMNS,
                placeholders: Mapping[str, object] | None = None,
                exclude: Sequence[str] = ("date",)) -> dict[str, DataFrame]:
    """Missing values, placeholder derivation and numeric type inference of raw text
    records from a single scan (the same results as the three operators run separately;
    numeric types are inferred after placeholder filling, as in the cleaning order).

    The aggregate is one row with a few values per column, so it is brought to the driver
    and reshaped there into three small frames.
    """
    from salesmart.schema import PLACEHOLDERS
    placeholders = PLACEHOLDERS if placeholders is None else placeholders
    spark = raw.sparkSession
    text_cols = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    typed = [c for c in text_cols if c not in exclude]
    parsed = [F.col(c).isNull().alias(f"n_{i}") for i, c in enumerate(raw.columns)]
    for i, c in enumerate(dims):
        v = F.col(c).cast("string")
        parsed.append(F.when(v.isNotNull(), F.coalesce(F.length(text_to_long(v).cast("string")),
                                                       F.lit(-1))).alias(f"d_{i}"))
    for i, c in enumerate(typed):
        filled = F.coalesce(F.col(c), F.lit(str(placeholders[c]))) if c in placeholders else F.col(c)
        parsed.append(to_double(filled).alias(f"x_{i}"))
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(f"n_{i}")).alias(f"nulls_{i}") for i in range(len(raw.columns))]
    for i in range(len(dims)):
        d = F.col(f"d_{i}")
        aggs += [F.count_if(d == -1).alias(f"bad_{i}"), F.mode(F.when(d > 0, d), True).alias(f"mode_{i}")]
    for i in range(len(typed)):
        x = F.col(f"x_{i}")
        aggs += [F.coalesce(F.bool_and(x.isNotNull()), F.lit(False)).alias(f"num_{i}"),
                 F.bool_and(F.coalesce(x % 1 == 0, F.lit(False))).alias(f"whole_{i}")]
    row = raw.select(*parsed).agg(*aggs).first()

    missing = spark.createDataFrame(
        [(c, row[f"nulls_{i}"], row["rows"]) for i, c in enumerate(raw.columns) if row[f"nulls_{i}"]],
        "column_name string, missing_values long, rows long")
    missing = missing.select("column_name", "missing_values",
                             percent(F.col("missing_values"), F.col("rows")).alias("pct_of_total"))
    holders = spark.createDataFrame(
        [(c, "UNKNOWN" if row[f"bad_{i}"] or row[f"mode_{i}"] is None else "9" * row[f"mode_{i}"])
         for i, c in enumerate(dims)], "column_name string, placeholder string")
    types = spark.createDataFrame(
        [(c, "int" if row[f"whole_{i}"] else "float") for i, c in enumerate(typed) if row[f"num_{i}"]],
        "column_name string, dtype string")
    return {"missing_values": missing, "placeholders": holders, "numeric_types": types}
