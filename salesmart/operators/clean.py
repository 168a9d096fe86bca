"""Cleaning: placeholders, date parsing, typed casts, validity filter, conformance.

Each step is one projection or filter, so the whole cleaning chain fuses into the scan's
whole-stage-codegen stage; nothing here shuffles. The cleaning and the load parse every text
column once (``parsed_once``): filters and reject reasons read the parsed values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.dates import parse_api_date
from salesmart.functions.numeric import (INTEGER_PATTERN, NUMBER_PATTERN, int_via_float,
                                         is_number_text, to_double)
from salesmart.schema import (MEASURE_COLUMNS, MONEY, NUMERIC_TYPES, PLACEHOLDERS, SALES_COLUMNS,
                              SALES_KEY, SALES_SCHEMA)
from salesmart.sources.raw import CORRUPT

POSITIVE = "positive_money"
#: Measures that a valid sale has above zero.
POSITIVE_MEASURES = ("state_bottle_cost", "state_bottle_retail", "sale_bottles")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _placeholder_literal(value, dtype: T.DataType, column: str) -> Column:
    if isinstance(dtype, _NUMERIC) and isinstance(value, str):
        import re
        if not re.match(NUMBER_PATTERN, value):
            raise ValueError(f"placeholder {value!r} does not fit numeric column {column!r}")
    if isinstance(dtype, T.StringType):
        return F.lit(str(value))
    return F.lit(value).cast(dtype)


def fill_placeholders(df: DataFrame, placeholders: Mapping[str, object] = PLACEHOLDERS) -> DataFrame:
    """Replace nulls per column; each value takes its column's type (9999 fills a text
    column as '9999'). A text placeholder for a numeric column is an error."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fills = {c: F.coalesce(F.col(c), _placeholder_literal(v, types[c], c)).alias(c)
             for c, v in placeholders.items() if c in types}
    return df.select(*[fills.get(c, F.col(c)) for c in df.columns])


def normalize_date(df: DataFrame, col: str = "date") -> DataFrame:
    """Timestamp text to a date; unparseable text becomes null."""
    return df.withColumn(col, parse_api_date(F.col(col)))


def cast_by_map(df: DataFrame, type_map: Mapping[str, str] = NUMERIC_TYPES,
                float_type: T.DataType = MONEY) -> DataFrame:
    """Typed numbers from text. 'int' goes through a float ('12.0' -> 12, '12.7' -> 12),
    'float' becomes ``float_type`` directly. Text that is not a number becomes null."""
    def conv(c: str, kind: str) -> Column:
        col = F.col(c)
        if kind == "int":
            return int_via_float(col, "int")
        return F.when(is_number_text(col), col.try_cast(float_type))
    casts = {c: conv(c, k).alias(c) for c, k in type_map.items() if c in df.columns}
    return df.select(*[casts.get(c, F.col(c)) for c in df.columns])


def filter_positive(df: DataFrame,
                    cols: Sequence[str] = POSITIVE_MEASURES) -> DataFrame:
    """Keep rows where every listed measure is > 0 (a null measure drops the row)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > 0)
    return df.filter(F.coalesce(cond, F.lit(False)))


def money_positive(type_map: Mapping[str, str] = NUMERIC_TYPES,
                   cols: Sequence[str] = POSITIVE_MEASURES) -> Column:
    """Over text columns: every listed 'float' measure is > 0 before it is rounded to cents (a
    cost of 0.004 is valid and stored as 0.00). 'int' measures are tested once typed."""
    cond = F.lit(True)
    for c in cols:
        if type_map.get(c) == "float":
            cond = cond & F.coalesce(to_double(F.col(c)) > 0, F.lit(False))
    return cond


def filter_non_negative(df: DataFrame, col: str = "sale_bottles") -> DataFrame:
    """Profiling variant: keep rows with ``col >= 0`` (zero kept)."""
    return df.filter(F.col(col) >= 0)


def conform(df: DataFrame, schema: T.StructType = SALES_SCHEMA,
            reject_col: str | None = "_rejected") -> DataFrame:
    """Apply the declared column types with ``try_cast``; a value that does not convert
    becomes null and, when ``reject_col`` is given, flags the row."""
    out, bad = [], []
    for f in schema.fields:
        src = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            typed = parse_api_date(src.cast("string"))
        elif isinstance(f.dataType, T.StringType):
            typed = src.cast("string")
        else:
            # a failing try_cast on text is very slow (an exception per value), so text that
            # cannot be a number never reaches it
            text = src.cast("string")
            pattern = INTEGER_PATTERN if isinstance(f.dataType, _INTEGRAL) else NUMBER_PATTERN
            typed = F.when(text.rlike(pattern), text.try_cast(f.dataType))
        out.append(typed.alias(f.name))
        bad.append(src.isNotNull() & typed.isNull())
    if reject_col:
        flag = bad[0]
        for b in bad[1:]:
            flag = flag | b
        out.append(flag.alias(reject_col))
    return df.select(*out)


#: Numbers that one generator parses. HotSpot leaves methods over 8,000 bytes of bytecode to the interpreter, and
#: the parsing of all numbers in one is far above that.
PARSED_TOGETHER = 3


def _parse_number(text: Column, kind: str) -> Column:
    """The value of a number's text, null for other text, with one test of the text. For a 'float' it is
    (value, positive), positive before it is rounded to cents (see ``money_positive``)."""
    if kind == "int":
        value = text.try_cast("double").try_cast("int")
    else:
        value = F.struct(text.try_cast(MONEY).alias("value"), (text.try_cast("double") > 0).alias("positive"))
    return F.when(is_number_text(text), value)


def _with_generated(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns as ``_parsed_<name>``. The optimiser copies the expression of a projected column into
    each filter and expression above it, so a row would be parsed once for each of them. It does not merge a
    generator with what follows: ``inline`` of one struct gives each row back once, with the values computed."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(f"_parsed_{name}") for name, c in columns.items())))))


def parsed_once(df: DataFrame, type_map: Mapping[str, str] = NUMERIC_TYPES) -> DataFrame:
    """Add the parsed date and the parsed number of each column of ``type_map`` as ``_parsed_<column>``, each
    text parsed once. The date comes first: a filter on it alone is pushed below the numbers."""
    parsed = _with_generated(df, {"date": parse_api_date(F.col("date"))})
    numbers = [c for c in type_map if c in df.columns]
    for i in range(0, len(numbers), PARSED_TOGETHER):
        parsed = _with_generated(parsed, {c: _parse_number(F.col(c), type_map[c])
                                          for c in numbers[i:i + PARSED_TOGETHER]})
    return parsed


def _value(col: str, type_map: Mapping[str, str]) -> Column:
    return F.col(f"_parsed_{col}" if type_map[col] == "int" else f"_parsed_{col}.value")


def _positive(col: str, type_map: Mapping[str, str]) -> Column:
    positive = F.col(f"_parsed_{col}") > 0 if type_map[col] == "int" else F.col(f"_parsed_{col}.positive")
    return F.coalesce(positive, F.lit(False))


def _money_parsed_positive(type_map: Mapping[str, str], cols: Sequence[str] = POSITIVE_MEASURES) -> Column:
    cond = F.lit(True)
    for c in cols:
        if type_map.get(c) == "float":
            cond = cond & _positive(c, type_map)
    return cond


def clean_sales(raw: DataFrame, placeholders: Mapping[str, object] = PLACEHOLDERS,
                type_map: Mapping[str, str] = NUMERIC_TYPES) -> DataFrame:
    """Raw text records to typed, valid sales: placeholders, date, numeric casts, then the
    positive-measure filter, which tests money before it is rounded to cents. Records that
    cannot be typed (see ``typed_with_rejects``) are left out. Full-row duplicates are kept;
    the load step resolves keys."""
    parsed = parsed_once(fill_placeholders(raw, placeholders), type_map)
    numbers = [c for c in type_map if c in raw.columns]
    typable = F.col("_parsed_date").isNotNull()
    for c in numbers:
        typable = typable & _value(c, type_map).isNotNull()
    for c in POSITIVE_MEASURES:
        typable = typable & (_positive(c, type_map) if c in numbers else F.coalesce(F.col(c) > 0, F.lit(False)))
    values = {"date": F.col("_parsed_date")} | {c: _value(c, type_map) for c in numbers}
    return parsed.filter(typable).select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SALES_SCHEMA.fields
          if f.name in SALES_COLUMNS])


def typed_with_rejects(raw: DataFrame, placeholders: Mapping[str, object] = PLACEHOLDERS,
                       type_map: Mapping[str, str] = NUMERIC_TYPES) -> DataFrame:
    """Typed sales columns plus ``positive_money`` (see ``money_positive``), ``reject_reason``
    and ``raw_record`` in one projection.

    ``reject_reason`` names the first problem of a record the cleaning cannot load (a
    missing key, a missing or unparseable date, a missing measure, a number that does not convert) and is
    null otherwise; ``raw_record`` keeps such a record's text as JSON (null for good rows,
    so it costs nothing there). Rows that merely fail the positive-measure filter are not
    rejects. Writing this once lets a load split rejects and clean rows without parsing
    the raw records twice. With a ``corrupt_record`` column (see ``sources.raw.read_landing``) a
    line that is no proper record is rejected as ``malformed record``, whatever fields could be read.
    Columns beyond the sales columns are carried through.
    """
    filled = parsed_once(fill_placeholders(raw, placeholders), type_map)
    more = [c for c in raw.columns if c not in SALES_COLUMNS and c != CORRUPT]
    typed = {f.name: F.col(f.name) for f in SALES_SCHEMA.fields}
    typed["date"] = F.col("_parsed_date")
    checks = [(F.col(CORRUPT).isNotNull(), "malformed record")] if CORRUPT in raw.columns else []
    checks += [(F.col(SALES_KEY).isNull(), f"missing {SALES_KEY}"),
               (F.col("date").isNull(), "missing date"), (typed["date"].isNull(), "unparseable date")]
    for c in type_map:
        if c not in raw.columns:
            continue
        text = F.col(c)
        typed[c] = _value(c, type_map)
        checks += [(text.isNull(), f"missing {c}"), (typed[c].isNull(), f"bad {c}")]
    reason = None
    for cond, label in checks:
        reason = F.when(cond, F.lit(label)) if reason is None else reason.when(cond, F.lit(label))
    record = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c in SALES_COLUMNS]))
    if CORRUPT in raw.columns:
        record = F.coalesce(F.col(CORRUPT), record)
    found = filled.select("*", reason.alias("_reason"))        # read twice, so the optimiser keeps it apart
    return found.select(*[typed[f.name].cast(f.dataType).alias(f.name) for f in SALES_SCHEMA.fields],
                        _money_parsed_positive(type_map).alias(POSITIVE),
                        F.col("_reason").alias("reject_reason"),
                        F.when(F.col("_reason").isNotNull(), record).alias("raw_record"), *more)


def loadable_rows(staged: DataFrame) -> DataFrame:
    """The sales rows of ``typed_with_rejects`` that a load takes: no rejects, positive measures."""
    return (staged.filter(F.col("reject_reason").isNull() & F.col(POSITIVE) & (F.col("sale_bottles") > 0))
            .select(*SALES_COLUMNS))


def rejected_rows(raw: DataFrame, **kw) -> DataFrame:
    """Records the cleaning cannot type: (invoice_line_no, reject_reason, raw_record)."""
    return (typed_with_rejects(raw, **kw).filter(F.col("reject_reason").isNotNull())
            .select("invoice_line_no", "reject_reason", "raw_record"))


__all__ = ["rejected_rows", "fill_placeholders", "normalize_date", "cast_by_map", "filter_positive",
           "filter_non_negative", "conform", "clean_sales", "MEASURE_COLUMNS"]
