"""Dimension features: store format, liquor type, cleaned address and full address.

All are projections on the dimension frames (native expressions, no write-back join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.classify import classify_ordered, prefix_lookup
from salesmart.functions.text import clean_address, normalize_store_name, py_title
from salesmart.schema import (DIRECTIONS, LIQUOR_TYPE_DEFAULT, LIQUOR_TYPES, STATE_SUFFIX,
                              STORE_FORMAT_DEFAULT, STORE_FORMAT_EXACT, STORE_FORMATS,
                              STORE_NAME_REWRITES)


def store_format(name: Column, mapping: Sequence[tuple[str, str]] = STORE_FORMATS,
                 exact: tuple[str, str] = STORE_FORMAT_EXACT,
                 default: str = STORE_FORMAT_DEFAULT,
                 rewrites: Sequence[tuple[str, str]] = STORE_NAME_REWRITES) -> Column:
    """Store format from the store name: normalise, then classify by ordered keywords."""
    return classify_ordered(normalize_store_name(name, rewrites), mapping, exact, default)


def add_store_format(stores: DataFrame, name_col: str = "store_name", **kw) -> DataFrame:
    return stores.withColumn("store_format", store_format(F.col(name_col), **kw))


def liquor_type(code: Column, mapping: Mapping[str, str] = LIQUOR_TYPES,
                default: str = LIQUOR_TYPE_DEFAULT, digits: int = 3) -> Column:
    """Liquor type from the first digits of the category code. A null code gets no type
    (a keyed update on a null code matches no row)."""
    return F.when(code.isNotNull(), prefix_lookup(code, digits, mapping, default))


def add_liquor_type(items: DataFrame, code_col: str = "category_code", **kw) -> DataFrame:
    return items.withColumn("liquor_type", liquor_type(F.col(code_col), **kw))


def add_full_address(stores: DataFrame, directions: Sequence[tuple[str, str]] = DIRECTIONS,
                     state_suffix: str = STATE_SUFFIX) -> DataFrame:
    """Title-case city and county, clean the address, and build
    ``address, city, <state> zipcode``; a null part gives a null full address."""
    cleaned = (stores.withColumn("city", py_title(F.col("city")))
                     .withColumn("county", py_title(F.col("county")))
                     .withColumn("address", clean_address(F.col("address"), directions)))
    full = F.concat(F.col("address"), F.lit(", "), F.col("city"), F.lit(state_suffix),
                    F.col("zipcode").cast("string"))
    return cleaned.withColumn("full_address", full)


def store_features(stores: DataFrame) -> DataFrame:
    """Stores with store_format and full_address (and cleaned address, city, county)."""
    return add_full_address(add_store_format(stores))


def item_features(items: DataFrame) -> DataFrame:
    return add_liquor_type(items)
