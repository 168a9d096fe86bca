"""Skew-safe left join of a large frame to a lookup with one row per key.

The heaviest keys of the large side are found with a partial aggregate and a top-k (a list
bounded by construction). Their lookup rows, at most that many, are broadcast, so rows of a
hot key are joined where they are and never meet in one task, identical copies included. The
k-th heaviest key holds at most 1/k of all rows, so every key left to the shuffle join of the
other rows is below 1/``hot_keys`` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def heavy_keys(df: DataFrame, key: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """The ``hot_keys`` most frequent non-null keys (at most that many rows)."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(key)).limit(hot_keys) \
                 .select(key, F.lit(True).alias("_hot"))


def skew_safe_left_join(left: DataFrame, lookup: DataFrame, key: str,
                        hot_keys: int = HOT_KEYS) -> DataFrame:
    """``left`` LEFT JOIN ``lookup`` USING (key), with ``lookup`` unique per key."""
    hot = F.broadcast(heavy_keys(left, key, hot_keys))   # bounded: hot_keys rows
    marked = left.join(hot, key, "left")
    hot_lookup = lookup.join(hot, key, "left_semi")
    hot_rows = marked.filter("_hot").drop("_hot").join(F.broadcast(hot_lookup), key, "left")
    rest = marked.filter("_hot is null").drop("_hot").join(lookup, key, "left")
    return hot_rows.unionByName(rest)
