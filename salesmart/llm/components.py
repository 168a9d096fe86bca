"""Connected components of a link table, by alternating star contractions.

Every round points each node's larger neighbours, then the node with its smaller neighbours, at
the least node in sight. The link table never grows, the number of rounds is logarithmic, and
each round is written to the shared folder, so that a lost executor costs a task and not the
iteration. The neighbours of a hub are joined, not gathered: its minimum is pre-aggregated per
task and the join's hot side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that occurs in a link; root is the least node reachable.
    Links to oneself and null ends are ignored."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u > v").distinct(), "links")
    before = None
    while (seen := _digest(edges)) != before:
        before = seen
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    return (both.join(least, F.col("u") == F.col("x")).where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    return (edges.join(least, F.col("u") == F.col("x")).where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("x", "m")).distinct())
