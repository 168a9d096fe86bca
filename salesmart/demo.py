"""Adapter views over the driver's test tables (test data only).

The driver ships TPC-H-like tables, not retail sales records. ``sales_view`` maps
``lineitem`` joined with ``part``, ``supplier``, ``nation`` and ``region`` onto the
18-column sales shape; ``raw_sales_view`` renders the same rows as the text records an
API would send. Both scale with ``lineitem``.

Join strategy: ``lineitem`` is the only large side. ``part`` and ``supplier`` grow with
the data too, so no hint is given: the planner broadcasts a side only when its size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a sort-merge join.
Every dimension is joined straight onto lineitem so each build side is a base table with
a known size (a pre-joined supplier-nation-region frame gets a product-of-sizes estimate
and would force a shuffle of lineitem).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import SALES_COLUMNS

# Fixed test-data values: brand texts picked by (l_suppkey + l_linenumber) % 9.
BRANDS = [
    "HY-VEE FOOD STORE #",
    "Hy-Vee Wine & Spirits #",
    "HY-VEE FAST & FRESH #",
    "HY-VEE C-STORE #",
    "HY-VEE DRUGSTORE #",
    "HY-VEE #",
    "HY-VEE GAS #",
    "HY-VEE FOOD AND DRUG #",
    "WALL TO WALL WINE AND SPIRITS #",
]

# Non-retailer name used by the retailer-filter fixture.
OTHER_RETAILER = "FAREWAY STORES #"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                                "p_size")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Each dimension joins the growing lineitem side directly, so every join's build side is
    # a base table whose size the planner knows: small ones are broadcast without shuffling
    # lineitem, large ones (part and supplier at scale) stay sort-merge joins. Those come first,
    # while the rows are numbers; the names of the small tables are never shuffled.
    return (li.join(supplier, li.l_suppkey == supplier.s_suppkey)
              .join(part, li.l_partkey == part.p_partkey)
              .join(nation, F.col("s_nationkey") == nation.n_nationkey)
              .join(region, F.col("n_regionkey") == region.r_regionkey))


def _money(base: int) -> F.Column:
    cents = F.lit(base) + F.col("l_partkey") % 1700
    return (cents.cast(T.DecimalType(12, 0)) / F.lit(100)).cast(T.DecimalType(10, 2))


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed 18-column sales rows over the driver tables."""
    brand = F.element_at(F.array(*[F.lit(b) for b in BRANDS]),
                         ((F.col("l_suppkey") + F.col("l_linenumber")) % 9 + 1).cast("int"))
    supp = F.col("l_suppkey").cast("string")
    cols = {
        "invoice_line_no": F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                    F.col("l_linenumber").cast("string")),
        "date": F.col("l_shipdate").cast("date"),
        "store": F.col("l_suppkey").cast("int"),
        "name": F.concat(brand, supp, F.lit(" / "), F.col("n_name")),
        "address": F.concat(supp, F.lit("TH  sw "), F.col("p_name"), F.lit(" o'brien st.")),
        "city": F.col("n_name"),
        "zipcode": (F.lit(50000) + F.col("n_nationkey")).cast("int"),
        "county": F.col("r_name"),
        "category": (F.lit(1000000) + (F.col("l_partkey") % 11) * 10000).cast("int"),
        "category_name": F.when(F.col("l_partkey") % 37 == 0, F.lit(None).cast("string"))
                          .otherwise(F.col("p_type")),
        "vendor_no": (F.col("l_suppkey") % 50).cast("int"),
        "vendor_name": F.col("p_brand"),
        "itemno": F.col("l_partkey").cast("int"),
        "im_desc": F.col("p_name"),
        "bottle_volume_ml": (F.col("p_size") * 25).cast("int"),
        "state_bottle_cost": _money(300),
        "state_bottle_retail": _money(450),
        "sale_bottles": F.col("l_quantity").cast("int") - 5,
    }
    return _joined(spark, sf_dir).select(*[cols[c].alias(c) for c in SALES_COLUMNS])


def raw_sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rows as API text records: every field a string, dates as timestamps."""
    return to_raw_text(sales_view(spark, sf_dir))


def to_raw_text(sales: DataFrame) -> DataFrame:
    out = []
    for c in SALES_COLUMNS:
        if c == "date":
            # a date's text plus a midnight time: 1998-12-01T00:00:00.000
            out.append(F.concat(F.col(c).cast("string"), F.lit("T00:00:00.000")).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return sales.select(*out)


def retailer_mix(sales: DataFrame) -> DataFrame:
    """Sales with other retailers mixed in: stores ending in 0 get a non-retailer name and
    stores ending in 5 a lower-cased name (the case-sensitive arm then no longer matches)."""
    other = F.concat(F.lit(OTHER_RETAILER), F.col("store").cast("string"), F.lit(" / "),
                     F.col("city"))
    name = (F.when(F.col("store") % 10 == 0, other)
             .when(F.col("store") % 10 == 5, F.lower(F.col("name")))
             .otherwise(F.col("name")))
    return sales.withColumn("name", name)
