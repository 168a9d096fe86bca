"""Declared shapes, column lists and the fixed configuration values of the sales mart."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Column lists
# --------------------------------------------------------------------------------------

SALES_COLUMNS = [
    "invoice_line_no", "date", "store", "name", "address", "city", "zipcode", "county",
    "category", "category_name", "vendor_no", "vendor_name", "itemno", "im_desc",
    "bottle_volume_ml", "state_bottle_cost", "state_bottle_retail", "sale_bottles",
]

SALES_KEY = "invoice_line_no"

# Columns that get a placeholder instead of null: neither key, date nor measures.
DIMENSION_COLUMNS = [
    "store", "name", "address", "city", "zipcode", "county", "category", "category_name",
    "vendor_no", "vendor_name", "itemno", "im_desc",
]

MEASURE_COLUMNS = ["bottle_volume_ml", "state_bottle_cost", "state_bottle_retail", "sale_bottles"]

MONEY = T.DecimalType(10, 2)
RATIO = T.DecimalType(10, 4)

# Raw records arrive as text; an absent field reads as null under an explicit schema.
RAW_SALES_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SALES_COLUMNS])

# Typed staging / integration table.
SALES_SCHEMA = T.StructType([
    T.StructField("invoice_line_no", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("store", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("zipcode", T.IntegerType(), True),
    T.StructField("county", T.StringType(), True),
    T.StructField("category", T.IntegerType(), True),
    T.StructField("category_name", T.StringType(), True),
    T.StructField("vendor_no", T.IntegerType(), True),
    T.StructField("vendor_name", T.StringType(), True),
    T.StructField("itemno", T.IntegerType(), True),
    T.StructField("im_desc", T.StringType(), True),
    T.StructField("bottle_volume_ml", T.IntegerType(), True),
    T.StructField("state_bottle_cost", MONEY, True),
    T.StructField("state_bottle_retail", MONEY, True),
    T.StructField("sale_bottles", T.IntegerType(), True),
])

FACT_COLUMNS = [
    "invoice_line_id", "date", "store_id", "item_id", "bottle_volume_ml", "bottle_cost",
    "bottle_price", "sale_bottles",
]

# Metric columns in their declared order.
METRIC_COLUMNS = [
    "bottle_profit", "gallon_cost", "gallon_price", "sale_gallons", "gallon_profit",
    "liter_cost", "liter_price", "sale_liters", "liter_profit", "cost", "revenue", "profit",
    "margin",
]

CALENDAR_COLUMNS = [
    "date_id", "date", "year", "month", "month_of_year", "day_of_month", "day", "day_of_week",
    "weekend", "day_of_year", "week_of_year", "quarter", "previous_day", "next_day",
    "financial_year", "financial_quarter",
]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("execution_date", T.DateType(), True),
    T.StructField("process_start_time", T.TimestampNTZType(), True),
    T.StructField("process_end_time", T.TimestampNTZType(), True),
    T.StructField("total_duration", T.StringType(), True),
    T.StructField("data_start_date", T.DateType(), True),
    T.StructField("data_end_date", T.DateType(), True),
    T.StructField("record_count", T.LongType(), True),
    T.StructField("new_records_added", T.LongType(), True),
])

# --------------------------------------------------------------------------------------
# Fixed values. These must equal the reference's configuration for equal results; they
# are given here as plain data, in the reference's own order. Every operator takes them
# as parameters, so other retailers or maps can be passed in.
# --------------------------------------------------------------------------------------

# Null placeholders per dimension column.
PLACEHOLDERS = {
    "store": 9999,
    "name": "UNKNOWN",
    "address": "UNKNOWN",
    "city": "UNKNOWN",
    "zipcode": 99999,
    "county": "UNKNOWN",
    "category": 9999999,
    "category_name": "UNKNOWN",
    "vendor_no": 999,
    "vendor_name": "UNKNOWN",
    "itemno": 99999,
    "im_desc": "UNKNOWN",
}

# Numeric type per text column.
NUMERIC_TYPES = {
    "store": "int",
    "zipcode": "int",
    "category": "int",
    "vendor_no": "int",
    "itemno": "int",
    "bottle_volume_ml": "int",
    "state_bottle_cost": "float",
    "state_bottle_retail": "float",
    "sale_bottles": "int",
}

# Store-format keywords. Order matters: the first key found in the name wins.
STORE_FORMATS = [
    ("FOOD STORE", "Grocery Store"),
    ("FOOD AND DRUG", "Pharmacy"),
    ("DRUGSTORE", "Pharmacy"),
    ("FOOD & DRUGSTORE", "Pharmacy"),
    ("WINE AND SPIRITS", "Liquor Store"),
    ("WINE & SPIRITS", "Liquor Store"),
    ("FAST & FRESH EXPRESS", "Convenience Store"),
    ("FAST & FRESH", "Convenience Store"),
    ("FAST AND FRESH", "Convenience Store"),
    ("C STORE", "Convenience Store"),
]

# A cleaned name equal to this text (case-sensitive) is a grocery store.
STORE_FORMAT_EXACT = ("HY VEE", "Grocery Store")
STORE_FORMAT_DEFAULT = "Other"

# Brand rewrites before the store name is cut (case-insensitive, every occurrence).
STORE_NAME_REWRITES = [("HY-VEE", "HY VEE"), ("C-STORE", "C STORE")]

# Liquor type by the first three digits of the category code.
LIQUOR_TYPES = {
    "101": "Whiskey",
    "102": "Tequila",
    "103": "Vodka",
    "104": "Gin",
    "105": "Brandy",
    "106": "Rum",
    "107": "Cocktails",
    "108": "Liqueur",
    "109": "Neutral Grain/Distilled Spirits",
}
LIQUOR_TYPE_DEFAULT = "Other"

# Retailer predicate: the first list matches lower-cased names, the second is case-sensitive.
RETAILER_CI_PATTERNS = ["hy-vee"]
RETAILER_CS_PATTERNS = ["WALL TO WALL WINE AND SPIRITS"]

# Directional words upper-cased inside a cleaned address.
DIRECTIONS = [(" Sw ", " SW "), (" Se ", " SE "), (" Nw ", " NW "), (" Ne ", " NE ")]

# State text put between city and zip code in the full address.
STATE_SUFFIX = ", IA "

# The fiscal year starts in July; FY n runs from (n-1)-07-01 up to n-07-01.
FISCAL_START_MONTH = 7

# First load goes back this many fiscal years.
INITIAL_FISCAL_YEARS = 3

# Calendar range of the reference model.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2025-12-31"

# Gallon size in millilitres, and millilitres per litre.
ML_PER_GALLON = "3785.411784"
ML_PER_LITER = "1000"

# The reference's one recorded run: 2,762,958 rows in 2,626.088 s.
REFERENCE_RUN_ROWS = 2762958
REFERENCE_RUN_SECONDS = "2626.088"
