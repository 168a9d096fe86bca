"""Transaction metrics in exact decimals.

Evaluated in order; each result is rounded (half away from zero) to its declared scale
before a later formula reads it:

1. bottle_profit = round(bottle_price - bottle_cost, 2)
2. revenue       = round(bottle_price * sale_bottles, 2)
3. profit        = round((bottle_price - bottle_cost) * sale_bottles, 2)
4. margin        = round(profit / revenue, 4)
5. cost          = round(bottle_cost * sale_bottles, 2)
6. sale_gallons  = round(bottle_volume_ml * sale_bottles / ml_per_gallon, 2)
7. gallon_cost | gallon_price | gallon_profit = round(cost | revenue | profit / sale_gallons, 2)
8. sale_liters   = round(bottle_volume_ml * sale_bottles / 1000, 2)
9. liter_cost | liter_price | liter_profit = round(cost | revenue | profit / sale_liters, 2)

Sums and products of decimals are exact. Each quotient is one native decimal division
whose numerator is first widened so that Spark's intermediate rounding is finer than the
smallest gap between an exact quotient and a rounding boundary (``round_div``); the final
``round`` is then the exact half-up result, never a double rounding. A zero divisor, or a
value beyond the declared precision, gives null. Each step is a plain projection of
compact expressions, so it stays in whole-stage codegen with JIT-sized methods.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numeric import div_round, round_div
from salesmart.schema import METRIC_COLUMNS, ML_PER_GALLON, ML_PER_LITER, MONEY, RATIO

VOLUME = T.DecimalType(19, 0)       # bottle_volume_ml * sale_bottles: int * int fits 19 digits


def _lit_type(text: str) -> T.DecimalType:
    d = Decimal(text)
    scale = max(0, -d.as_tuple().exponent)
    digits = len(d.as_tuple().digits)
    return T.DecimalType(max(digits, scale + 1), scale)


def _ratio(num: Column, num_type: T.DecimalType, den: Column, den_type: T.DecimalType,
           scale: int, out: T.DecimalType) -> Column:
    exact = round_div(num, num_type, den, den_type, scale)
    if exact is None:       # wider than one decimal division can hold: scaled integers
        exact = div_round(num, num_type.scale, den, den_type.scale, scale)
    return exact.try_cast(out)


def add_metrics(fact: DataFrame, ml_per_gallon: str = ML_PER_GALLON,
                ml_per_liter: str = ML_PER_LITER) -> DataFrame:
    """Add the 13 metric columns (bottle_cost/bottle_price decimal(10,2), counts int)."""
    price, cost = F.col("bottle_price").cast(MONEY), F.col("bottle_cost").cast(MONEY)
    bottles = F.col("sale_bottles")
    volume = (F.col("bottle_volume_ml").cast("long") * bottles.cast("long")).cast(VOLUME)
    gal_t, ltr_t = _lit_type(ml_per_gallon), _lit_type(ml_per_liter)
    gal = F.lit(Decimal(ml_per_gallon)).cast(gal_t)
    ltr = F.lit(Decimal(ml_per_liter)).cast(ltr_t)

    step1 = fact.select(
        "*",
        (price - cost).try_cast(MONEY).alias("bottle_profit"),
        (price * bottles).try_cast(MONEY).alias("revenue"),
        ((price - cost) * bottles).try_cast(MONEY).alias("profit"),
        (cost * bottles).try_cast(MONEY).alias("cost"),
        _ratio(volume, VOLUME, gal, gal_t, 2, MONEY).alias("sale_gallons"),
        _ratio(volume, VOLUME, ltr, ltr_t, 2, MONEY).alias("sale_liters"))
    rev, prof, tot = F.col("revenue"), F.col("profit"), F.col("cost")
    gallons, liters = F.col("sale_gallons"), F.col("sale_liters")
    step2 = step1.select(
        "*",
        _ratio(prof, MONEY, rev, MONEY, 4, RATIO).alias("margin"),
        _ratio(tot, MONEY, gallons, MONEY, 2, MONEY).alias("gallon_cost"),
        _ratio(rev, MONEY, gallons, MONEY, 2, MONEY).alias("gallon_price"),
        _ratio(prof, MONEY, gallons, MONEY, 2, MONEY).alias("gallon_profit"),
        _ratio(tot, MONEY, liters, MONEY, 2, MONEY).alias("liter_cost"),
        _ratio(rev, MONEY, liters, MONEY, 2, MONEY).alias("liter_price"),
        _ratio(prof, MONEY, liters, MONEY, 2, MONEY).alias("liter_profit"))
    base = [c for c in fact.columns if c not in METRIC_COLUMNS]
    return step2.select(*base, *METRIC_COLUMNS)
