"""Exact numeric helpers: half-up division on decimals, loose number parsing, percents.

Spark's decimal division rounds to its own result scale before a later ``round`` sees the
value, so a plain ``round(a / b, 2)`` can round twice. Two exact forms:

* ``round_div`` widens the numerator so that Spark's own rounding step is too fine to
  matter, then rounds once (one native decimal division; used per row);
* ``div_round`` divides scaled wide integers and rounds half away from zero (any widths;
  used on aggregates and as the fallback for very wide types).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDE = T.DecimalType(38, 0)

# Text that Python's float() reads as a finite number: optional sign, digits with an
# optional fraction, optional exponent, surrounding blanks allowed.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def unscaled(c: Column, scale: int) -> Column:
    """Decimal value times 10^scale as an exact wide integer decimal."""
    return (c.cast(T.DecimalType(38, scale)) * F.lit(10 ** scale)).cast(_WIDE)


def _floor_div(n: Column, d: Column) -> Column:
    """Exact floor(n / d) for non-negative integer decimals (d > 0)."""
    return ((n - F.pmod(n, d)) / d).cast(_WIDE)


def div_round(num: Column, num_scale: int, den: Column, den_scale: int, out_scale: int,
              out_type: T.DecimalType | None = None) -> Column:
    """Exact ``round(num / den, out_scale)`` (half away from zero) for decimal inputs.

    ``num`` and ``den`` are decimals (or integers) with the given scales. The quotient is
    formed from scaled integers so nothing is rounded before the final step. A zero or null
    divisor yields null.
    """
    n = unscaled(num, num_scale)
    d = unscaled(den, den_scale)
    # value = (n / 10^ns) / (d / 10^ds);  result * 10^os = n * 10^(ds + os - ns) / d
    shift = den_scale + out_scale - num_scale
    if shift >= 0:
        n = (n * F.lit(10 ** shift)).cast(_WIDE)
    else:
        d = (d * F.lit(10 ** (-shift))).cast(_WIDE)
    an, ad = F.abs(n), F.abs(d)
    q = _floor_div((F.lit(2) * an + ad).cast(_WIDE), (F.lit(2) * ad).cast(_WIDE))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    result_type = out_type or T.DecimalType(38, out_scale)
    scaled = (signed / F.lit(10 ** out_scale)).cast(result_type)
    return F.when(d.isNull() | (d == 0) | n.isNull(), F.lit(None).cast(result_type)) \
            .otherwise(scaled)


def percent(part: Column, whole: Column, scale: int = 4) -> Column:
    """Exact ``round(100 * part / whole, scale)`` as decimal(20, scale); null when whole is 0."""
    return div_round(part.cast("long") * F.lit(100), 0, whole.cast("long"), 0, scale,
                     T.DecimalType(20, scale))


INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def text_to_long(c: Column) -> Column:
    """Integer text to long; anything else (or out of range) is null. The regex test runs
    first so failing text never reaches the cast's slow error path."""
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("long"))


def is_number_text(c: Column) -> Column:
    """True when the text is a finite decimal number (no 'NaN', 'inf' or suffixes)."""
    return c.rlike(NUMBER_PATTERN)


def to_double(c: Column) -> Column:
    """Loose text to double: null unless the text is a finite number. (The string cast trims
    surrounding blanks itself.)"""
    return F.when(is_number_text(c), c.try_cast("double"))


def int_via_float(c: Column, to: str = "int") -> Column:
    """Text to int through a float: '12.0' -> 12, '12.7' -> 12, '-12.7' -> -12, junk -> null.
    A double-to-int cast truncates toward zero, as Python's int(float(x)) does."""
    return F.when(is_number_text(c), c.try_cast("double").try_cast(to))


def round_div(num: Column, num_type: T.DecimalType, den: Column, den_type: T.DecimalType,
              scale: int) -> Column | None:
    """Exact ``round(num / den, scale)`` (half up) as one native decimal division, or None
    when the types are too wide for it (use ``div_round`` then).

    Spark rounds a decimal quotient to scale ``S = s1 + p2 + 1``. An exact quotient that is
    not on a rounding boundary of ``scale`` lies at least 1/(2|d|) units away from it, where
    |d| < 10^p2 is the divisor's unscaled value, and ``S >= scale + p2 + 1`` keeps Spark's
    own rounding error (half a unit at S) below that gap. So the numerator is widened to
    scale ``s1' >= scale`` (exact, it only pads zeros), and the single ``round`` then gives
    the correctly rounded result. A zero divisor gives null.
    """
    p1, s1 = num_type.precision, num_type.scale
    p2, s2 = den_type.precision, den_type.scale
    s1w = max(s1, scale + max(0, s1 - s2 - scale))
    int_digits = p1 - s1
    result_scale = s1w + p2 + 1
    if int_digits + s1w > 38 or int_digits + s2 + result_scale > 38:
        return None
    wide = num.cast(T.DecimalType(int_digits + s1w, s1w))
    q = F.try_divide(wide, den.cast(den_type))
    return F.round(q, scale)
