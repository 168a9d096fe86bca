"""Dictionary-driven classification as native expressions (no joins, no UDFs).

Dictionaries are configuration of a small size. Fixed ones compile into the expression itself: an
ordered CASE for keyword search and a literal map for exact lookup. One that is read at run time
is a single array constant (``first_match``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_ordered(c: Column, mapping: Sequence[tuple[str, str]],
                     exact: tuple[str, str] | None = None, default: str = "Other") -> Column:
    """First key contained in the text (case-insensitive, in the given order) gives its value.

    Otherwise the text equal to ``exact[0]`` (case-sensitive) gives ``exact[1]``; otherwise
    the text is kept when it already equals one of the values ignoring case, else
    ``default``.
    """
    low = F.lower(c)
    expr = None
    for key, value in mapping:
        cond = low.contains(key.lower())
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if exact is not None:
        cond = c == F.lit(exact[0])
        expr = F.when(cond, F.lit(exact[1])) if expr is None else expr.when(cond, F.lit(exact[1]))
    values = sorted({v.lower() for _, v in mapping} | ({exact[1].lower()} if exact else set()))
    keep = low.isin(values)
    expr = F.when(keep, c) if expr is None else expr.when(keep, c)
    return expr.otherwise(F.lit(default))


def first_match(c: Column, mapping: Mapping[str, str] | Sequence[tuple[str, str]], default: str = "Other",
                keep_values: bool = True) -> Column:
    """``classify_ordered`` for a dictionary read at run time: its entries are one array constant that
    is searched in order, so the expression stays of one size whatever the dictionary's length
    (``sources.raw.as_mapping`` bounds it). Without a match a text that equals a value, ignoring
    case, is kept (``keep_values``), else it is ``default``; a null text is ``default``."""
    items = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    if not items:
        return F.lit(default)
    rules = F.array(*(F.struct(F.lit(k.lower()).alias("key"), F.lit(v).alias("value")) for k, v in items))
    low = F.lower(c)
    found = F.get(F.filter(rules, lambda r: F.contains(low, r["key"])), F.lit(0))["value"]
    values = F.array(*(F.lit(v) for v in sorted({v.lower() for _, v in items})))
    kept = F.when(F.array_contains(values, low), c) if keep_values else F.lit(None)
    return F.coalesce(found, kept, F.lit(default))


def prefix_lookup(c: Column, n: int, mapping: Mapping[str, str], default: str = "Other") -> Column:
    """Look up the first ``n`` characters of the value's text in ``mapping``; else ``default``."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = F.substring(c.cast("string"), 1, n)
    return F.coalesce(F.try_element_at(lookup, key), F.lit(default))
