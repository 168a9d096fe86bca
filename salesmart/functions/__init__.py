"""Column functions (native Spark expressions only)."""

from salesmart.functions.classify import classify_ordered, first_match, prefix_lookup
from salesmart.functions.dates import (fiscal_quarter, fiscal_year, month_bounds,
                                       parse_api_date, sunday_week)
from salesmart.functions.numeric import div_round, int_via_float, is_number_text, percent
from salesmart.functions.text import (clean_address, fix_directions, normalize_store_name,
                                      py_strip, py_title, strip_chars, title_except_numbers)

__all__ = [
    "classify_ordered", "first_match", "prefix_lookup", "fiscal_quarter", "fiscal_year", "month_bounds",
    "parse_api_date", "sunday_week", "div_round", "int_via_float", "is_number_text", "percent",
    "clean_address", "fix_directions", "normalize_store_name", "py_strip", "py_title",
    "strip_chars", "title_except_numbers",
]
