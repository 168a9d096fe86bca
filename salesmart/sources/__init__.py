"""Scans, slices and sinks."""

from salesmart.sources.raw import (as_mapping, lookup_df, read_csv, read_dictionary, read_landing, read_lookup, read_raw_sales, read_table,
                                   select_sales)
from salesmart.sources.sinks import (append_table, refresh_table, write_csv, write_dictionary,
                                     write_lookup, write_raw_json)
from salesmart.sources.slices import (extract_windows, filter_retailer, merge_windows,
                                      slice_fiscal_year, slice_month)

__all__ = [
    "as_mapping", "read_dictionary", "read_landing", "write_dictionary", "lookup_df", "read_csv", "read_lookup", "read_raw_sales", "read_table", "select_sales",
    "append_table", "refresh_table", "write_csv", "write_lookup", "write_raw_json",
    "extract_windows", "filter_retailer", "merge_windows", "slice_fiscal_year", "slice_month",
]
