"""DataFrame operators of the sales mart."""

# ``calendar`` (the function) stays in salesmart.operators.calendar so the module name is
# not shadowed.
from salesmart.operators.calendar import (calendar_attributes, calendar_for,
                                          covering_date_series, date_series, day_offsets,
                                          fiscal_columns, number_series)
from salesmart.operators.clean import (cast_by_map, clean_sales, conform, fill_placeholders,
                                       filter_non_negative, filter_positive, normalize_date)
from salesmart.operators.features import (add_full_address, add_liquor_type, add_store_format,
                                          item_features, liquor_type, store_features,
                                          store_format)
from salesmart.operators.load import (append_new, first_per_key, insert_marked, load_layers,
                                      skipped_rows)
from salesmart.operators.metrics import add_metrics
from salesmart.operators.model import (build_model, dim_items, dim_stores, distinct_items,
                                       fact_transactions, latest_per_key, model_counts,
                                       write_fact)
from salesmart.operators.profile import (derive_placeholders, describe, distinct_sorted,
                                         distinct_values, drop_full_duplicates, duplicate_stats,
                                         filter_contains, infer_numeric_types, is_date_castable,
                                         key_collision_count, missing_values, pct_where, preview,
                                         profile_raw, sample_n, shape, to_numeric)
from salesmart.operators.quality import (apply_defaults, check_fk, check_not_null, check_unique,
                                         create_layers, create_like, reset_model, replace_column,
                                         schema_report, update_from)
from salesmart.operators.runlog import (append_run_log, format_duration, new_records,
                                        read_run_log, run_log_row, table_stats)
from salesmart.operators.windows import high_water_mark, month_list, month_windows
