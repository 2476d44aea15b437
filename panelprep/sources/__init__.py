from panelprep.sources.scans import (
    Between, calendar_index, distinct_dates, head, interval_scan, merge_params, read_pages, scan, split_log,
    split_scan, split_summary, values_to_intervals,
)
from panelprep.sources.sinks import resolve_format, write
from panelprep.sources.values import parse_value_list, read_values, rows_per_file, split_read_paths, split_read_table, typed_values, with_inline

__all__ = [
    "Between", "calendar_index", "distinct_dates", "head", "interval_scan", "merge_params", "parse_value_list",
    "read_pages", "read_values", "resolve_format", "rows_per_file", "scan", "split_log", "split_read_paths",
    "split_read_table", "split_scan", "split_summary", "typed_values", "values_to_intervals", "with_inline", "write",
]
