"""Sinks: partitioned Parquet layout and key-aware merges."""

from barwise.sinks.layout import (DEFAULT_PARTITION, assign_month, cluster, load_bars,
                                  month_bounds, month_table, write_partitioned, write_yearly,
                                  year_windows)
from barwise.sinks.merge import (append_new, first_per_key, insert_ignore, load_report, new_rows,
                                 sort_for_insert, upsert)

__all__ = ["DEFAULT_PARTITION", "assign_month", "cluster", "load_bars", "month_bounds",
           "month_table", "write_partitioned", "write_yearly", "year_windows", "append_new",
           "first_per_key", "insert_ignore", "load_report", "new_rows", "sort_for_insert",
           "upsert"]
