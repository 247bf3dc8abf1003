"""Sources: Parquet and CSV files, landed vendor JSON pages, seed rows."""

from barwise.sources.files import (input_schema, profile_input, read_bars, read_constituents, read_daily,
                                   read_table, require_columns, table_path)
from barwise.sources.seed import EXCHANGES, exchanges
from barwise.sources.vendor import normalise_pages, pack_pages

__all__ = ["input_schema", "profile_input", "read_bars", "read_constituents", "read_daily", "read_table",
           "require_columns", "table_path", "EXCHANGES", "exchanges", "normalise_pages",
           "pack_pages"]
