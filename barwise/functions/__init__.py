"""Column functions: time zones, returns, rounding, symbols."""

from barwise.functions.numeric import (int_or_null, log_return, num_or, round6, round_dec,
                                       safe_div, simple_return)
from barwise.functions.text import (clean_symbol, dash_to_dot, dot_to_dash, empty_to_null,
                                    not_blank, symbol_forms)
from barwise.functions.timefn import (NEW_YORK, date_lit, from_epoch_micros, is_early_close,
                                      local_date, local_instant, local_label, local_minute, local_time,
                                      local_window, month_key, month_start, next_month,
                                      prior_day, to_local, to_utc, ts_lit, vendor_ts, weekday)

__all__ = [
    "int_or_null", "log_return", "num_or", "round6", "round_dec", "safe_div", "simple_return",
    "clean_symbol", "dash_to_dot", "dot_to_dash", "empty_to_null", "not_blank", "symbol_forms",
    "NEW_YORK", "date_lit", "from_epoch_micros", "is_early_close", "local_date", "local_instant",
    "local_label",
    "local_minute", "local_time", "local_window", "month_key", "month_start", "next_month",
    "prior_day", "to_local", "to_utc", "ts_lit", "vendor_ts", "weekday",
]
