"""Scalar functions: windows (C1-C6), predicates (B9), user functions."""

from tidemark.functions.period import (Period, day_start, month_span, ntz, resolve_check_period,
                                       resolve_load_period, source_min, to_utc, utc_shift_hours)
from tidemark.functions.predicates import changed, keys_equal
from tidemark.functions.udf import register_pandas_function, register_sql_function

__all__ = [
    "Period", "day_start", "month_span", "ntz", "resolve_check_period", "resolve_load_period",
    "source_min", "to_utc", "utc_shift_hours", "changed", "keys_equal",
    "register_pandas_function", "register_sql_function",
]
