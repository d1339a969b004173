"""Row selection of the extract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.period import Period, ntz
from tidemark.spec import resolve_name


def window_filter(df: DataFrame, column: str | None, start: dt.datetime | None,
                  end: dt.datetime | None) -> DataFrame:
    """``column BETWEEN start AND end`` (both ends inclusive).

    B7: with no search column the whole table is the extract.  The bounds are
    literals, so parquet receives them as ``PushedFilters`` (>= and <=).
    """
    if column is None:
        return df
    if start is None or end is None:
        raise ValueError("window_filter needs both bounds; resolve the period first")
    c = F.col(resolve_name(df.schema, column))
    return df.where(c.between(ntz(start), ntz(end)))


def period_filter(df: DataFrame, column: str | None, period: Period) -> DataFrame:
    return window_filter(df, column, period.eff_start, period.eff_end) if column else df


def residual_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """A free-text extra predicate, written as ``and <expr>``."""
    cond = (condition or "").strip()
    if not cond:
        return df
    if cond[:4].lower() == "and ":
        cond = cond[4:]
    return df.where(F.expr(cond))
