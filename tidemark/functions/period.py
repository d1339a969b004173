"""Load and check windows.

A window is two scalar bounds.  They are resolved once per run on the driver
(at most one ``min`` aggregate runs on Spark) and then enter the plan as
literals, so the window filter reaches the parquet scan as pushed filters and
prunes partitions and row groups.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import DEFAULT_PERIOD_START, NO_EARLIEST_OVERRIDE
from tidemark.spec import JobSpec, SpecError, resolve_name


@dataclass(frozen=True)
class Period:
    """``start``/``end`` as requested (after defaults), ``eff_*`` as filtered."""

    start: dt.datetime | None
    end: dt.datetime | None
    eff_start: dt.datetime | None
    eff_end: dt.datetime | None
    shift_hours: int = 0
    defaulted: bool = False


def ntz(value: dt.datetime) -> Column:
    """A zone-free timestamp literal (folded to a constant, pushable)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_start(value: dt.datetime) -> dt.datetime:
    return dt.datetime(value.year, value.month, value.day)


def utc_shift_hours(now: dt.datetime, zone: str) -> int:
    """Whole hours from local time in ``zone`` to UTC at ``now``."""
    off = now.replace(tzinfo=ZoneInfo(zone)).utcoffset() or dt.timedelta(0)
    return int(-off.total_seconds() // 3600)


def to_utc(value: dt.datetime, zone: str) -> dt.datetime:
    """Exact local -> UTC conversion of one bound (DST-correct)."""
    aware = value.replace(tzinfo=ZoneInfo(zone))
    return aware.astimezone(dt.timezone.utc).replace(tzinfo=None)


def source_min(source: DataFrame, column: str) -> dt.datetime | None:
    """``min(column)`` of the whole source: one scalar aggregate on Spark."""
    col = resolve_name(source.schema, column)
    return source.agg(F.min(F.col(col).cast("timestamp_ntz")).alias("m")).first()["m"]


def _default_bounds(spec: JobSpec, source: DataFrame | None, now: dt.datetime):
    """Either bound NULL -> start = day of min(search column) or 2000-01-01; end = now."""
    start = spec.default_start
    if start is None and spec.search_column is not None and source is not None:
        m = source_min(source, spec.search_column.name)
        start = day_start(m) if m is not None else None
    return (start or DEFAULT_PERIOD_START), now


def _shift(spec: JobSpec, start: dt.datetime, end: dt.datetime, now: dt.datetime, session_zone: str):
    """Move both bounds from local time to UTC."""
    if spec.utc_shift_hours is not None:
        h = spec.utc_shift_hours
        return start + dt.timedelta(hours=h), end + dt.timedelta(hours=h), h
    zone = spec.utc_zone or session_zone
    if spec.utc_zone:
        # A named zone converts each bound by its own offset (no DST error).
        return to_utc(start, zone), to_utc(end, zone), utc_shift_hours(now, zone)
    if zone.upper() in ("UTC", "ETC/UTC", "GMT", "Z"):
        raise SpecError(f"{spec.name}: the search column is in UTC, but neither utc_zone nor utc_shift_hours says "
                        "where the load's own clock stands")
    h = utc_shift_hours(now, zone)
    return start + dt.timedelta(hours=h), end + dt.timedelta(hours=h), h


def resolve_load_period(spec: JobSpec, start: dt.datetime | None, end: dt.datetime | None, *,
                        now: dt.datetime, source: DataFrame | None = None,
                        session_zone: str = "UTC") -> Period:
    """C1 -> C2 -> C3, in the order the load applies them."""
    if spec.search_column is None:
        return Period(start, end, None, None)
    if start is None or end is None:
        s, e = _default_bounds(spec, source, now)
        p = Period(s, e, s, e, 0, True)          # no UTC shift on this path
    elif spec.is_utc:
        es, ee, h = _shift(spec, start, end, now, session_zone)
        p = Period(start, end, es, ee, h)
    else:
        p = Period(start, end, start, end)
    if spec.set_day_start:
        p = Period(p.start, p.end, day_start(p.eff_start), p.eff_end, p.shift_hours, p.defaulted)
    return p


def resolve_check_period(spec: JobSpec, start: dt.datetime | None, end: dt.datetime | None, *,
                         now: dt.datetime, earliest: dt.datetime | None = NO_EARLIEST_OVERRIDE,
                         source: DataFrame | None = None, session_zone: str = "UTC") -> Period:
    """C5 -> C4 -> C1 -> C2, in the order the check applies them (no C3)."""
    if spec.search_column is None:
        return Period(start, end, None, None)
    # NULL compares unknown in the original check, so it does not override.
    if earliest is not None and earliest != NO_EARLIEST_OVERRIDE and source is not None:
        start = source_min(source, spec.search_column.name)
    if end is not None:
        end = end + dt.timedelta(hours=spec.check_grace_hours)
    if start is None or end is None:
        s, e = _default_bounds(spec, source, now)
        return Period(s, e, s, e, 0, True)
    if spec.is_utc:
        es, ee, h = _shift(spec, start, end, now, session_zone)
        return Period(start, end, es, ee, h)
    return Period(start, end, start, end)


def month_span(lo: Column, hi: Column) -> Column:
    """Calendar-month boundaries crossed between two timestamps."""
    return (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo)
