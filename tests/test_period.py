import datetime as dt

from pyspark.sql import functions as F

from tidemark.constants import DEFAULT_PERIOD_START
from tidemark.functions.period import month_span, resolve_check_period, resolve_load_period, utc_shift_hours
from tidemark.operators.filters import residual_filter, window_filter
from tidemark.spec import JobSpec, SearchColumn, TableRef
from conftest import explain_text

D = dt.datetime
SPEC = JobSpec("J", TableRef(name="s"), TableRef(name="t"), ("k",), SearchColumn("ts"))
NOW = D(2030, 1, 1, 12, 0)


def test_window_edges_inclusive(spark):
    lo, hi = D(2024, 1, 1), D(2024, 1, 2)
    us = dt.timedelta(microseconds=1)
    df = spark.createDataFrame([(1, lo), (2, hi), (3, lo - us), (4, hi + us)], "k int, ts timestamp_ntz")
    assert sorted(r.k for r in window_filter(df, "TS", lo, hi).collect()) == [1, 2]


def test_window_pushed_to_parquet(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = explain_text(window_filter(df, "o_orderdate", D(1996, 1, 1), D(1996, 12, 31)))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThanOrEqual(o_orderdate" in pushed


def test_one_bound_null_defaults_both(spark):
    df = spark.createDataFrame([(1, D(2024, 3, 5, 13, 0))], "k int, ts timestamp_ntz")
    p = resolve_load_period(SPEC, D(2024, 3, 6), None, now=NOW, source=df)
    assert (p.eff_start, p.eff_end, p.defaulted) == (D(2024, 3, 5), NOW, True)
    empty = df.where("false")
    p = resolve_load_period(SPEC, None, D(2024, 3, 6), now=NOW, source=empty)
    assert p.eff_start == DEFAULT_PERIOD_START


def test_utc_shift_and_day_start():
    spec = SPEC.with_(search_column=SearchColumn("ts", True), utc_shift_hours=5, set_day_start=True)
    p = resolve_load_period(spec, D(2024, 1, 10, 17, 30), D(2024, 1, 11), now=NOW)
    assert (p.eff_start, p.eff_end, p.start) == (D(2024, 1, 10), D(2024, 1, 11, 5), D(2024, 1, 10, 17, 30))
    assert utc_shift_hours(D(2024, 1, 15), "America/New_York") == 5
    assert utc_shift_hours(D(2024, 7, 15), "America/New_York") == 4
    zoned = SPEC.with_(search_column=SearchColumn("ts_utc"), utc_zone="America/New_York")
    assert zoned.is_utc
    p = resolve_load_period(zoned, D(2024, 3, 9), D(2024, 3, 11), now=NOW)
    assert (p.eff_start, p.eff_end) == (D(2024, 3, 9, 5), D(2024, 3, 11, 4))  # DST-correct per bound


def test_check_grace_and_earliest(spark):
    df = spark.createDataFrame([(1, D(2020, 5, 5, 7, 0))], "k int, ts timestamp_ntz")
    p = resolve_check_period(SPEC, D(2024, 1, 10), D(2024, 1, 11), now=NOW)
    assert (p.eff_start, p.eff_end) == (D(2024, 1, 10), D(2024, 1, 11, 5))
    p = resolve_check_period(SPEC, D(2024, 1, 10), D(2024, 1, 11), earliest=D(2001, 1, 1), now=NOW, source=df)
    assert p.eff_start == D(2020, 5, 5, 7, 0)


def test_month_span_counts_boundaries(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 2, 1)), (D(2024, 1, 1), D(2024, 1, 31)),
                                (D(1995, 1, 1), D(2001, 8, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert [r.m for r in df.select(month_span(F.col("a"), F.col("b")).alias("m")).collect()] == [1, 0, 79]


def test_residual_filter_accepts_leading_and(spark):
    df = spark.range(10)
    assert residual_filter(df, "and id > 6").count() == 3
    assert residual_filter(df, "id > 6").count() == 3
    assert residual_filter(df, "").count() == 10
