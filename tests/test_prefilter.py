"""The Bloom filter before the shuffled merge, and targets clustered by key."""

import datetime as dt
import decimal
import glob
import random
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, explain_text
from tidemark import fixtures as fx
from tidemark.operators.bloom import BITS_PER_KEY, bloom_bytes, bloom_filter, hashable, n_words, split_by_bloom
from tidemark.operators.merge import Stamp, merge_upsert, possible_matches
from tidemark.plans.strategy import prefilter_pays
from tidemark.sources.target import publish_snapshot, write_snapshot

STAMP = Stamp(7, dt.datetime(2030, 1, 1), "loader")


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_no_key_of_the_filter_is_turned_down_and_few_others_pass(spark):
    keys = spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("s"))
    words = n_words(keys.count())
    bloom = bloom_filter(keys, ["k", "s"], words)
    assert bloom.count() <= words
    probe = spark.range(60_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("s"))
    maybe, never = split_by_bloom(probe, ["k", "s"], bloom, words)
    got = {r["k"] for r in maybe.select("k").collect()}
    assert got >= set(range(0, 60_000, 3))
    assert len(got - set(range(0, 60_000, 3))) < 0.03 * 40_000
    assert never.count() == 60_000 - len(got)


@pytest.mark.parametrize("values, kind", [
    ([1, 2, None, 2**62, -5], "long"), (["a", "", None, "é", "b" * 5000], "string"),
    ([decimal.Decimal("1.50"), None, decimal.Decimal("-3.25")], "decimal(12,2)"),
    ([dt.date(1900, 1, 1), None, dt.date(2999, 12, 31)], "date"),
    ([dt.datetime(1900, 1, 1), None, dt.datetime(2999, 12, 31)], "timestamp_ntz"),
])
def test_both_parts_hold_every_row_once(spark, values, kind):
    target = spark.createDataFrame([(v, i) for i, v in enumerate(values * 3)], f"k {kind}, n int")
    staged = spark.createDataFrame([(values[0],), (None,)], f"k {kind}")
    maybe, never = possible_matches(target, staged, ["k"], 2)
    assert rows_of(maybe.unionByName(never)) == rows_of(target)
    assert {r["n"] for r in maybe.collect()} >= {i for i, v in enumerate(values * 3) if v == values[0]}
    assert {r["n"] for r in never.collect()} >= {i for i, v in enumerate(values * 3) if v is None}


def test_empty_sides(spark):
    target = spark.createDataFrame([(1, 1), (None, 2)], "k long, n int")
    none = target.where("false")
    maybe, never = possible_matches(target, none.select("k"), ["k"], 0)
    assert (maybe.count(), never.count()) == (0, 2)
    maybe, never = possible_matches(none, target.select("k"), ["k"], 2)
    assert (maybe.count(), never.count()) == (0, 0)


@pytest.mark.parametrize("seed", range(3))
def test_plans_agree_with_and_without_the_filter(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice([None] + list(range(40)))
    source = {k: (k, rng.choice([None, 1, 2]), "s") for k in (rng.randrange(60) for _ in range(25))}
    s = spark.createDataFrame(list(source.values()) + [(None, 1, "n"), (None, 1, "n")], "k long, c long, v string")
    seen = {k: (k, rng.choice([None, 1, 2]), "t", -1) for k in (key() for _ in range(60))}
    t = spark.createDataFrame(list(seen.values()) + [(None, 1, "t", -1)], "k long, c long, v string, mstr_load_id int")
    want = rows_of(merge_upsert(t, s, ["k"], ["c"], stamp=STAMP, plan="broadcast"))
    for plan in ("full_outer", "split"):
        for prefilter in (True, False):
            assert rows_of(merge_upsert(t, s, ["k"], ["c"], stamp=STAMP, plan=plan, prefilter=prefilter)) == want


def test_keys_that_do_not_compare_by_bytes_are_not_filtered(spark):
    a = spark.createDataFrame([], "k string, f double, n long").schema
    b = spark.createDataFrame([], "k string, f double, n int").schema
    assert hashable(a, a, ["k", "n"])
    assert not hashable(a, a, ["k"], "UNICODE_CI")
    assert not hashable(a, a, ["f"]) and not hashable(a, b, ["n"])
    t = spark.createDataFrame([("A", 1, -1)], "k string, c long, mstr_load_id int")
    s = spark.createDataFrame([("a", 2)], "k string, c long")
    got = merge_upsert(t, s, ["k"], ["c"], stamp=STAMP, plan="full_outer", collation="UNICODE_CI", prefilter=True).collect()
    assert [r["_action"] for r in got] == ["UPDATE"]


def test_only_possible_matches_are_exchanged(spark):
    t = fx.target_t(spark, SF_SMALL)
    s = fx.source_s(spark, SF_SMALL).where("o_orderkey between 100 and 120")
    merged = merge_upsert(t, s, ["o_orderkey"], ["o_totalprice"], stamp=STAMP, plan="full_outer", prefilter=True)
    p = explain_text(merged)
    assert "FullOuter" in p and "LeftSemi" in p and "LeftAnti" in p and "bit_or" in p
    assert "GreaterThanOrEqual(o_orderkey,100)" in p and "LessThanOrEqual(o_orderkey,120)" in p  # reaches the scan
    # The target side of the outer join is what the semi join lets through, no more.
    maybe, never = possible_matches(t, s, ["o_orderkey"], s.count())
    assert maybe.count() <= 30 and maybe.count() + never.count() == t.count()
    assert "hashpartitioning(o_orderkey" not in explain_text(never)


def test_the_filter_is_used_where_it_pays(spark):
    t, s = fx.target_t(spark, SF_SMALL), fx.source_s(spark, SF_SMALL)
    assert prefilter_pays(spark, t, s, 3)
    assert not prefilter_pays(spark, t, s, 10_000_000)  # as large as the target
    assert not prefilter_pays(spark, t, s, 3, broadcast_max_bytes=32)  # too large to broadcast
    assert bloom_bytes(64) == 64 * n_words(64) and n_words(64) == BITS_PER_KEY
    few = s.where("o_orderkey < 40")
    auto = merge_upsert(t, few, ["o_orderkey"], [], stamp=STAMP, plan="full_outer", staged_rows=few.count())
    assert "bit_or" in explain_text(auto)
    assert "bit_or" not in explain_text(merge_upsert(t, s, ["o_orderkey"], [], stamp=STAMP, plan="full_outer"))


@pytest.fixture
def many_tasks(spark):
    """Small data in many tasks, as large data would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _groups_in(path, column, lo, hi):
    """(row groups whose statistics meet the range, all row groups)."""
    hit = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= hi and stats.max >= lo
    return hit, total


def test_clustered_targets_let_readers_skip_row_groups(spark, tmp_path, many_tasks):
    rows = spark.range(0, 40_000, 1, 8).select((F.xxhash64("id") % 1_000_000).alias("k"), F.lit("x" * 20).alias("v"),
                                               F.when(F.col("id") % 3 == 0, F.lit("2024-01-05")).otherwise(
                                                   F.format_string("2024-%02d-03", F.col("id") % 12 + 1)).cast("timestamp_ntz").alias("d"))
    for name, column in (("flat", None), ("months", "d")):
        plain = write_snapshot(rows, str(tmp_path / f"{name}-plain"), column)
        clustered = write_snapshot(rows, str(tmp_path / f"{name}-clustered"), column, cluster=["k"])
        assert rows_of(spark.read.parquet(clustered).select("k", "v", "d")) == rows_of(rows)
        hit, total = _groups_in(clustered, "k", 1000, 3000)
        if name == "flat":
            assert _groups_in(plain, "k", 1000, 3000)[0] == _groups_in(plain, "k", 1000, 3000)[1]
            assert hit * 4 <= total
        # the large month (a third of all rows) is written by several tasks
        elif name == "months":
            assert len(glob.glob(f"{clustered}/d_month=2024-01-01/*.parquet")) > 1


def test_a_load_keeps_the_clustering(spark, many_tasks):
    from tidemark.plans.jobs import run_load
    from tidemark.spec import TableRef
    table = f"tm_cl_{uuid.uuid4().hex[:8]}"
    publish_snapshot(spark, table, fx.target_t(spark, SF_SMALL, housekeeping=True), cluster=["o_orderkey"])
    spec = fx.orders_spec(target=TableRef(name=table), cluster_keys=True)
    res = run_load(spark, spec, fx.W_START, fx.W_END, load_id=7, source_df=fx.source_s(spark, SF_SMALL), plan="split")
    assert res.error is None and res.insert_cnt + res.update_cnt > 0
    ranges = spark.table(table).groupBy(F.input_file_name().alias("f")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")) \
        .orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))
