"""Hot groups: a third of all rows on one key must not land in one task."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.constants import ACTION_COL
from tidemark.operators.merge import Stamp, merge_upsert
from tidemark.operators.reconcile import reconcile

STAMP = Stamp(7, dt.datetime(2030, 1, 1), "loader")


def _no_coalesce(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_null_keys_spread_in_full_outer_merge(spark):
    _no_coalesce(spark)
    try:
        n = 30_000
        t = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
            (F.col("id") % 5).alias("c"), F.lit(-1).alias("mstr_load_id"))  # a third: NULL key
        s = spark.range(n // 2, n + n // 2).select(F.col("id").alias("k"), (F.col("id") % 7).alias("c"))
        m = merge_upsert(t, s, ["k"], ["c"], stamp=STAMP, plan="full_outer")
        sizes = [r["n"] for r in m.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == m.count()
        assert max(sizes) < n // 3  # the 10,000 NULL-key rows never gather in one join task
        assert m.where(F.col("k").isNull() & (F.col(ACTION_COL) == "TARGET_ONLY")).count() == n // 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_key_is_combined_before_the_reconcile_shuffle(spark):
    n = 30_000
    src = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    tgt = spark.range(2, n).select(F.col("id").alias("k"))
    r = reconcile(src, tgt, ["k"]).first()
    # key 1 holds a third of the source (+ id 1 itself) and is not in the target;
    # the target's multiples of 3 (3 .. 29997) have no source row
    assert (r.trg_miss, r.src_miss) == (n // 3 + 1, n // 3 - 1)
    plan = reconcile(src, tgt, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan  # each side is reduced per key before the join
