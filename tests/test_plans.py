"""Physical plan shape: the choices that matter at scale."""

from tidemark import fixtures as fx
from tidemark.catalog import STAMP, W
from tidemark.operators.filters import period_filter
from tidemark.operators.merge import merge_upsert
from tidemark.operators.reconcile import missing_in_source, missing_in_target, reconcile
from tidemark.operators.surrogate import assign_ids
from conftest import SF_SMALL, explain_text


def plan_of(df) -> str:
    return explain_text(df)


def test_anti_joins_are_left_anti(spark):
    s, t = fx.source_s(spark, SF_SMALL), fx.target_t(spark, SF_SMALL)
    assert "LeftAnti" in plan_of(missing_in_source(t, s, ["o_orderkey"], "o_orderdate", W))
    assert "LeftAnti" in plan_of(missing_in_target(s, t, ["o_orderkey"], "o_orderdate", W))


def test_broadcast_merge_never_shuffles_target(spark):
    s, t = period_filter(fx.source_s(spark, SF_SMALL), "o_orderdate", W), fx.target_t(spark, SF_SMALL)
    p = plan_of(merge_upsert(t, s, ["o_orderkey"], ["o_totalprice"], stamp=STAMP, plan="broadcast"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "LeftOuter" in p and "LeftSemi" in p and "LeftAnti" in p


def test_full_outer_merge_keeps_null_keys_out_of_the_join(spark):
    s, t = period_filter(fx.source_s(spark, SF_SMALL), "o_orderdate", W), fx.target_t(spark, SF_SMALL)
    p = plan_of(merge_upsert(t, s, ["o_orderkey"], ["o_totalprice"], stamp=STAMP, plan="full_outer"))
    assert "FullOuter" in p and "Union" in p
    assert "PushedFilters: [IsNull(o_orderkey)" in p or "IsNull(o_orderkey)" in p


def test_reconcile_has_no_anti_join_and_one_pass(spark):
    s, t = fx.source_s(spark, SF_SMALL), fx.target_t(spark, SF_SMALL)
    p = plan_of(reconcile(s, t, ["o_orderkey"], "o_orderdate", W))
    assert "LeftAnti" not in p and "FullOuter" in p


def test_ids_single_partition_only_over_bucket_sizes(spark):
    df = fx.read_table(spark, SF_SMALL, "orders")
    p = plan_of(assign_ids(df, 0, ["o_orderkey"], buckets=8))
    # the only SinglePartition exchange carries the (bucket, size) pairs
    assert p.count("SinglePartition") == 1
    block = [b for b in p.split("\n\n") if "SinglePartition" in b][0]
    inputs = [ln for ln in block.splitlines() if ln.startswith("Input")][0]
    assert inputs.startswith("Input [2]:") and "__b" in inputs and "__n" in inputs


def test_scoped_load_reads_only_touched_partitions(spark):
    import uuid
    from tidemark.plans.jobs import matched_rows, scope_to_partitions
    from tidemark.sources.target import publish_snapshot
    from tidemark.spec import TableRef
    table = f"tm_scope_{uuid.uuid4().hex[:8]}"
    publish_snapshot(spark, table, fx.target_t(spark, SF_SMALL, housekeeping=True), "o_orderdate", "month")
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate",
                          keys=("o_orderkey", "o_orderdate"), partition_scoped=True)
    staged = period_filter(fx.source_s(spark, SF_SMALL), "o_orderdate", W)
    target = spark.table(table)
    matched = matched_rows(target, staged, spec, ["o_orderdate_month"])
    assert "SortMergeJoin" not in plan_of(matched)  # the target isn't shuffled
    sliced, scope = scope_to_partitions(target, staged, spec, staged.schema, matched=matched)
    assert 0 < len(scope) <= 12
    scan = [ln for ln in plan_of(sliced).splitlines() if ln.startswith("PartitionFilters")][0]
    assert "o_orderdate_month" in scan and ("IN (" in scan or "In(" in scan or "INSET" in scan.upper())


def test_window_prunes_partitions_of_a_partitioned_target(spark):
    import datetime as dt
    import uuid
    from tidemark.sources.target import prune_to_window, publish_snapshot
    table = f"tm_pw_{uuid.uuid4().hex[:8]}"
    publish_snapshot(spark, table, fx.target_t(spark, SF_SMALL), "o_orderdate", "month")
    t = prune_to_window(spark.table(table), "o_orderdate", "O_ORDERDATE", dt.datetime(1996, 1, 1),
                        dt.datetime(1996, 3, 15, 5))
    scan = [ln for ln in plan_of(t).splitlines() if ln.startswith("PartitionFilters")][0]
    assert "o_orderdate_month" in scan and "1996-01-01" in scan and "1996-03-01" in scan
    months = {r[0].isoformat() for r in t.select("o_orderdate_month").distinct().collect()}
    assert months <= {"1996-01-01", "1996-02-01", "1996-03-01"}
