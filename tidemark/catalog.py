"""Registered queries (one per operator) and their SQL oracles.

Every query reads the given parquet tables (or frames Spark derives from
them) over their whole extent.  Write-path queries write under the shared
checkpoint folder and read back.  ``ORACLE_SQL`` holds, per key, a plain SQL
statement computing the same relation over the same tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixtures as fx
from tidemark.constants import ACTION_COL
from tidemark.functions.period import Period, ntz, resolve_check_period, resolve_load_period
from tidemark.functions.predicates import changed
from tidemark.functions.udf import register_sql_function
from tidemark.operators.compare import (FINDING_SCHEMA, TablePair, compare_tables, compare_values, empty_table_check,
                                       findings_frame, key_findings, type_findings)
from tidemark.operators.filters import period_filter, window_filter
from tidemark.operators.merge import Stamp, action_counts, change_counts, merge_upsert
from tidemark.operators.quality import constraint_keys, constraint_violations, duplicate_keys, profile_table, row_count
from tidemark.operators.reconcile import missing_in_source, missing_in_target, reconcile, reconcile_by_partition
from tidemark.operators.shape import cast_partition_column, exclude_columns, rename_reserved
from tidemark.plans.jobs import build_extract, readiness_report, run_batch, run_check, run_load
from tidemark.session import fresh_path
from tidemark.sources.readers import read_source, stage
from tidemark.sources.target import create_target, publish_snapshot, recreate_target, write_diffs, write_snapshot
from tidemark.spec import ExtraColumn, JobSpec, SearchColumn, TableRef

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _unique_table(label: str) -> str:
    return f"tm_{label}_{uuid.uuid4().hex[:10]}"


# --- shared SQL text (same relations as fixtures.source_s / target_t) -------
S_SQL = """S as (
  select o_orderkey, o_custkey,
         case when o_orderkey % 13 = 0 then null else o_orderstatus end as o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  from orders)"""
T_SQL = """T as (
  select o_orderkey, o_custkey,
         case when o_orderkey % 11 = 0 then null else o_orderstatus end as o_orderstatus,
         case when o_orderkey % 7 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
         o_orderdate, o_orderpriority, cast(-1 as int) as mstr_load_id
  from orders where o_orderkey % 5 <> 0
  union all
  select o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, cast(-1 as int)
  from orders where o_orderkey % 97 = 0)"""
TH_SQL = """TH as (
  select o_orderkey + 1 as id, timestamp '2000-01-01 00:00:00' as insert_dttm,
         timestamp '2000-01-01 00:00:00' as update_dttm, 'seed' as lst_mod_user, mstr_load_id,
         cast(1 as smallint) as active_flag, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  from T)"""
W_SQL = "o_orderdate between timestamp '1996-01-01 00:00:00' and timestamp '1996-12-31 00:00:00'"
ST_SQL = f"ST as (select * from S where {W_SQL})"
CHANGED_SQL = """(
  (t.o_orderstatus is null and s.o_orderstatus is not null) or
  (t.o_orderstatus is not null and s.o_orderstatus is null) or
  t.o_orderstatus <> s.o_orderstatus or
  (t.o_totalprice is null and s.o_totalprice is not null) or
  (t.o_totalprice is not null and s.o_totalprice is null) or
  t.o_totalprice <> s.o_totalprice)"""


def _merge_sql(target_cte: str, changed_sql: str) -> str:
    """Full outer merge of ST into a target CTE; yields j(action, t.*, s.*)."""
    return f"""j as (
  select case when t.tp is null then 'INSERT' when s.sp is null then 'TARGET_ONLY'
              when {changed_sql} then 'UPDATE' else 'UNCHANGED' end as action,
         t.*, s.o_orderkey as s_o_orderkey, s.o_custkey as s_o_custkey, s.o_orderstatus as s_o_orderstatus,
         s.o_totalprice as s_o_totalprice, s.o_orderdate as s_o_orderdate, s.o_orderpriority as s_o_orderpriority
  from (select *, 1 as tp from {target_cte}) t
  full outer join (select *, 1 as sp from ST) s on t.o_orderkey = s.o_orderkey)"""


BUSINESS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _merged_business_sql() -> str:
    return ",\n  ".join(
        f"case when action in ('INSERT', 'UPDATE') then s_{c} else {c} end as {c}" for c in BUSINESS)


STAMP = Stamp(fx.RUN_LOAD_ID, fx.RUN_TS, fx.RUN_USER)
W = Period(fx.W_START, fx.W_END, fx.W_START, fx.W_END)


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return period_filter(fx.source_s(spark, sf), "o_orderdate", W)


# --- A. sources and sinks ----------------------------------------------------

@query("source_scan", "select * from customer")
def q_source_scan(spark, sf):
    return read_source(spark, TableRef(path=f"{sf}/customer.parquet"))


@query("full_extract", "select * from customer")
def q_full_extract(spark, sf):
    src = read_source(spark, TableRef(path=f"{sf}/customer.parquet"))
    return build_extract(src, fx.customer_spec(), None)


@query("staged_extract", f"with {S_SQL} select * from S where {W_SQL}")
def q_staged_extract(spark, sf):
    staged, _ = stage(build_extract(fx.source_s(spark, sf), fx.orders_spec(), W), "table")
    return staged


@query("create_target", f"""
with {S_SQL}, {ST_SQL}
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cast(o_totalprice * 2 as decimal(18,2)) as price2,
       cast(date_trunc('month', o_orderdate) as date) as o_orderdate_month, 7 as "MSTR_LOAD_ID", 'loader' as "LST_MOD_USER",
       cast(1 as smallint) as "ACTIVE_FLAG", timestamp '2030-01-01 00:00:00' as "INSERT_DTTM"
from ST""")
def q_create_target(spark, sf):
    """A target made from the spec, and the first load into it."""
    table = _unique_table("create")
    spec = fx.orders_spec(target=TableRef(name=table), excluded_columns=("o_orderpriority",), partition_column="o_orderdate",
                          extra_columns=(ExtraColumn("price2", "decimal(18,2)", "source.o_totalprice * 2"),))
    src = fx.source_s(spark, sf)
    create_target(spark, spec, src.schema, table)
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER, source_df=src)
    return spark.table(table).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "price2",
                                     "o_orderdate_month", "MSTR_LOAD_ID", "LST_MOD_USER", "ACTIVE_FLAG", "INSERT_DTTM")


@query("recreate_target", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}
select (select count(*) from TH) as rows_before, cast(0 as bigint) as rows_after, 12 as n_columns""")
def q_recreate_target(spark, sf):
    name, path = _unique_table("recreate"), fresh_path(spark, "recreate")
    fx.target_t(spark, sf, housekeeping=True).write.format("parquet").option("path", path).saveAsTable(name)
    before = spark.table(name).count()
    src = fx.source_s(spark, sf)
    kept = recreate_target(spark, fx.orders_spec(recreate=False), src.schema, name, path)
    if kept.count() != before:
        raise AssertionError("recreate=False must keep the existing target")
    t = recreate_target(spark, fx.orders_spec(recreate=True), src.schema, name, fresh_path(spark, "recreate"))
    return t.agg(F.lit(before).cast("long").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
                 F.lit(len(t.columns)).alias("n_columns"))


@query("partitioned_write", """
select cast(date_trunc('month', o_orderdate) as date) as o_orderdate_month, count(*) as n
from orders group by 1""")
def q_partitioned_write(spark, sf):
    path = fresh_path(spark, "partitioned")
    write_snapshot(read_source(spark, TableRef(path=f"{sf}/orders.parquet")), path, "o_orderdate", "month")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("o_orderdate_month").cast("date").alias("o_orderdate_month")) \
               .agg(F.count(F.lit(1)).alias("n"))


# --- B. projections, filters, predicates --------------------------------------

@query("exclude_columns", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders")
def q_exclude_columns(spark, sf):
    return exclude_columns(fx.read_table(spark, sf, "orders"), ["O_ORDERPRIORITY"])


@query("rename_reserved", f"""
with {S_SQL}
select o_orderkey as S_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate as S_update_dttm,
       o_orderpriority from S""")
def q_rename_reserved(spark, sf):
    s = fx.source_s(spark, sf).withColumnsRenamed({"o_orderdate": "update_dttm", "o_orderkey": "id"})
    return rename_reserved(s)


@query("cast_partition_column", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       cast(cast(o_orderdate as varchar) as timestamp) as o_orderdate, o_orderpriority
from orders""")
def q_cast_partition_column(spark, sf):
    o = fx.read_table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    return cast_partition_column(o, "o_orderdate")


@query("window_filter", f"with {S_SQL} select * from S where {W_SQL}")
def q_window_filter(spark, sf):
    return window_filter(fx.source_s(spark, sf), "o_orderdate", fx.W_START, fx.W_END)


@query("residual_filter", f"with {S_SQL} select * from S where {W_SQL} and o_orderstatus is not null")
def q_residual_filter(spark, sf):
    spec = fx.orders_spec(search_condition="and o_orderstatus is not null")
    return build_extract(fx.source_s(spark, sf), spec, W)


@query("changed_rows", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}
select s.o_orderkey from ST s join T t on t.o_orderkey = s.o_orderkey where {CHANGED_SQL}""")
def q_changed_rows(spark, sf):
    s = _staged(spark, sf).alias("source")
    t = fx.target_t(spark, sf).alias("target")
    j = t.join(s, F.col("target.o_orderkey") == F.col("source.o_orderkey"))
    return j.where(changed(["o_orderstatus", "o_totalprice"])).select(F.col("source.o_orderkey"))


def _with_extra(spark, sf, extra: ExtraColumn, plan: str = "auto") -> DataFrame:
    """The rows that a merge without check columns writes, with an extra column: every staged row."""
    target = fx.target_t(spark, sf).withColumn(extra.name, F.lit(None).cast(extra.data_type))
    merged = merge_upsert(target, _staged(spark, sf), ["o_orderkey"], extra_columns=[extra], plan=plan)
    return merged.where(F.col(ACTION_COL).isin("INSERT", "UPDATE")).select("o_orderkey", extra.name)


@query("derived_columns", f"""
with {S_SQL}
select o_orderkey, cast(o_totalprice * 2 as decimal(18,2)) as price2 from S where {W_SQL}""")
def q_derived_columns(spark, sf):
    return _with_extra(spark, sf, ExtraColumn("price2", "decimal(18,2)", "source.o_totalprice * 2"))


@query("derived_udf", f"""
with {S_SQL}
select o_orderkey, coalesce(o_orderstatus, '?') || '-' || substr(o_orderpriority, 1, 1) as status_code
from S where {W_SQL}""")
def q_derived_udf(spark, sf):
    register_sql_function(spark, "tm_status_code", "status STRING, priority STRING", "STRING",
                          "concat(coalesce(status, '?'), '-', substr(priority, 1, 1))")
    return _with_extra(spark, sf, ExtraColumn(
        "status_code", "string", "tm_status_code(source.o_orderstatus, source.o_orderpriority)"))


def _extra_in_plan(plan: str):
    def run(spark, sf):
        extra = ExtraColumn("price2", "decimal(18,2)", "source.o_totalprice * 2")
        target = fx.target_t(spark, sf).withColumn("price2", F.lit(-1).cast("decimal(18,2)"))
        return merge_upsert(target, _staged(spark, sf), ["o_orderkey"], ["o_orderstatus", "o_totalprice"], [extra], plan=plan) \
            .select("o_orderkey", "price2", ACTION_COL)
    return run


for _plan in ("broadcast", "full_outer", "split"):
    query(f"merge_extra_columns_{_plan}", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', CHANGED_SQL)}
select case when action = 'INSERT' then s_o_orderkey else o_orderkey end as o_orderkey,
       case when action in ('INSERT', 'UPDATE') then cast(s_o_totalprice * 2 as decimal(18,2))
            else cast(-1 as decimal(18,2)) end as price2, action as _action
from j""")(_extra_in_plan(_plan))


@query("stamp_housekeeping", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}, {ST_SQL}, {_merge_sql("TH", CHANGED_SQL)}
select {_merged_business_sql()},
  case when action = 'INSERT' then timestamp '2030-01-01 00:00:00' else insert_dttm end as insert_dttm,
  case when action in ('INSERT', 'UPDATE') then timestamp '2030-01-01 00:00:00' else update_dttm end as update_dttm,
  case when action = 'INSERT' then 'loader' else lst_mod_user end as lst_mod_user,
  case when action in ('INSERT', 'UPDATE') then 7 else mstr_load_id end as mstr_load_id,
  cast(case when action = 'INSERT' then 1 else active_flag end as smallint) as active_flag,
  action as _action
from j""")
def q_stamp_housekeeping(spark, sf):
    m = merge_upsert(fx.target_t(spark, sf, housekeeping=True), _staged(spark, sf), ["o_orderkey"],
                     ["o_orderstatus", "o_totalprice"], stamp=STAMP)
    return m.drop("id")


# --- C. date and period functions ----------------------------------------------

def _events_count(spark: SparkSession, sf: str, p: Period) -> DataFrame:
    ev = fx.read_table(spark, sf, "events")
    return period_filter(ev, "ts", p).agg(F.count(F.lit(1)).alias("n")).select(
        ntz(p.eff_start).alias("eff_start"), ntz(p.eff_end).alias("eff_end"), "n")


def _events_sql(lo: str, hi: str) -> str:
    return f"select {lo} as eff_start, {hi} as eff_end, count(*) as n from events where ts between {lo} and {hi}"


@query("default_period", _events_sql(
    "(select cast(date_trunc('day', min(ts)) as timestamp) from events)", "timestamp '2030-01-01 00:00:00'"))
def q_default_period(spark, sf):
    ev = fx.read_table(spark, sf, "events")
    p = resolve_load_period(fx.events_spec(), None, dt.datetime(2024, 1, 11), now=fx.RUN_TS, source=ev)
    return _events_count(spark, sf, p)


@query("utc_window", _events_sql("timestamp '2024-01-10 05:00:00'", "timestamp '2024-01-11 05:00:00'"))
def q_utc_window(spark, sf):
    spec = fx.events_spec(search_column=SearchColumn("ts", is_utc=True), utc_shift_hours=5)
    p = resolve_load_period(spec, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11), now=fx.RUN_TS)
    return _events_count(spark, sf, p)


@query("day_start_window", _events_sql("timestamp '2024-01-10 00:00:00'", "timestamp '2024-01-11 05:00:00'"))
def q_day_start_window(spark, sf):
    spec = fx.events_spec(set_day_start=True)
    p = resolve_load_period(spec, dt.datetime(2024, 1, 10, 17, 30), dt.datetime(2024, 1, 11, 5), now=fx.RUN_TS)
    return _events_count(spark, sf, p)


@query("check_grace_window", _events_sql("timestamp '2024-01-10 00:00:00'", "timestamp '2024-01-11 05:00:00'"))
def q_check_grace_window(spark, sf):
    p = resolve_check_period(fx.events_spec(), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11), now=fx.RUN_TS)
    return _events_count(spark, sf, p)


@query("earliest_override", _events_sql("(select min(ts) from events)", "timestamp '2024-01-11 05:00:00'"))
def q_earliest_override(spark, sf):
    ev = fx.read_table(spark, sf, "events")
    p = resolve_check_period(fx.events_spec(), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11),
                             now=fx.RUN_TS, earliest=dt.datetime(2001, 1, 1), source=ev)
    return _events_count(spark, sf, p)


# --- D. joins ----------------------------------------------------------------------

MERGED_T_SQL = f"""
select {_merged_business_sql()},
  case when action in ('INSERT', 'UPDATE') then 7 else mstr_load_id end as mstr_load_id,
  action as _action
from j"""


@query("merge_upsert", f"with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', CHANGED_SQL)} {MERGED_T_SQL}")
def q_merge_upsert(spark, sf):
    return merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"],
                        ["o_orderstatus", "o_totalprice"], stamp=STAMP)


@query("merge_upsert_shuffled", ORACLE_SQL["merge_upsert"])
def q_merge_upsert_shuffled(spark, sf):
    return merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"],
                        ["o_orderstatus", "o_totalprice"], stamp=STAMP, plan="full_outer")


@query("merge_prefiltered", ORACLE_SQL["merge_upsert"])
def q_merge_prefiltered(spark, sf):
    return merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"],
                        ["o_orderstatus", "o_totalprice"], stamp=STAMP, plan="full_outer", prefilter=True)


@query("merge_unconditional", f"with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', 'true')} {MERGED_T_SQL}")
def q_merge_unconditional(spark, sf):
    return merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"], [], stamp=STAMP)


@query("merge_actions", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', CHANGED_SQL)}
select action, count(*) as n from j group by action""")
def q_merge_actions(spark, sf):
    m = merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"],
                     ["o_orderstatus", "o_totalprice"], stamp=STAMP)
    return action_counts(m)


@query("change_counts", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', CHANGED_SQL)}
select cast(count_if(action = 'INSERT') as bigint) as insert_cnt,
       cast(count_if(action = 'UPDATE') as bigint) as update_cnt,
       cast(0 as bigint) as delete_cnt, cast(count_if(action = 'UNCHANGED') as bigint) as unchanged_cnt,
       cast(count_if(action = 'TARGET_ONLY') as bigint) as target_only_cnt from j""")
def q_change_counts(spark, sf):
    m = merge_upsert(fx.target_t(spark, sf), _staged(spark, sf), ["o_orderkey"],
                     ["o_orderstatus", "o_totalprice"], stamp=STAMP)
    return change_counts(m)


@query("missing_in_source", f"""
with {S_SQL}, {T_SQL}
select t.o_orderkey, t.o_orderdate from T t
where t.{W_SQL}
  and not exists (select 1 from S s where s.{W_SQL} and s.o_orderkey = t.o_orderkey)""")
def q_missing_in_source(spark, sf):
    return missing_in_source(fx.target_t(spark, sf), fx.source_s(spark, sf), ["o_orderkey"], "o_orderdate", W)


@query("missing_in_target", f"""
with {S_SQL}, {T_SQL}
select s.o_orderkey, s.o_orderdate from S s
where s.{W_SQL}
  and not exists (select 1 from T t where t.{W_SQL} and t.o_orderkey = s.o_orderkey)""")
def q_missing_in_target(spark, sf):
    return missing_in_target(fx.source_s(spark, sf), fx.target_t(spark, sf), ["o_orderkey"], "o_orderdate", W)


@query("missing_in_source_all", f"""
with {S_SQL}, {T_SQL}
select t.o_orderkey from T t where not exists (select 1 from S s where s.o_orderkey = t.o_orderkey)""")
def q_missing_in_source_all(spark, sf):
    return missing_in_source(fx.target_t(spark, sf), fx.source_s(spark, sf), ["o_orderkey"])


@query("missing_in_target_all", f"""
with {S_SQL}, {T_SQL}
select s.o_orderkey from S s where not exists (select 1 from T t where t.o_orderkey = s.o_orderkey)""")
def q_missing_in_target_all(spark, sf):
    return missing_in_target(fx.source_s(spark, sf), fx.target_t(spark, sf), ["o_orderkey"])


# --- E. aggregations ------------------------------------------------------------------

@query("row_count", f"with {S_SQL}, {T_SQL} select count(*) as row_count from T")
def q_row_count(spark, sf):
    return row_count(fx.target_t(spark, sf))


@query("profile_table", f"""
with {S_SQL}
select count(*) as row_count, min(o_orderdate) as min_value, max(o_orderdate) as max_value,
       cast((year(max(o_orderdate)) - year(min(o_orderdate))) * 12
            + month(max(o_orderdate)) - month(min(o_orderdate)) as int) as month_cnt
from S""")
def q_profile_table(spark, sf):
    return profile_table(fx.source_s(spark, sf), "o_orderdate")


@query("profile_no_search_column", """
select count(*) as row_count, cast(null as timestamp) as min_value, cast(null as timestamp) as max_value,
       cast(null as int) as month_cnt
from customer""")
def q_profile_no_search_column(spark, sf):
    return profile_table(fx.read_table(spark, sf, "customer"), None)


@query("duplicate_keys", """
select l_orderkey, l_linenumber, count(*) as n from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""")
def q_duplicate_keys(spark, sf):
    return duplicate_keys(fx.read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("constraint_violations", """
select 'primary_key' as "constraint", l_orderkey, l_linenumber, l_shipdate, count(*) as n from lineitem
group by l_orderkey, l_linenumber, l_shipdate having count(*) > 1
union all
select 'unique_index', l_orderkey, null, l_shipdate, count(*) from lineitem
group by l_orderkey, l_shipdate having count(*) > 1""")
def q_constraint_violations(spark, sf):
    spec = JobSpec("LINEITEM", TableRef(name="lineitem"), TableRef(name="lineitem_t"), ("l_orderkey",),
                   SearchColumn("l_shipdate"), extra_key_columns=("l_linenumber",), partition_column="l_shipdate")
    return constraint_violations(fx.read_table(spark, sf, "lineitem"), spec)


RECONCILE_W_SQL = f"""
with {S_SQL}, {T_SQL},
ms as (select count(*) as c from T t where t.{W_SQL}
         and not exists (select 1 from S s where s.{W_SQL} and s.o_orderkey = t.o_orderkey)),
mt as (select count(*) as c, min(s.o_orderdate) as m from S s where s.{W_SQL}
         and not exists (select 1 from T t where t.{W_SQL} and t.o_orderkey = s.o_orderkey))
select ms.c as src_miss, mt.c as trg_miss, mt.m as min_miss_dttm from ms, mt"""


@query("reconcile", RECONCILE_W_SQL)
def q_reconcile(spark, sf):
    return reconcile(fx.source_s(spark, sf), fx.target_t(spark, sf), ["o_orderkey"], "o_orderdate", W)


@query("reconcile_by_partition", RECONCILE_W_SQL)
def q_reconcile_by_partition(spark, sf):
    """E4 from digests of the months, then from the keys of the months that differ."""
    return reconcile_by_partition(fx.source_s(spark, sf), fx.target_t(spark, sf), ["o_orderkey"], "o_orderdate", W)


@query("reconcile_all", f"""
with {S_SQL}, {T_SQL},
ms as (select count(*) as c from T t where not exists (select 1 from S s where s.o_orderkey = t.o_orderkey)),
mt as (select count(*) as c from S s where not exists (select 1 from T t where t.o_orderkey = s.o_orderkey))
select ms.c as src_miss, mt.c as trg_miss, cast(null as timestamp) as min_miss_dttm from ms, mt""")
def q_reconcile_all(spark, sf):
    return reconcile(fx.source_s(spark, sf), fx.target_t(spark, sf), ["o_orderkey"])


# --- G. surrogate key --------------------------------------------------------------------

@query("assign_ids", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}, {ST_SQL},
ins as (select count(*) as c from ST s where not exists (select 1 from TH t where t.o_orderkey = s.o_orderkey)),
mx as (select max(id) as m from TH)
select mx.m + 1 as min_id, mx.m + ins.c as max_id, ins.c as n_ids from mx, ins""")
def q_assign_ids(spark, sf):
    m = merge_upsert(fx.target_t(spark, sf, housekeeping=True), _staged(spark, sf), ["o_orderkey"],
                     ["o_orderstatus", "o_totalprice"], stamp=STAMP)
    ins = m.where(F.col(ACTION_COL) == "INSERT")
    return ins.agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                   F.count_distinct("id").alias("n_ids"))


@query("assign_ids_shuffled", ORACLE_SQL["assign_ids"])
def q_assign_ids_shuffled(spark, sf):
    """G1 through the shuffled plan (the one a delta too large to broadcast takes)."""
    m = merge_upsert(fx.target_t(spark, sf, housekeeping=True), _staged(spark, sf), ["o_orderkey"],
                     ["o_orderstatus", "o_totalprice"], stamp=STAMP, plan="split")
    ins = m.where(F.col(ACTION_COL) == "INSERT")
    return ins.agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                   F.count_distinct("id").alias("n_ids"))


# --- F. table comparison -------------------------------------------------------------------

def _altered_pair(spark: SparkSession, sf: str):
    s = fx.source_s(spark, sf).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(10,2)"))
    t = (fx.target_t(spark, sf)
         .withColumn("o_custkey", F.expr("case when o_orderkey % 9 = 0 then concat('C', o_custkey) else cast(o_custkey as string) end"))
         .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,4)")).drop("o_orderpriority"))
    return s, t


@query("type_diffs", f"""
with {S_SQL}, {T_SQL},
T2 as (select case when o_orderkey % 9 = 0 then concat('C', o_custkey) else cast(o_custkey as varchar) end as o_custkey from T)
select 'orders' as pair, 'type_mismatch' as kind, 'o_custkey' as column_name, 'src=bigint tgt=string' as detail,
       (select count(o_custkey) from S) as src_values,
       (select count(*) from S where o_custkey is not null and try_cast(o_custkey as varchar) is null) as src_unfit,
       count(o_custkey) as tgt_values,
       count(*) filter (where o_custkey is not null and try_cast(o_custkey as bigint) is null) as tgt_unfit
from T2
union all
select 'orders', 'missing_in_target', 'o_orderpriority', 'target has no column o_orderpriority',
       count(o_orderpriority), count(o_orderpriority), null, null from S""")
def q_type_diffs(spark, sf):
    """the columns whose types differ, and how many values of either side would not survive the cast."""
    return type_findings("orders", *_altered_pair(spark, sf))


KEY_NULLS = "count(*) filter (where {0} is null or {1} is null)"


@query("key_diffs", f"""
with {S_SQL}, {T_SQL},
lines as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all),
late as (select l_orderkey, l_linenumber, count(*) as n from lineitem where l_shipdate >= timestamp '1998-01-01 00:00:00' group by all),
f(pair, kind, detail, n) as (
  select 'orders_narrow', 'key_mismatch', 'keys of the source: o_orderkey, o_custkey; of the target: o_orderkey', null
  union all select 'orders_narrow', 'source_key_missing', 'keys o_orderkey, o_custkey', count(*) from (
    select o_orderkey, o_custkey from S except select o_orderkey, o_custkey from T)
  union all select 'orders_status', 'source_key_null', 'keys o_orderkey, o_orderstatus', {KEY_NULLS.format("o_orderkey", "o_orderstatus")} from S
  union all select 'orders_status', 'target_key_null', 'keys o_orderkey, o_orderstatus', {KEY_NULLS.format("o_orderkey", "o_orderstatus")} from T
  union all select 'orders_status', 'source_key_missing', 'keys o_orderkey, o_orderstatus', count(*) from (
    select o_orderkey, o_orderstatus from S where o_orderstatus is not null except select o_orderkey, o_orderstatus from T)
  union all select 'lines', 'source_key_repeats', 'keys l_orderkey, l_linenumber', count(*) filter (where n > 1) from lines
  union all select 'lines', 'target_key_repeats', 'keys l_orderkey, l_linenumber', count(*) filter (where n > 1) from late
  union all select 'lines', 'source_key_missing', 'keys l_orderkey, l_linenumber', count(*) from (
    select l_orderkey, l_linenumber from lines except select l_orderkey, l_linenumber from late))
select pair, kind, cast(null as varchar) as column_name, detail, cast(n as bigint) as n from f where n is null or n > 0""")
def q_key_diffs(spark, sf):
    """declared keys against each other, and against the rows: NULLs, repeats, keys that the target lacks."""
    s, t, lines = fx.source_s(spark, sf), fx.target_t(spark, sf), fx.read_table(spark, sf, "lineitem")
    late = lines.where("l_shipdate >= timestamp_ntz'1998-01-01 00:00:00'")
    line_keys = ("l_orderkey", "l_linenumber")
    return (key_findings("orders_narrow", s, t, ("o_orderkey", "o_custkey"), constraint_keys(fx.orders_spec())["primary_key"])
            .unionByName(key_findings("orders_status", s, t, ("o_orderkey", "o_orderstatus"), ("O_ORDERKEY", "O_ORDERSTATUS")))
            .unionByName(key_findings("lines", lines, late, line_keys, line_keys)))


@query("compare_values", f"""
with {S_SQL}, {T_SQL},
m as (select s.o_custkey as sc, t.o_custkey as tc, s.o_orderstatus as ss, t.o_orderstatus as ts, s.o_totalprice as sp, t.o_totalprice as tp,
             s.o_orderdate as sd, t.o_orderdate as td, s.o_orderpriority as so, t.o_orderpriority as tpr
      from S s join T t on s.o_orderkey = t.o_orderkey),
f(pair, kind, column_name, detail, n) as (
  select 'orders', 'source_key_missing', null, 'keys o_orderkey', (select count(*) from S where o_orderkey not in (select o_orderkey from T))
  union all select 'orders', 'value_diff', 'o_custkey', 'matched rows that differ', count(*) filter (where sc is distinct from tc) from m
  union all select 'orders', 'value_diff', 'o_orderstatus', 'matched rows that differ', count(*) filter (where ss is distinct from ts) from m
  union all select 'orders', 'value_diff', 'o_totalprice', 'matched rows that differ', count(*) filter (where sp is distinct from tp) from m
  union all select 'orders', 'value_diff', 'o_orderdate', 'matched rows that differ', count(*) filter (where sd is distinct from td) from m
  union all select 'orders', 'value_diff', 'o_orderpriority', 'matched rows that differ', count(*) filter (where so is distinct from tpr) from m
  union all select 'altered', 'type_mismatch', 'o_custkey', 'src=bigint tgt=string', count(*) filter (where false) from S
  union all select 'altered', 'missing_in_target', 'o_orderpriority', 'target has no column o_orderpriority', count(o_orderpriority) from S
  union all select 'altered', 'source_key_missing', null, 'keys o_orderkey', (select count(*) from S where o_orderkey not in (select o_orderkey from T))
  union all select 'altered', 'value_diff', 'o_orderstatus', 'matched rows that differ', count(*) filter (where ss is distinct from ts) from m
  union all select 'altered', 'value_diff', 'o_totalprice', 'matched rows that differ',
    count(*) filter (where cast(cast(sp as decimal(10,2)) as decimal(12,4)) is distinct from cast(tp as decimal(12,4))) from m)
select pair, kind, cast(column_name as varchar) as column_name, detail, cast(n as bigint) as n from f
where n > 0 or kind in ('type_mismatch', 'missing_in_target')""")
def q_compare_values(spark, sf):
    """F4 by value, two pairs side by side."""
    s, t = fx.source_s(spark, sf), fx.target_t(spark, sf)
    s2, t2 = _altered_pair(spark, sf)
    key = ["o_orderkey"]
    return compare_values(spark, [TablePair("orders", lambda: s, lambda: t, key, key),
                                  TablePair("altered", lambda: s2, lambda: t2, key, key)])


@query("empty_tables", """
select * from (values
  ('customer', 'empty_table', cast(null as varchar), '0 rows in customer_t'),
  ('orders_empty_source', 'empty_table', cast(null as varchar), '0 rows in orders_s')
) v(pair, kind, column_name, detail)""")
def q_empty_tables(spark, sf):
    c = fx.read_table(spark, sf, "customer")
    s, t = fx.source_s(spark, sf), fx.target_t(spark, sf)
    found = empty_table_check("orders", s, "orders_s") + empty_table_check("orders", t, "orders_t")
    found += empty_table_check("customer", c, "customer") + empty_table_check("customer", c.where("false"), "customer_t")
    found += empty_table_check("orders_empty_source", s.where("false"), "orders_s")
    return findings_frame(spark, found)


@query("compare_tables", """
select * from (values
  ('orders', 'type_mismatch', 'o_custkey'),
  ('orders', 'missing_in_target', 'o_orderpriority'),
  ('customer', 'empty_table', cast(null as varchar)),
  ('broken', 'error', cast(null as varchar))
) v(pair, kind, column_name)""")
def q_compare_tables(spark, sf):
    s, t = _altered_pair(spark, sf)
    c = fx.read_table(spark, sf, "customer")
    pairs = [
        TablePair("orders", lambda: s, lambda: t, ["o_orderkey"], ["o_orderkey"], "orders_s", "orders_t"),
        TablePair("broken", lambda: c, lambda: spark.read.parquet(f"{sf}/no_such_table.parquet"),
                  ["c_custkey"], ["c_custkey"]),
        TablePair("customer", lambda: c, lambda: c.where("false"), ["c_custkey"], ["c_custkey"],
                  "customer", "customer_t"),
    ]
    return compare_tables(spark, pairs).select("pair", "kind", "column_name")


@query("write_diffs", """
select * from (values
  ('orders', 'type_mismatch', 'o_custkey', 'src=bigint tgt=string'),
  ('orders', 'missing_in_target', 'o_orderpriority', 'target has no column o_orderpriority')
) v(pair, kind, column_name, detail)""")
def q_write_diffs(spark, sf):
    s, t = _altered_pair(spark, sf)
    pairs = [TablePair("orders", lambda: s, lambda: t, ["o_orderkey"], ["o_orderkey"], "orders_s", "orders_t")]
    path = write_diffs(compare_tables(spark, pairs), fresh_path(spark, "diffs"), fmt="csv")
    return spark.read.schema(FINDING_SCHEMA).option("header", "true").csv(path)


# --- A6 / H. jobs ------------------------------------------------------------------------------

def _load_w(spark: SparkSession, sf: str):
    """Load W of S into a fresh catalog copy of TH; return (result, table)."""
    table = _unique_table("orders_t")
    fx.target_t(spark, sf, housekeeping=True).write.format("parquet") \
        .option("path", fresh_path(spark, "orders_t")).saveAsTable(table)
    res = run_load(spark, fx.orders_spec(), fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS,
                   user=fx.RUN_USER, source_df=fx.source_s(spark, sf), target_table=table)
    return res, table


INSERTS_SQL = "(select count(*) from ST s where not exists (select 1 from T t where t.o_orderkey = s.o_orderkey))"
UPDATES_SQL = f"(select count(*) from ST s join T t on t.o_orderkey = s.o_orderkey where {CHANGED_SQL})"


@query("load_history", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}
select 'START' as status, '1996-01-01 00:00:00.000000' as period_start, '1996-12-31 00:00:00.000000' as period_end,
       timestamp '1996-01-01 00:00:00' as eff_start, timestamp '1996-12-31 00:00:00' as eff_end,
       cast(0 as bigint) as staged_cnt, cast(0 as bigint) as insert_cnt, cast(0 as bigint) as update_cnt,
       cast(0 as bigint) as delete_cnt, cast(null as varchar) as error
union all
select 'FINISHED', '1996-01-01 00:00:00.000000', '1996-12-31 00:00:00.000000',
       timestamp '1996-01-01 00:00:00', timestamp '1996-12-31 00:00:00',
       (select count(*) from ST), {INSERTS_SQL}, {UPDATES_SQL}, 0, null""")
def q_load_history(spark, sf):
    res, _ = _load_w(spark, sf)
    return res.history.select("status", "period_start", "period_end", "eff_start", "eff_end", "staged_cnt",
                              "insert_cnt", "update_cnt", "delete_cnt", "error")


@query("run_load", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}
select 'FINISHED' as status, (select count(*) from ST) as staged_cnt, {INSERTS_SQL} as insert_cnt,
       {UPDATES_SQL} as update_cnt, cast(0 as bigint) as delete_cnt,
       (select count(*) from T) + {INSERTS_SQL} as target_rows,
       {INSERTS_SQL} + {UPDATES_SQL} as rows_with_load_id""")
def q_run_load(spark, sf):
    res, table = _load_w(spark, sf)
    t = spark.table(table)
    counts = t.agg(F.count(F.lit(1)).alias("target_rows"),
                   F.count_if(F.col("MSTR_LOAD_ID") == fx.RUN_LOAD_ID).alias("rows_with_load_id"))
    return counts.select(F.lit("FINISHED").alias("status"), F.lit(res.staged_cnt).cast("long").alias("staged_cnt"),
                         F.lit(res.insert_cnt).cast("long").alias("insert_cnt"),
                         F.lit(res.update_cnt).cast("long").alias("update_cnt"),
                         F.lit(res.delete_cnt).cast("long").alias("delete_cnt"), "target_rows", "rows_with_load_id")


@query("partition_scoped_load", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}, {ST_SQL}, {_merge_sql('TH', CHANGED_SQL)}
select {_merged_business_sql()},
  case when action in ('INSERT', 'UPDATE') then 7 else mstr_load_id end as mstr_load_id,
  cast(date_trunc('month', case when action in ('INSERT', 'UPDATE') then s_o_orderdate else o_orderdate end)
       as date) as o_orderdate_month
from j""")
def q_partition_scoped_load(spark, sf):
    """A load that reads and re-points only the months its window touches."""
    table = _unique_table("orders_pt")
    publish_snapshot(spark, table, fx.target_t(spark, sf, housekeeping=True), "o_orderdate", "month")
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate",
                          keys=("o_orderkey", "o_orderdate"), partition_scoped=True)
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER,
             source_df=fx.source_s(spark, sf))
    return spark.table(table).select(*BUSINESS, "mstr_load_id", "o_orderdate_month")


@query("partitioned_target_load", ORACLE_SQL["partition_scoped_load"])
def q_partitioned_target_load(spark, sf):
    """A month-partitioned target keyed without the month: the load finds the partitions
    it can change (the window's months plus those holding matched keys) and
    re-points only those."""
    table = _unique_table("orders_pk")
    publish_snapshot(spark, table, fx.target_t(spark, sf, housekeeping=True), "o_orderdate", "month")
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate")
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER,
             source_df=fx.source_s(spark, sf))
    return spark.table(table).select(*BUSINESS, "mstr_load_id", "o_orderdate_month")


@query("clustered_target_load", ORACLE_SQL["partition_scoped_load"])
def q_clustered_target_load(spark, sf):
    """As partitioned_target_load, with files in ranges of the key and shuffled joins."""
    table = _unique_table("orders_cl")
    publish_snapshot(spark, table, fx.target_t(spark, sf, housekeeping=True), "o_orderdate", "month", cluster=["o_orderkey"])
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate", cluster_keys=True)
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER,
             source_df=fx.source_s(spark, sf), plan="split")
    return spark.table(table).select(*BUSINESS, "mstr_load_id", "o_orderdate_month")


@query("incremental_stream_load", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}, ST as (select * from S), {_merge_sql('TH', CHANGED_SQL)}
select {_merged_business_sql()},
  case when action in ('INSERT', 'UPDATE') then 7 else mstr_load_id end as mstr_load_id,
  action in ('INSERT') as inserted
from j""")
def q_incremental_stream_load(spark, sf):
    """The orders file as a stream; each micro-batch merged into the target (foreachBatch)."""
    from tidemark.streaming import file_stream, start_incremental_load
    table = _unique_table("orders_st")
    fx.target_t(spark, sf, housekeeping=True).write.format("parquet") \
        .option("path", fresh_path(spark, "orders_st")).saveAsTable(table)
    stream = fx.shape_s(file_stream(spark, sf, glob="orders.parquet"))
    q = start_incremental_load(spark, fx.orders_spec(target=TableRef(name=table)), stream, target_table=table,
                               history_table=_unique_table("hist"), load_id_base=fx.RUN_LOAD_ID, user=fx.RUN_USER,
                               clock=lambda: fx.RUN_TS)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.table(table).select(*BUSINESS, "mstr_load_id", (F.col("LST_MOD_USER") == "loader").alias("inserted"))


@query("run_check", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}, {_merge_sql('T', CHANGED_SQL)},
NT as (select case when action in ('INSERT', 'UPDATE') then s_o_orderkey else o_orderkey end as o_orderkey,
              case when action in ('INSERT', 'UPDATE') then s_o_orderdate else o_orderdate end as o_orderdate
       from j),
ms as (select count(*) as c from NT t
       where t.o_orderdate between timestamp '1996-01-01 00:00:00' and timestamp '1996-12-31 05:00:00'
         and not exists (select 1 from S s where s.o_orderdate between timestamp '1996-01-01 00:00:00'
                         and timestamp '1996-12-31 05:00:00' and s.o_orderkey = t.o_orderkey)),
mt as (select count(*) as c, min(s.o_orderdate) as m from S s
       where s.o_orderdate between timestamp '1996-01-01 00:00:00' and timestamp '1996-12-31 05:00:00'
         and not exists (select 1 from NT t where t.o_orderdate between timestamp '1996-01-01 00:00:00'
                         and timestamp '1996-12-31 05:00:00' and t.o_orderkey = s.o_orderkey))
select ms.c as src_miss, mt.c as trg_miss, mt.m as min_miss_dttm,
       case when mt.c > 0 then 'CHECK_MERGE_ORDERS : MIN DTTM MISSING FROM TARGET : '
            || strftime(mt.m, '%Y-%m-%d %H:%M:%S.%f')
            || ' in SEARCH date range 1996-01-01 00:00:00.000000 and 1996-12-31 05:00:00.000000'
            else '' end as message
from ms, mt""")
def q_run_check(spark, sf):
    _, table = _load_w(spark, sf)
    r = run_check(spark, fx.orders_spec(), fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID + 1, now=fx.RUN_TS,
                  source_df=fx.source_s(spark, sf), target_df=spark.table(table))
    return r.history.where("status = 'FINISHED'").select(
        F.col("insert_cnt").alias("src_miss"), F.col("update_cnt").alias("trg_miss"),
        (ntz(r.min_miss_dttm) if r.min_miss_dttm else F.lit(None).cast("timestamp_ntz")).alias("min_miss_dttm"),
        "message")


@query("run_check_partitioned", ORACLE_SQL["run_check"])
def q_run_check_partitioned(spark, sf):
    """The same check against a month-partitioned target (the window prunes its partitions)."""
    table = _unique_table("orders_pc")
    publish_snapshot(spark, table, fx.target_t(spark, sf, housekeeping=True), "o_orderdate", "month")
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate")
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER,
             source_df=fx.source_s(spark, sf))
    r = run_check(spark, spec, fx.W_START, fx.W_END, load_id=fx.RUN_LOAD_ID + 1, now=fx.RUN_TS,
                  source_df=fx.source_s(spark, sf), target_df=spark.table(table))
    return r.history.where("status = 'FINISHED'").select(
        F.col("insert_cnt").alias("src_miss"), F.col("update_cnt").alias("trg_miss"),
        (ntz(r.min_miss_dttm) if r.min_miss_dttm else F.lit(None).cast("timestamp_ntz")).alias("min_miss_dttm"),
        "message")


@query("run_batch", f"""
with {S_SQL}, {T_SQL}, {ST_SQL}
select 'MERGE_ORDERS' as job, 'FINISHED' as status, (select count(*) from ST) as staged_cnt,
       {INSERTS_SQL} as insert_cnt, {UPDATES_SQL} as update_cnt
union all
select 'MERGE_BROKEN', 'ERROR', null, null, null
union all
select 'MERGE_EVENTS', 'FINISHED', count(*), count(*), cast(0 as bigint) from events
where ts between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-11 00:00:00'""")
def q_run_batch(spark, sf):
    orders_t = _unique_table("orders_t")
    fx.target_t(spark, sf, housekeeping=True).write.format("parquet") \
        .option("path", fresh_path(spark, "orders_t")).saveAsTable(orders_t)
    events_t = _unique_table("events_t")
    src = {"MERGE_ORDERS": fx.source_s(spark, sf), "MERGE_BROKEN": fx.read_table(spark, sf, "customer"),
           "MERGE_EVENTS": fx.read_table(spark, sf, "events")}
    specs = [fx.orders_spec(target=TableRef(name=orders_t)),
             fx.customer_spec(name="MERGE_BROKEN", search_column=SearchColumn("no_such_column"),
                              target=TableRef(name=_unique_table("broken_t"))),
             fx.events_spec(target=TableRef(name=events_t))]
    windows = {"MERGE_ORDERS": (fx.W_START, fx.W_END),
               "MERGE_EVENTS": (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11))}

    def job(spec):
        lo, hi = windows.get(spec.name, (fx.W_START, fx.W_END))
        return run_load(spark, spec, lo, hi, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER,
                        source_df=src[spec.name])

    return run_batch(spark, specs, job).select("job", "status", "staged_cnt", "insert_cnt", "update_cnt")


@query("readiness_report", f"""
with {S_SQL}, {T_SQL}, {TH_SQL}
select 'MERGE_ORDERS' as job, 'o_orderdate' as search_column, true as search_column_exists,
       count(*) as row_count, min(o_orderdate) as min_value, max(o_orderdate) as max_value,
       cast((year(max(o_orderdate)) - year(min(o_orderdate))) * 12
            + month(max(o_orderdate)) - month(min(o_orderdate)) as int) as month_cnt,
       true as target_exists, (select count(*) from TH) as target_row_count, cast(null as varchar) as error
from S
union all
select 'MERGE_EVENTS', 'ts', true, count(*), min(ts), max(ts),
       cast((year(max(ts)) - year(min(ts))) * 12 + month(max(ts)) - month(min(ts)) as int),
       false, cast(0 as bigint), null
from events
union all
select 'MERGE_CUSTOMER', null, false, count(*), null, null, null, false, cast(0 as bigint), null from customer""")
def q_readiness_report(spark, sf):
    specs = [fx.orders_spec(), fx.events_spec(target=TableRef(name=_unique_table("absent"))),
             fx.customer_spec(target=TableRef(name=_unique_table("absent")))]
    sources = {"MERGE_ORDERS": fx.source_s(spark, sf), "MERGE_EVENTS": fx.read_table(spark, sf, "events"),
               "MERGE_CUSTOMER": fx.read_table(spark, sf, "customer")}
    targets = {"MERGE_ORDERS": fx.target_t(spark, sf, housekeeping=True)}
    return readiness_report(spark, specs, sources, targets).drop("source_table")


__all__ = ["QUERIES", "ORACLE_SQL"]


# --- loads at their limits -------------------------------------------------------------------

@query("null_partition_load", f"""
with {S_SQL}, {T_SQL}, {TH_SQL},
D as (select * replace (case when o_orderkey % 3 = 0 then null else o_orderdate end as o_orderdate) from S)
select coalesce(D.o_orderkey, t.o_orderkey) as o_orderkey,
       case when D.o_orderkey is not null then D.o_orderdate else t.o_orderdate end as o_orderdate,
       cast(date_trunc('month', case when D.o_orderkey is not null then D.o_orderdate else t.o_orderdate end) as date) as o_orderdate_month
from TH t full outer join D on D.o_orderkey = t.o_orderkey""")
def q_null_partition_load(spark, sf):
    """Rows that get no date move to, or arrive in, the NULL partition of a table that had none."""
    table = _unique_table("orders_np")
    publish_snapshot(spark, table, fx.target_t(spark, sf, housekeeping=True), "o_orderdate", "month")
    spec = fx.orders_spec(target=TableRef(name=table), partition_column="o_orderdate", search_column=None, check_columns=())
    undated = fx.source_s(spark, sf).withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")))
    run_load(spark, spec, load_id=fx.RUN_LOAD_ID, now=fx.RUN_TS, user=fx.RUN_USER, source_df=undated)
    return spark.table(table).select("o_orderkey", "o_orderdate", "o_orderdate_month")


@query("assign_ids_two_jobs", f"""
with {S_SQL}, {T_SQL},
ins as (select count(*) as c from S where not exists (select 1 from T t where t.o_orderkey = S.o_orderkey)),
mx as (select max(o_orderkey) + 1 as m, count(*) as n from T)
select mx.n + ins.c as n_rows, mx.n + ins.c as n_ids, mx.m + ins.c as max_id from mx, ins""")
def q_assign_ids_two_jobs(spark, sf):
    """Two jobs load halves of the source into one target: no id is given twice."""
    table, history = _unique_table("orders_2j"), _unique_table("hist_2j")
    fx.target_t(spark, sf, housekeeping=True).write.format("parquet").option("path", fresh_path(spark, "orders_2j")).saveAsTable(table)
    src = fx.source_s(spark, sf)
    for n, half in enumerate((src.where("o_orderkey % 2 = 0"), src.where("o_orderkey % 2 = 1"))):
        run_load(spark, fx.orders_spec(name=f"JOB{n}", target=TableRef(name=table), search_column=None), load_id=n, now=fx.RUN_TS,
                 user=fx.RUN_USER, source_df=half, history_table=history)
    return spark.table(table).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.max("id").alias("max_id"))


@query("utc_window_from_config", """
select count(*) as n from events where ts between timestamp '2024-01-10 05:00:00' and timestamp '2024-01-11 05:00:00'""")
def q_utc_window_from_config(spark, sf):
    """The window of a job file whose column is in UTC and whose load server's zone is named."""
    spec = JobSpec.from_config({
        "SOURCE_TABLE": "events", "TARGET_TABLE": "events_t", "SOURCE_TABLE_PRIMARY_KEY": ["event_id"],
        "SOURCE_TABLE_SEARCH_COLUMN": {"column_name": "ts", "is_utc": True}, "LOAD_TIME_ZONE": "America/New_York"})
    period = resolve_load_period(spec, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11), now=dt.datetime(2024, 1, 12))
    return build_extract(fx.read_table(spark, sf, "events"), spec, period).agg(F.count(F.lit(1)).alias("n"))
