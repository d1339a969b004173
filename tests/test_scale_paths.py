"""Scoped loads, streaming batches and user functions."""

import datetime as dt
import uuid

from tidemark import fixtures as fx
from tidemark.functions.udf import register_pandas_function, register_sql_function
from tidemark.operators.shape import derived_columns
from tidemark.plans.jobs import run_load
from tidemark.sources.target import publish_snapshot
from tidemark.spec import ExtraColumn, JobSpec, SearchColumn, TableRef
from tidemark.streaming import already_loaded, start_incremental_load
from tidemark.session import fresh_path

D = dt.datetime


def _src(spark, rows):
    return spark.createDataFrame(rows, "k long, d timestamp_ntz, v string")


def test_scoped_load_new_partition_and_ids_from_whole_table(spark):
    table = f"tm_sc_{uuid.uuid4().hex[:8]}"
    seed = D(2000, 1, 1)
    tgt = spark.createDataFrame(
        [(1, seed, seed, "seed", -1, 1, 1, D(2024, 1, 5), "a"), (50, seed, seed, "seed", -1, 1, 2, D(2024, 2, 5), "b")],
        "ID long, INSERT_DTTM timestamp_ntz, UPDATE_DTTM timestamp_ntz, LST_MOD_USER string, MSTR_LOAD_ID int, "
        "ACTIVE_FLAG smallint, k long, d timestamp_ntz, v string")
    publish_snapshot(spark, table, tgt, "d", "month")
    spec = JobSpec("SC", TableRef(name="src"), TableRef(name=table), ("k", "d"), SearchColumn("d"),
                   check_columns=("v",), partition_column="d")
    assert spec.scoped_by_partition  # the partition column is part of the key
    src = _src(spark, [(1, D(2024, 1, 5), "a2"), (3, D(2024, 3, 1), "c")])
    res = run_load(spark, spec, D(2024, 1, 1), D(2024, 12, 31), load_id=9, now=D(2030, 1, 1), user="u",
                   source_df=src)
    assert (res.insert_cnt, res.update_cnt) == (1, 1)
    rows = {r.k: r for r in spark.table(table).collect()}
    assert rows[1].v == "a2" and rows[2].v == "b" and rows[3].v == "c"
    assert rows[3].ID == 51  # above the max id of the whole table, not of the touched slice
    assert str(rows[3].d_month) == "2024-03-01"
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert parts == {"d_month=2024-01-01", "d_month=2024-02-01", "d_month=2024-03-01"}


def test_stream_batches_load_and_replays_are_skipped(spark):
    src_dir = fresh_path(spark, "stream-src")
    _src(spark, [(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 2), "b")]).write.parquet(src_dir)
    table = f"tm_st_{uuid.uuid4().hex[:8]}"
    hist = f"tm_hist_{uuid.uuid4().hex[:8]}"
    spec = JobSpec("ST", TableRef(path=src_dir), TableRef(name=table), ("k",), SearchColumn("d"),
                   check_columns=("v",))
    schema = "k long, d timestamp_ntz, v string"
    ck = fresh_path(spark, "stream-ck")
    q = start_incremental_load(spark, spec, spark.readStream.schema(schema).parquet(src_dir), target_table=table,
                               history_table=hist, checkpoint=ck, clock=lambda: D(2030, 1, 1))
    q.awaitTermination()
    assert spark.table(table).count() == 2 and already_loaded(spark, hist, "ST", 0)
    _src(spark, [(2, D(2024, 1, 2), "b2"), (3, D(2024, 1, 3), "c")]).write.mode("append").parquet(src_dir)
    q = start_incremental_load(spark, spec, spark.readStream.schema(schema).parquet(src_dir), target_table=table,
                               history_table=hist, checkpoint=ck, clock=lambda: D(2030, 1, 2))
    q.awaitTermination()
    got = {r.k: r.v for r in spark.table(table).collect()}
    assert got == {1: "a", 2: "b2", 3: "c"}
    fins = spark.table(hist).where("status = 'FINISHED'").select("load_id", "insert_cnt", "update_cnt").collect()
    assert sorted(map(tuple, fins)) == [(0, 2, 0), (1, 1, 1)]


def test_user_functions_in_extra_columns(spark):
    register_sql_function(spark, "tm_t_code", "a STRING", "STRING", "upper(substr(a, 1, 1))")
    register_pandas_function(spark, "tm_t_len", lambda s: s.str.len().astype("Int64"), "long")
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k long, v string")
    out = derived_columns(df, [ExtraColumn("c", "string", "tm_t_code(source.v)"),
                               ExtraColumn("n", "bigint", "tm_t_len(source.v)")])
    rows = {r.k: (r.c, r.n) for r in out.collect()}
    assert rows == {1: ("A", 3), 2: (None, None)}


def test_full_snapshot_drops_partitions_emptied_by_moves(spark):
    table = f"tm_mv_{uuid.uuid4().hex[:8]}"
    tgt = spark.createDataFrame([(1, D(2024, 1, 5), "a"), (2, D(2024, 2, 5), "b")], "k long, d timestamp_ntz, v string")
    publish_snapshot(spark, table, tgt, "d", "month")
    # key k only: the partition column is not in the key, so a row may move months
    spec = JobSpec("MV", TableRef(name="src"), TableRef(name=table), ("k",), SearchColumn("d"),
                   check_columns=("d",), partition_column="d")
    assert not spec.scoped_by_partition
    src = _src(spark, [(1, D(2024, 3, 1), "a")])  # row 1 moves from January to March
    run_load(spark, spec, D(2024, 1, 1), D(2024, 12, 31), load_id=3, now=D(2030, 1, 1), user="u", source_df=src)
    rows = sorted((r.k, str(r.d_month)) for r in spark.table(table).collect())
    assert rows == [(1, "2024-03-01"), (2, "2024-02-01")]
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert parts == {"d_month=2024-02-01", "d_month=2024-03-01"}
