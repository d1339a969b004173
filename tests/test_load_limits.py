"""Loads at their limits: NULL partitions, concurrent writers, ids, history, streams, plan choices."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark import session as S
from tidemark.functions.period import resolve_load_period
from tidemark.operators.reconcile import missing_in_source
from tidemark.plans.jobs import run_batch, run_load
from tidemark.plans.strategy import plan_merge
from tidemark.session import fresh_path
from tidemark.sources import target as tg
from tidemark.sources.readers import stage_extract
from tidemark.spec import ExtraColumn, JobSpec, SearchColumn, SpecError, TableRef, validate_spec
from tidemark.streaming import start_incremental_load
from conftest import SF_SMALL, explain_text

D = dt.datetime
NOW = D(2030, 1, 1)
ROWS = "k long, d timestamp_ntz, v string"


def _name(label):
    return f"tm_{label}_{uuid.uuid4().hex[:8]}"


def _spec(table, **changes):
    return JobSpec("L", TableRef(name="src"), TableRef(name=table), ("k",), check_columns=("v",)).with_(**changes)


@pytest.mark.parametrize("limit", [None, 1])  # broadcast; shuffled
def test_null_partition_of_a_table_without_one(spark, limit):
    table = _name("np")
    first = spark.createDataFrame([(1, D(2024, 1, 5), "a"), (2, D(2024, 2, 5), "b")], ROWS)
    run = lambda rows, n: run_load(spark, _spec(table, partition_column="d"), load_id=n, now=NOW, user="u",
                                   source_df=spark.createDataFrame(rows, ROWS), broadcast_max_bytes=limit)
    run_load(spark, _spec(table, partition_column="d"), load_id=1, now=NOW, user="u", source_df=first)
    res = run([(2, None, "moved"), (3, None, "new")], 2)
    assert (res.insert_cnt, res.update_cnt, res.error) == (1, 1, None)
    got = sorted((r.k, r.v, str(r.d_month)) for r in spark.table(table).collect())
    assert got == [(1, "a", "2024-01-01"), (2, "moved", "None"), (3, "new", "None")]
    run([(2, D(2024, 3, 1), "back")], 3)
    got = sorted((r.k, r.v, str(r.d_month)) for r in spark.table(table).collect())
    assert got == [(1, "a", "2024-01-01"), (2, "back", "2024-03-01"), (3, "new", "None")]


def test_null_keys_all_insert(spark):
    table = _name("nk")
    rows = spark.createDataFrame([(None, None, "a"), (None, None, "a"), (1, None, "b")], ROWS)
    res = run_load(spark, _spec(table), load_id=1, now=NOW, user="u", source_df=rows)
    assert res.insert_cnt == 3 and spark.table(table).count() == 3


def test_a_publish_in_between_is_refused(spark, monkeypatch):
    from tidemark.plans import jobs
    table = _name("cw")
    one, two = spark.createDataFrame([(1, None, "a")], ROWS), spark.createDataFrame([(2, None, "b")], ROWS)
    run_load(spark, _spec(table), load_id=1, now=NOW, user="u", source_df=spark.createDataFrame([(9, None, "z")], ROWS))
    plain = jobs.merge_upsert

    def with_rival(*args, **kw):
        monkeypatch.setattr(jobs, "merge_upsert", plain)
        run_load(spark, _spec(table), load_id=2, now=NOW, user="u", source_df=two)
        return plain(*args, **kw)

    monkeypatch.setattr(jobs, "merge_upsert", with_rival)
    with pytest.raises(tg.ConcurrentLoadError):
        run_load(spark, _spec(table), load_id=3, now=NOW, user="u", source_df=one)
    run_load(spark, _spec(table), load_id=4, now=NOW, user="u", source_df=one)
    assert sorted(r.k for r in spark.table(table).collect()) == [1, 2, 9]


def test_batch_runs_jobs_on_one_target_in_turn(spark):
    table = _name("bt")
    parts = {f"J{i}": spark.createDataFrame([(i, None, "x")], ROWS) for i in range(3)}
    specs = [_spec(table).with_(name=n) for n in parts]
    out = run_batch(spark, specs, lambda s: run_load(spark, s, load_id=1, now=NOW, user="u", source_df=parts[s.name]), max_workers=3)
    assert {r.status for r in out.collect()} == {"FINISHED"}
    t = spark.table(table)
    assert sorted(r.k for r in t.collect()) == [0, 1, 2] and t.select("ID").distinct().count() == 3


def test_ids_after_a_crash_by_hand_and_from_a_restored_table(spark):
    table, hist = _name("id"), _name("idh")
    load = lambda n, *ks: run_load(spark, _spec(table), load_id=n, now=NOW, user="u", history_table=hist,
                                   source_df=spark.createDataFrame([(k, None, "x") for k in ks], ROWS))
    load(1, 1, 2)
    spark.table(table).write.parquet(copy := fresh_path(spark, "copy"))
    run_load(spark, _spec(table), load_id=2, now=NOW, user="u", source_df=spark.createDataFrame([(3, None, "x")], ROWS))  # no history
    load(3, 4)
    spark.sql(f"insert into {table} select 100, INSERT_DTTM, UPDATE_DTTM, LST_MOD_USER, MSTR_LOAD_ID, ACTIVE_FLAG, 5, d, v from {table} where k = 1")
    load(4, 6)
    ids = {r.k: r.ID for r in spark.table(table).collect()}
    assert len(set(ids.values())) == 6 and ids[6] == 101
    spark.sql(f"alter table {table} set location '{copy}'")
    spark.catalog.refreshTable(table)
    load(5, 7)
    assert {r.k: r.ID for r in spark.table(table).collect()}[7] == 102


def test_history_has_the_start_and_every_failure_in_full(spark):
    hist = _name("hs")
    bad = _spec(_name("x"), search_column=SearchColumn("nope"))
    src = spark.createDataFrame([(1, None, "a")], ROWS)
    res = run_load(spark, bad, load_id=1, now=NOW, source_df=src, history_table=hist, raise_errors=False)
    assert "nope" in res.error and sorted(r.status for r in spark.table(hist).collect()) == ["FINISHED", "START"]
    gone = _spec(_name("y")).with_(source=TableRef(path="/nowhere/at/all"))
    with pytest.raises(Exception):
        run_load(spark, gone, load_id=2, now=NOW, history_table=hist)
    last = spark.table(hist).where("load_id = 2 and status = 'FINISHED'").first()
    assert "/nowhere/at/all" in last.error and last.staged_cnt == 0
    twice = spark.createDataFrame([(1, None, "a" * 900), (1, None, "b")], ROWS)
    res = run_load(spark, _spec(_name("z")), load_id=3, now=NOW, source_df=twice, raise_errors=False)
    assert "DuplicateKeyError" in res.error


def test_nothing_is_published_without_changes(spark):
    table = _name("nc")
    src = spark.createDataFrame([(1, None, "a"), (2, None, "b")], ROWS)
    run_load(spark, _spec(table), load_id=1, now=NOW, user="u", source_df=src)
    before = tg.table_version(spark, table)
    again = run_load(spark, _spec(table), load_id=2, now=NOW, user="u", source_df=src)
    none = run_load(spark, _spec(table), load_id=3, now=NOW, user="u", source_df=src.where("false"))
    assert again.snapshot is None and none.snapshot is None and tg.table_version(spark, table) == before
    run_load(spark, _spec(table), load_id=4, now=NOW, user="u", source_df=src.withColumn("v", F.lit("c")))
    assert tg.table_version(spark, table) != before
    gone = tg.remove_superseded(spark, table)
    assert gone and spark.table(table).count() == 2 and not tg.remove_superseded(spark, table)


def test_recreate_and_loads_into_a_path(spark):
    table = _name("rc")
    src = spark.createDataFrame([(1, None, "a")], ROWS)
    run_load(spark, _spec(table), load_id=1, now=NOW, user="u", source_df=src)
    run_load(spark, _spec(table, recreate=True), load_id=2, now=NOW, user="u", source_df=src.withColumn("k", F.lit(2).cast("long")))
    assert [r.k for r in spark.table(table).collect()] == [2]
    out = fresh_path(spark, "out")
    res = run_load(spark, _spec(_name("none"), target=TableRef(path=out)), load_id=3, now=NOW, user="u", source_df=src, output_path=out)
    assert res.insert_cnt == 1 and spark.read.parquet(out).count() == 1


def test_scheduled_streams_go_on_where_the_last_stopped(spark):
    folder, table, hist = fresh_path(spark, "ss"), _name("ss"), _name("ssh")
    spec = _spec(table).with_(name=_name("SS"))
    for n in range(3):
        spark.createDataFrame([(n, None, f"v{n}")], ROWS).write.mode("append").parquet(folder)
        q = start_incremental_load(spark, spec, spark.readStream.schema(ROWS).parquet(folder), target_table=table,
                                   history_table=hist, user="u", clock=lambda: NOW)
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(r.v for r in spark.table(table).collect()) == ["v0", "v1", "v2"]
    done = spark.table(hist).where("status = 'FINISHED'").collect()
    assert len(done) == 3 and len({r.batch for r in done}) == 3 and sum(r.insert_cnt for r in done) == 3


def test_broadcast_follows_the_measured_bytes(spark):
    texts = fx.read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    staged = stage_extract(texts)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    assert staged.bytes == size + staged.rows * 8 * 3
    limit = staged.bytes - 1
    for plan in ("auto", "broadcast"):
        choice = plan_merge(spark, staged.df, plan, staged_rows=staged.rows, staged_bytes=staged.bytes, broadcast_max_bytes=limit)
        assert choice.name == "full_outer"
    assert plan_merge(spark, staged.df, staged_rows=staged.rows, staged_bytes=staged.bytes, broadcast_max_bytes=limit + 1).name == "broadcast"


def test_anti_join_splits_a_hot_key(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x" * 40).alias("v"))
    keys = spark.range(0, 60_000, 2).withColumnRenamed("id", "k").union(spark.range(1).select(F.lit(1).cast("long")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = missing_in_source(rows.repartition(16), keys.repartition(16), ["k"])
        n = out.count()
        out.collect()
        assert n == rows.join(keys, "k", "left_anti").count() and "skew=true" in explain_text(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_utc_needs_a_zone(spark):
    cfg = {"SOURCE_TABLE": "s", "TARGET_TABLE": "t", "SOURCE_TABLE_PRIMARY_KEY": ["k"],
           "SOURCE_TABLE_SEARCH_COLUMN": {"column_name": "d", "is_utc": True}}
    period = lambda **more: resolve_load_period(JobSpec.from_config({**cfg, **more}), D(2024, 7, 1), D(2024, 7, 2), now=NOW)
    with pytest.raises(SpecError):
        period()
    assert period(LOAD_TIME_ZONE="America/New_York").eff_start == D(2024, 7, 1, 4)
    assert period(UTC_SHIFT_HOURS=5).eff_end == D(2024, 7, 2, 5)
    assert JobSpec.from_config({**cfg, "DEFAULT_PERIOD_START": "2020-01-01"}).default_start == D(2020, 1, 1)


def test_partition_scope_needs_the_key(spark):
    schema = spark.createDataFrame([], ROWS).schema
    with pytest.raises(SpecError):
        validate_spec(_spec("t", partition_column="d", partition_scoped=True), schema)
    validate_spec(_spec("t", partition_column="d", partition_scoped=True, keys=("k", "d")), schema)
    with pytest.raises(SpecError):
        validate_spec(_spec("t", partition_column="d", partition_granularity="hour"), schema)


def test_replacing_a_table_of_other_columns(spark):
    table = _name("rp")
    tg.publish_snapshot(spark, table, spark.createDataFrame([(1, "a")], "k long, v string"))
    tg.publish_snapshot(spark, table, spark.createDataFrame([(1, "a", 2)], "k long, v string, w int"))
    assert spark.table(table).columns == ["k", "v", "w"]
    spark.sql(f"alter table {table} rename to {table}__next")  # cut short between the drop and the rename
    assert tg.create_target(spark, _spec(table), spark.createDataFrame([], ROWS).schema, table).count() == 1


def test_scratch_folder_needs_a_name_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = lambda self: None
        getConf = lambda self: Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        S.shared_dir(Session())


def test_extra_columns_in_a_shuffled_load(spark):
    table = _name("xs")
    spec = _spec(table, extra_columns=(ExtraColumn("u", "string", "upper(source.v)"),))
    src = spark.createDataFrame([(1, None, "a"), (2, None, "b")], ROWS)
    for n, limit in enumerate((1, 1, None)):
        run_load(spark, spec, load_id=n, now=NOW, user="u", source_df=src.withColumn("v", F.concat("v", F.lit(str(n)))),
                 broadcast_max_bytes=limit)
    assert sorted((r.k, r.u) for r in spark.table(table).collect()) == [(1, "A2"), (2, "B2")]
