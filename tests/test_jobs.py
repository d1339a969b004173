import datetime as dt
import uuid

import pytest

from tidemark import fixtures as fx
from tidemark.plans.jobs import DuplicateKeyError, readiness_report, run_batch, run_check, run_load
from tidemark.session import fresh_path
from tidemark.spec import JobSpec, SearchColumn, SpecError, TableRef, validate_spec
from conftest import SF_SMALL

D = dt.datetime


def _table(spark, df, label):
    name = f"tm_{label}_{uuid.uuid4().hex[:8]}"
    df.write.format("parquet").option("path", fresh_path(spark, label)).saveAsTable(name)
    return name


def test_load_then_check_has_no_target_misses(spark):
    src = fx.source_s(spark, SF_SMALL)
    table = _table(spark, fx.target_t(spark, SF_SMALL, housekeeping=True), "orders_t")
    spec = fx.orders_spec(target=TableRef(name=table))
    res = run_load(spark, spec, None, None, load_id=1, now=D(2030, 1, 1), source_df=src)
    assert res.error is None and res.staged_cnt == src.count()
    chk = run_check(spark, spec, None, None, load_id=2, now=D(2030, 1, 1), source_df=src,
                    target_df=spark.table(table))
    assert chk.trg_miss == 0 and chk.message == ""
    # a second identical load changes nothing
    again = run_load(spark, spec, None, None, load_id=3, now=D(2030, 1, 2), source_df=src)
    assert (again.insert_cnt, again.update_cnt) == (0, 0)


def test_check_message_when_target_misses(spark):
    chk = run_check(spark, fx.orders_spec(), fx.W_START, fx.W_END, load_id=2, now=D(2030, 1, 1),
                    source_df=fx.source_s(spark, SF_SMALL), target_df=fx.target_t(spark, SF_SMALL))
    assert chk.trg_miss > 0
    assert chk.message.startswith("CHECK_MERGE_ORDERS : MIN DTTM MISSING FROM TARGET : ")
    assert chk.message.endswith("in SEARCH date range 1996-01-01 00:00:00.000000 and 1996-12-31 05:00:00.000000")


def test_duplicate_staged_key_fails_before_merge_and_history_records_it(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 1))], "k long, ts timestamp_ntz")
    spec = JobSpec("DUP", TableRef(name="x"), TableRef(name="y"), ("k",), SearchColumn("ts"))
    tgt = spark.createDataFrame([], "k long, ts timestamp_ntz")
    with pytest.raises(DuplicateKeyError):
        run_load(spark, spec, D(2024, 1, 1), D(2024, 1, 2), load_id=5, source_df=src, target_df=tgt)
    res = run_load(spark, spec, D(2024, 1, 1), D(2024, 1, 2), load_id=5, source_df=src, target_df=tgt,
                   raise_errors=False)
    hist = {r.status: r for r in res.history.collect()}
    assert set(hist) == {"START", "FINISHED"} and "DuplicateKeyError" in hist["FINISHED"].error


def test_batch_isolates_failing_spec(spark):
    src = fx.read_table(spark, SF_SMALL, "customer")
    good = fx.customer_spec(target=TableRef(name=f"tm_c_{uuid.uuid4().hex[:8]}"))
    bad = fx.customer_spec(name="BAD", search_column=SearchColumn("nope"))
    good2 = fx.customer_spec(name="GOOD2", target=TableRef(name=f"tm_c_{uuid.uuid4().hex[:8]}"))
    out = run_batch(spark, [good, bad, good2],
                    lambda s: run_load(spark, s, load_id=1, now=D(2030, 1, 1), source_df=src), max_workers=2)
    got = {r.job: r.status for r in out.collect()}
    assert got == {"MERGE_CUSTOMER": "FINISHED", "BAD": "ERROR", "GOOD2": "FINISHED"}


def test_spec_checks(spark):
    schema = fx.source_s(spark, SF_SMALL).schema
    validate_spec(fx.orders_spec(check_columns=("O_ORDERSTATUS",)), schema)  # case-insensitive
    with pytest.raises(SpecError):
        validate_spec(fx.orders_spec(keys=()), schema)
    with pytest.raises(SpecError):
        validate_spec(fx.orders_spec(check_columns=("nope",)), schema)


def test_from_config_reads_job_file_keys():
    cfg = {"SOURCE_SERVER": "localhost", "SOURCE_DATABASE": "DB", "SOURCE_SCHEMA": "SC", "SOURCE_TABLE": "T1",
           "SOURCE_TABLE_SEARCH_COLUMN": {"column_name": "UPDATE_DTTM", "is_utc": True},
           "SOURCE_TABLE_SEARCH_CONDITION": "and ID is NOT null", "SOURCE_TABLE_PRIMARY_KEY": ["ID"],
           "SOURCE_EXCLUDED_COLUMNS": [], "TARGET_DATABASE": "DB", "TARGET_SCHEMA": "SC", "TARGET_TABLE": "T1",
           "TARGET_TABLE_EXTRA_KEY_COLUMNS": [], "TARGET_TABLE_EXTRA_COLUMNS": [
               {"column_name": "X", "data_type": "string", "value": "upper(source.NAME)"}],
           "DATA_PARTITION_COLUMN": "", "UPDATE_MATCH_CHECK_COLUMNS": ["UPDATE_DTTM"], "SET_DAY_START": False,
           "STORED_PROCEDURE_NAME": "MERGE_T1"}
    spec = JobSpec.from_config(cfg)
    assert spec.source.name == "DB.SC.T1" and spec.keys == ("ID",) and spec.is_utc
    assert spec.extra_columns[0].value == "upper(source.NAME)" and spec.partition_column is None
    with pytest.raises(SpecError):
        JobSpec.from_config({**cfg, "SOURCE_TABLE_PRIMARY_KEY": ""})


def test_readiness_report_rows(spark):
    specs = [fx.orders_spec(), fx.customer_spec(target=TableRef(name="tm_absent_x"))]
    rep = readiness_report(spark, specs, {"MERGE_ORDERS": fx.source_s(spark, SF_SMALL),
                                          "MERGE_CUSTOMER": fx.read_table(spark, SF_SMALL, "customer")},
                           {"MERGE_ORDERS": fx.target_t(spark, SF_SMALL)})
    got = {r.job: r for r in rep.collect()}
    assert got["MERGE_ORDERS"].search_column_exists and got["MERGE_ORDERS"].target_exists
    assert got["MERGE_CUSTOMER"].min_value is None and not got["MERGE_CUSTOMER"].target_exists


def test_jdbc_source_options():
    from tidemark.sources.readers import jdbc_source
    ref = jdbc_source("jdbc:sqlserver://db", "sales.T1", partition_column="UPDATE_DTTM",
                      lower="2024-01-01 00:00:00", upper="2024-01-02 00:00:00", num_partitions=16)
    assert ref.format == "jdbc" and ref.options["numPartitions"] == "16"
    assert ref.options["partitionColumn"] == "UPDATE_DTTM" and ref.options["dbtable"] == "sales.T1"
    with pytest.raises(ValueError):
        jdbc_source("jdbc:x", "t", partition_column="c")


def test_check_without_search_column(spark):
    spec = fx.orders_spec(search_column=None)
    chk = run_check(spark, spec, None, None, load_id=2, now=D(2030, 1, 1),
                    source_df=fx.source_s(spark, SF_SMALL), target_df=fx.target_t(spark, SF_SMALL))
    assert chk.trg_miss > 0 and chk.src_miss > 0
    assert chk.min_miss_dttm is None and chk.message is None


def test_ids_continue_from_history(spark):
    hist = f"tm_h_{uuid.uuid4().hex[:8]}"
    table = _table(spark, fx.target_t(spark, SF_SMALL, housekeeping=True), "ids_t")
    spec = fx.orders_spec(target=TableRef(name=table))
    src = fx.source_s(spark, SF_SMALL)
    base = spark.table(table).agg({"id": "max"}).first()[0]
    r1 = run_load(spark, spec, fx.W_START, fx.W_END, load_id=1, now=D(2030, 1, 1), source_df=src,
                  history_table=hist)
    fin = spark.table(hist).where("status = 'FINISHED'").first()
    assert fin.max_id == base + r1.insert_cnt
    r2 = run_load(spark, spec, D(1997, 1, 1), D(1997, 12, 31), load_id=2, now=D(2030, 1, 2), source_df=src,
                  history_table=hist)
    ids = spark.table(table).where("MSTR_LOAD_ID = 2 and INSERT_DTTM = timestamp'2030-01-02'")
    got = ids.agg({"id": "min"}).first()[0], ids.agg({"id": "max"}).first()[0]
    assert r2.insert_cnt > 0 and got == (fin.max_id + 1, fin.max_id + r2.insert_cnt)


def test_history_appends_into_an_older_table(spark):
    from tidemark.sources.history import HISTORY_SCHEMA, HistoryRecord, append_history
    name = f"tm_oldh_{uuid.uuid4().hex[:8]}"
    old = [f for f in HISTORY_SCHEMA.fields if f.name != "max_id"]
    from pyspark.sql.types import StructType
    spark.createDataFrame([], StructType(old)).write.format("parquet") \
        .option("path", fresh_path(spark, "oldh")).saveAsTable(name)
    append_history(spark, [HistoryRecord(1, "START", D(2030, 1, 1), "J", "s", "t", max_id=5)], table=name)
    append_history(spark, [HistoryRecord(1, "FINISHED", D(2030, 1, 1), "J", "s", "t")], table=name)
    assert sorted(r.status for r in spark.table(name).collect()) == ["FINISHED", "START"]


def test_load_to_an_output_path_and_checkpoint_staging(spark):
    from tidemark.sources.readers import stage
    src = fx.source_s(spark, SF_SMALL)
    staged, n = stage(src.where("o_orderkey < 100"), "checkpoint")
    assert n == src.where("o_orderkey < 100").count() == staged.count()
    out = fresh_path(spark, "out")
    res = run_load(spark, fx.orders_spec(partition_column="o_orderdate"), fx.W_START, fx.W_END, load_id=4,
                   now=D(2030, 1, 1), source_df=src, target_df=fx.target_t(spark, SF_SMALL), output_path=out)
    back = spark.read.parquet(out)
    assert res.snapshot == out and "o_orderdate_month" in back.columns and "_action" not in back.columns
    assert back.where("mstr_load_id = 4").count() == res.insert_cnt + res.update_cnt > 0


def test_check_ignores_residual_unless_asked(spark):
    src = fx.source_s(spark, SF_SMALL)
    table = _table(spark, fx.target_t(spark, SF_SMALL, housekeeping=True), "resid_t")
    spec = fx.orders_spec(target=TableRef(name=table), search_condition="and o_orderstatus is not null")
    run_load(spark, spec, fx.W_START, fx.W_END, load_id=1, now=D(2030, 1, 1), source_df=src)
    default = run_check(spark, spec, fx.W_START, fx.W_END, load_id=2, now=D(2030, 1, 1), source_df=src,
                        target_df=spark.table(table))
    applied = run_check(spark, spec, fx.W_START, fx.W_END, load_id=3, now=D(2030, 1, 1), source_df=src,
                        target_df=spark.table(table), apply_residual=True)
    assert default.trg_miss > 0 and applied.trg_miss == 0
