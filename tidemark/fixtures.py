"""Source/target pairs derived from the given tables (see FIXTURES.md).

``S`` is ``orders`` with some statuses NULLed; ``T`` is ``orders`` with rows
missing, changed and NULLed, plus target-only rows.  Both are plain Spark
plans over the parquet files, so their size grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import JobSpec, SearchColumn, TableRef

W_START = dt.datetime(1996, 1, 1)
W_END = dt.datetime(1996, 12, 31)
SEED_TS = dt.datetime(2000, 1, 1)
RUN_TS = dt.datetime(2030, 1, 1)
RUN_LOAD_ID = 7
RUN_USER = "loader"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_s(read_table(spark, sf_dir, "orders"))


def shape_s(o: DataFrame) -> DataFrame:
    """S from an ``orders`` frame (batch or stream)."""
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority")


def target_t(spark: SparkSession, sf_dir: str, housekeeping: bool = False) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = o.where(k % 5 != 0).select(
        "o_orderkey", "o_custkey",
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority", F.lit(-1).cast("int").alias("mstr_load_id"))
    extra = o.where(k % 97 == 0).select(
        (k + 10000000).alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", F.lit(-1).cast("int").alias("mstr_load_id"))
    t = kept.unionByName(extra)
    if housekeeping:
        seed = F.lit(SEED_TS.isoformat(sep=" ")).cast("timestamp_ntz")
        t = t.select(
            (F.col("o_orderkey") + 1).alias("id"), seed.alias("insert_dttm"), seed.alias("update_dttm"),
            F.lit("seed").alias("lst_mod_user"), "mstr_load_id", F.lit(1).cast("smallint").alias("active_flag"),
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return t


def orders_spec(check: bool = True, **changes) -> JobSpec:
    spec = JobSpec(
        name="MERGE_ORDERS",
        source=TableRef(name="orders"),
        target=TableRef(name="orders_t"),
        keys=("o_orderkey",),
        search_column=SearchColumn("o_orderdate"),
        check_columns=("o_orderstatus", "o_totalprice") if check else (),
    )
    return spec.with_(**changes) if changes else spec


def events_spec(**changes) -> JobSpec:
    spec = JobSpec(
        name="MERGE_EVENTS",
        source=TableRef(name="events"),
        target=TableRef(name="events_t"),
        keys=("event_id",),
        search_column=SearchColumn("ts"),
    )
    return spec.with_(**changes) if changes else spec


def customer_spec(**changes) -> JobSpec:
    spec = JobSpec(name="MERGE_CUSTOMER", source=TableRef(name="customer"),
                   target=TableRef(name="customer_t"), keys=("c_custkey",))
    return spec.with_(**changes) if changes else spec
