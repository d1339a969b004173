"""Load history: one START and one FINISHED row per run."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = T.StructType([
    T.StructField("load_id", T.IntegerType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("event_dttm", T.TimestampNTZType(), True),
    T.StructField("job", T.StringType(), True),
    T.StructField("source_table", T.StringType(), True),
    T.StructField("target_table", T.StringType(), True),
    T.StructField("period_start", T.StringType(), True),
    T.StructField("period_end", T.StringType(), True),
    T.StructField("eff_start", T.TimestampNTZType(), True),
    T.StructField("eff_end", T.TimestampNTZType(), True),
    T.StructField("staged_cnt", T.LongType(), True),
    T.StructField("insert_cnt", T.LongType(), True),
    T.StructField("update_cnt", T.LongType(), True),
    T.StructField("delete_cnt", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("max_id", T.LongType(), True),
    T.StructField("batch", T.StringType(), True),
])


def format_ts(value: dt.datetime | None) -> str | None:
    """Bounds as stored in history: ``yyyy-MM-dd HH:mm:ss.ffffff`` (before any UTC shift)."""
    return None if value is None else value.strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass
class HistoryRecord:
    load_id: int
    status: str
    event_dttm: dt.datetime | None
    job: str
    source_table: str
    target_table: str
    period_start: str | None = None
    period_end: str | None = None
    eff_start: dt.datetime | None = None
    eff_end: dt.datetime | None = None
    staged_cnt: int | None = 0
    insert_cnt: int | None = 0
    update_cnt: int | None = 0
    delete_cnt: int | None = 0
    error: str | None = None
    message: str | None = ""
    max_id: int | None = None
    batch: str | None = None  # of a stream: its checkpoint and the batch's number


def history_frame(spark: SparkSession, records: list[HistoryRecord]) -> DataFrame:
    rows = [tuple(asdict(r)[f.name] for f in HISTORY_SCHEMA.fields) for r in records]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def append_history(spark: SparkSession, records: list[HistoryRecord], path: str | None = None,
                   table: str | None = None) -> DataFrame:
    """Append records to a history table or path; return them as a frame."""
    df = history_frame(spark, records)
    if table and spark.catalog.tableExists(table):
        # Append by name into the table's own columns (an older table may
        # lack newer ones, e.g. max_id).
        cols = spark.table(table).columns
        lower = {c.lower(): c for c in df.columns}
        df.select(*[F.col(lower[c.lower()]) if c.lower() in lower else F.lit(None).alias(c) for c in cols]) \
          .write.insertInto(table)
    elif table:
        df.write.mode("append").format("parquet").saveAsTable(table)
    elif path:
        df.coalesce(1).write.mode("append").parquet(path)
    return df


def last_max_id(spark: SparkSession, history_table: str | None, target_table: str | None) -> int | None:
    """The largest id that any job's successful load into ``target_table`` recorded (None if unknown)."""
    if not history_table or not target_table or not spark.catalog.tableExists(history_table):
        return None
    h = spark.table(history_table)
    if "max_id" not in h.columns:
        return None
    row = h.where((F.col("target_table") == target_table) & (F.col("status") == "FINISHED") & F.col("error").isNull()) \
           .agg(F.max("max_id").alias("m")).first()
    return None if row is None or row["m"] is None else int(row["m"])
