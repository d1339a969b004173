"""Reading a source and staging an extract (A1, A2)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import fresh_path, shared_dir
from tidemark.spec import TableRef


def read_source(spark: SparkSession, ref: TableRef) -> DataFrame:
    """A1: a catalog table, a path in any file format, or a JDBC table.

    For JDBC give ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` in ``ref.options`` so the read runs in parallel; the
    window filter applied afterwards is pushed into the remote query.
    """
    if ref.format == "jdbc":
        return spark.read.format("jdbc").options(**dict(ref.options)).load()
    if ref.name:
        return spark.table(ref.name)
    if ref.path:
        return spark.read.format(ref.format).options(**dict(ref.options)).load(ref.path)
    raise ValueError(f"table reference has neither name nor path: {ref}")


def jdbc_source(url: str, table: str, *, partition_column: str | None = None, lower=None, upper=None,
                num_partitions: int | None = None, fetch_size: int = 10_000, **props: str) -> TableRef:
    """A1 for a remote table: a parallel JDBC read.

    With ``partition_column`` (an indexed numeric/date column, e.g. the search
    column with the window bounds as ``lower``/``upper``) Spark issues
    ``num_partitions`` range queries at once instead of one.  Filters applied
    to the frame afterwards (the window, B8) are pushed into those queries.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **props}
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return TableRef(format="jdbc", options=opts)


@dataclass(frozen=True)
class Staged:
    """A materialised extract: its frame, rows, bytes (as held in memory, measured) and folder."""
    df: DataFrame
    rows: int
    bytes: int | None
    path: str | None


def stage_extract(df: DataFrame, how: str = "table") -> Staged:
    """A2: materialise the extract once so the merge and the counts see the same rows.

    ``table`` writes parquet to the shared checkpoint folder and reads it back
    (survives executor loss; Spark knows its size for join planning), and
    counts rows and the bytes of strings in the write's own pass;
    ``checkpoint`` uses ``DataFrame.checkpoint``.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        shared_dir(spark)
        kept = df.checkpoint(eager=True)
        return Staged(kept, kept.count(), None, None)
    if how == "none":
        return Staged(df, df.count(), None, None)
    if how != "table":
        raise ValueError(f"unknown staging {how!r}")
    path = fresh_path(spark, "staged")
    obs = Observation(f"staged-rows-{uuid.uuid4().hex[:12]}")  # unique: jobs may run concurrently
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`")).cast("long")), F.lit(0)) for c in wide]
    total = reduce(lambda a, b: a + b, lengths, F.lit(0).cast("long"))
    df.observe(obs, F.count(F.lit(1)).alias("n"), total.alias("b")).write.mode("errorifexists").parquet(path)
    rows = int(obs.get["n"])
    nested = sum(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema.fields)
    # Nested columns aren't measured: None then, and the plan choice estimates.
    size = None if nested else rows * 8 * (len(df.columns) + 1) + int(obs.get["b"])
    return Staged(spark.read.parquet(path), rows, size, path)


def stage(df: DataFrame, how: str = "table") -> tuple[DataFrame, int]:
    """A2: the materialised extract and its row count."""
    staged = stage_extract(df, how)
    return staged.df, staged.rows
