"""Physical choices that depend on a checked size.

The staged side of a merge is broadcast only when its bytes, measured while it
was staged, fit under ``tidemark.merge.broadcastMaxBytes`` (default 64 MiB);
for an extract that wasn't measured, rows times a width from its schema stand
in.  Beyond that the merge shuffles, also if a broadcast was asked for.  ``spark.sql.autoBroadcastJoinThreshold`` still applies to
Spark's own choices; AQE may re-plan a shuffled join at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.bloom import bloom_bytes

BROADCAST_MAX_BYTES_CONF = "tidemark.merge.broadcastMaxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
VAR_WIDTH_GUESS = 48  # bytes assumed per string/binary value


@dataclass(frozen=True)
class MergePlan:
    name: str            # "broadcast" | "full_outer" | "split"
    reason: str
    staged_rows: int | None = None
    est_bytes: int | None = None


def row_width(schema: T.StructType) -> int:
    """Upper-ish bound of one row's in-memory size (8-byte slot + var data)."""
    width = 8  # null bits / header
    for f in schema.fields:
        dt = f.dataType
        width += 8
        if isinstance(dt, (T.StringType, T.BinaryType)):
            width += VAR_WIDTH_GUESS
        elif isinstance(dt, T.DecimalType) and dt.precision > 18:
            width += 16
        elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            width += 4 * VAR_WIDTH_GUESS
    return width


def broadcast_limit(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return override
    v = spark.conf.get(BROADCAST_MAX_BYTES_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def plan_merge(spark: SparkSession, staged: DataFrame, plan: str = "auto", *, staged_rows: int | None = None,
               needs_ids: bool = False, broadcast_max_bytes: int | None = None, staged_bytes: int | None = None) -> MergePlan:
    if plan not in ("auto", "broadcast", "full_outer", "split"):
        raise ValueError(f"unknown merge plan {plan!r}")
    if plan == "full_outer" and needs_ids:
        plan = "split"  # ids need the insert set on its own
    if plan not in ("auto", "broadcast"):
        return MergePlan(plan, "requested", staged_rows)
    rows = staged_rows if staged_rows is not None else staged.count()
    est = staged_bytes if staged_bytes is not None else rows * row_width(staged.schema)
    limit = broadcast_limit(spark, broadcast_max_bytes)
    if est <= limit:
        return MergePlan("broadcast", f"staged ~{est} B <= {limit} B", rows, est)
    return MergePlan("split" if needs_ids else "full_outer", f"staged ~{est} B > {limit} B", rows, est)


#: A Bloom filter of the staged keys pays where the target has this many times the staged side's bytes:
#: the target is scanned a second time so that the rest of it is not shuffled.
PREFILTER_RATIO = 8


def prefilter_pays(spark: SparkSession, target: DataFrame, staged: DataFrame, staged_rows: int,
                   broadcast_max_bytes: int | None = None) -> bool:
    """Whether the filter is small enough to broadcast and the target large enough for it."""
    if bloom_bytes(staged_rows) > broadcast_limit(spark, broadcast_max_bytes):
        return False
    size = int(str(target._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size >= PREFILTER_RATIO * max(1, staged_rows * row_width(staged.schema))
