"""Growing surrogate ``ID`` for inserted rows (G1).

A load stages its insert set with the place at which each row was written
(``with_places``: task and row in the task).  ``assign_ids_by_place`` counts the
rows of each task, turns the counts into running offsets (one row a task), and
adds them to the places: no row is shuffled or sorted, and rows that are equal
throughout are numbered like any others, however many they are.

``assign_ids`` numbers a frame that is not staged.  Rows are spread over ``n`` hash buckets of their own content.  Each bucket's
size is counted (a partial aggregate: only ``n`` rows reach the next stage),
the ``n`` counts are turned into running offsets (the only unpartitioned
window, over ``n`` rows, broadcast back), and rows are numbered inside their
bucket.  So ids are dense (``base + 1 .. base + rows``), unique, and a re-run
over the same rows gives the same ids.  ``n`` grows with the row count, so no
bucket holds more than ``rows_per_bucket`` rows.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000


def bucket_count(spark, expected_rows: int | None, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if expected_rows is None:
        return floor
    return max(floor, math.ceil(expected_rows / rows_per_bucket))


def assign_ids(df: DataFrame, base: int | Column, order_by: Sequence[str], *, id_col: str = "ID",
               buckets: int | None = None, expected_rows: int | None = None) -> DataFrame:
    """Add ``id_col`` = base + 1 .. base + count(df), in bucket then ``order_by`` order."""
    spark = df.sparkSession
    n = buckets or bucket_count(spark, expected_rows)
    cols = df.columns
    b = df.withColumn("__b", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n)))
    sizes = b.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(
        "__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__off"))
    # Keys first; one content hash breaks ties (only rows with equal keys,
    # i.e. NULL keys, need it), so the sort compares at most one extra long.
    order = [F.col(c).asc_nulls_first() for c in order_by] + [F.col("__h")]
    numbered = (b.withColumn("__h", F.xxhash64(*[F.col(c) for c in cols], F.lit("tiebreak")))
                 .join(F.broadcast(offsets), "__b")
                 .withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy(*order))))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (numbered.withColumn(id_col, (base_col + F.col("__off") + F.col("__rn")).cast("long"))
                    .drop("__b", "__off", "__rn", "__h"))


#: monotonically_increasing_id holds the task above these bits and the row below.
TASK_SHIFT = 33


def with_places(df: DataFrame, at_col: str = "__at") -> DataFrame:
    """``df`` with the place of each row, to be written with it: a task that runs again writes the same places or others, but once."""
    return df.withColumn(at_col, F.monotonically_increasing_id())


def assign_ids_by_place(staged: DataFrame, base: int | Column, *, id_col: str = "ID", at_col: str = "__at") -> DataFrame:
    """Replace ``at_col`` by ``id_col`` = base + 1 .. base + count, in the order of the places."""
    task = F.shiftright(at_col, TASK_SHIFT)
    sizes = staged.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))  # a row a task
    base_col = base if isinstance(base, Column) else F.lit(base)
    row = F.col(at_col) - F.shiftleft(F.shiftright(at_col, TASK_SHIFT), TASK_SHIFT)
    return (staged.withColumn("__task", task).join(F.broadcast(offsets), "__task")
            .withColumn(id_col, (base_col + F.col("__off") + row + 1).cast("long")).drop("__task", "__off", at_col))


def max_id(target: DataFrame, id_col: str = "ID") -> int:
    """Largest id in the target (0 when empty): one scalar aggregate."""
    v = target.agg(F.max(id_col).alias("m")).first()["m"]
    return int(v) if v is not None else 0
