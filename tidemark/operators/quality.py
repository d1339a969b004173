"""Counts, profiles and key checks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.period import month_span
from tidemark.operators.shape import target_name
from tidemark.spec import JobSpec, resolve_name


def row_count(df: DataFrame) -> DataFrame:
    """``count(*)`` as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def profile_table(df: DataFrame, search_column: str | None = None) -> DataFrame:
    """Count, min, max and calendar-month span of the search column.

    Without a search column the last three are NULL.  One aggregate pass.
    """
    if not search_column:
        return df.agg(F.count(F.lit(1)).alias("row_count"),
                      F.lit(None).cast("timestamp_ntz").alias("min_value"),
                      F.lit(None).cast("timestamp_ntz").alias("max_value"),
                      F.lit(None).cast("int").alias("month_cnt"))
    c = F.col(resolve_name(df.schema, search_column))
    prof = df.agg(F.count(F.lit(1)).alias("row_count"), F.min(c).alias("min_value"), F.max(c).alias("max_value"))
    return prof.withColumn("month_cnt", month_span(F.col("min_value"), F.col("max_value")).cast("int"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], collation: str | None = None) -> DataFrame:
    """E5: keys that occur more than once, with their row counts.

    The count is combined map-side, so a hot key costs one row per task.
    With ``collation``, string keys that are equal under it count as one key.
    """
    cols = [resolve_name(df.schema, k) for k in keys]
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    grp = [F.collate(F.col(c), collation).alias(c) if collation and c in strings else F.col(c) for c in cols]
    return df.groupBy(*grp).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def constraint_keys(spec: JobSpec) -> dict[str, list[str]]:
    """Target key lists, in target names: the primary key and the unique index.

    primary key: source keys + extra key columns + partition column;
    unique index: source keys + partition column + search column (no extra keys).
    """
    def add(lst: list[str], name: str | None) -> None:
        if name and name.lower() not in {x.lower() for x in lst}:
            lst.append(name)

    pk: list[str] = list(spec.keys)
    for c in spec.extra_key_columns:
        add(pk, c)
    add(pk, spec.partition_column)
    ux: list[str] = list(spec.keys)
    add(ux, spec.partition_column)
    add(ux, spec.search_column.name if spec.search_column else None)
    return {"primary_key": [target_name(c) for c in pk], "unique_index": [target_name(c) for c in ux]}


def constraint_violations(df: DataFrame, spec: JobSpec) -> DataFrame:
    """E5 on a target: duplicates under the primary key and under the unique index.

    One row per duplicated key value: ``constraint``, the key columns (NULL
    where a column is not part of that constraint) and ``n``.  String keys
    compare under the spec's collation, as the load compares them.
    """
    frames = []
    for name, cols in constraint_keys(spec).items():
        d = duplicate_keys(df, cols, spec.collation)
        frames.append(d.select(F.lit(name).alias("constraint"), *d.columns))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
