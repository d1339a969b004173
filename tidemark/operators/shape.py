"""Column shaping of the extract."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import RESERVED_PREFIX, RESERVED_UPPER
from tidemark.spec import ExtraColumn, SpecError, resolve_name


def exclude_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """B1: drop listed columns (case-insensitive; an unknown name is an error)."""
    drop = [resolve_name(df.schema, n) for n in names]
    return df.drop(*drop) if drop else df


def target_name(column: str, prefix: str = RESERVED_PREFIX) -> str:
    """The target's name for a source column: prefixed when it is reserved."""
    return prefix + column if column.upper() in RESERVED_UPPER else column


def rename_reserved(df: DataFrame, prefix: str = RESERVED_PREFIX) -> DataFrame:
    """B2: prefix source columns that collide with housekeeping names."""
    mapping = {c: target_name(c, prefix) for c in df.columns if c.upper() in RESERVED_UPPER}
    return df.withColumnsRenamed(mapping) if mapping else df


def cast_partition_column(df: DataFrame, column: str | None) -> DataFrame:
    """The partition column is always a timestamp (zone-free)."""
    if not column:
        return df
    c = resolve_name(df.schema, column)
    return df.withColumn(c, F.col(c).cast("timestamp_ntz"))


def derived_columns(df: DataFrame, extras: Sequence[ExtraColumn], alias: str = "source") -> DataFrame:
    """Extra target columns, each a Spark SQL expression over ``source.*``."""
    if not extras:
        return df
    src = df.alias(alias)
    taken = {c.lower() for c in df.columns}
    cols = []
    for e in extras:
        name = target_name(e.name)
        if name.lower() in taken:
            raise SpecError(f"extra column {e.name!r} collides with a source column")
        cols.append(F.expr(e.value).cast(e.data_type).alias(name))
    return src.select(*[F.col(f"{alias}.{c}") for c in df.columns], *cols)


def extra_column_exprs(extras: Sequence[ExtraColumn]) -> dict[str, F.Column]:
    """Target name -> typed expression, for use inside the merge projection."""
    return {target_name(e.name): F.expr(e.value).cast(e.data_type) for e in extras}
