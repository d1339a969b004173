"""Source against target, both directions.

Each side is windowed on its own search column (the target's may carry the
``S_`` prefix) and keys compare with plain ``=``.  The anti joins leave the
probe side's keys as they are (repeats cannot fan out), so both inputs are
plain exchanges and adaptive execution can split a hot key.

``reconcile`` computes both counts in one job without any anti join: each
side is reduced to (key, rows, min date) by a partial aggregate, the two
reductions are joined full outer on the key (one row per key per side, so no
key can fan out), and one aggregate reads the unmatched rows.

``reconcile_by_partition`` gives the same row for tables that agree almost
everywhere: digests of the keys tell the partitions apart that differ, and only
their keys are shuffled and joined.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.period import Period
from tidemark.operators.filters import period_filter
from tidemark.operators.shape import target_name
from tidemark.spec import resolve_name


def _names(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [resolve_name(df.schema, c) for c in cols]


def _sides(source: DataFrame, target: DataFrame, keys: Sequence[str], search_column: str | None,
           period: Period | None):
    skeys = _names(source, keys)
    tkeys = _names(target, [target_name(k) for k in keys])
    s_search = resolve_name(source.schema, search_column) if search_column else None
    t_search = resolve_name(target.schema, target_name(search_column)) if search_column else None
    if period is not None and search_column:
        source = period_filter(source, s_search, period)
        target = period_filter(target, t_search, period)
    return source, target, skeys, tkeys, s_search, t_search


def _key(df: DataFrame, name: str, collation: str | None):
    """A key column, under ``collation`` when it is a string."""
    col = F.col(name)
    if collation and isinstance(df.schema[name].dataType, StringType):
        return F.collate(col, collation)
    return col


def _anti(left: DataFrame, lkeys: list[str], right: DataFrame, rkeys: list[str],
          collation: str | None = None) -> DataFrame:
    probe = right.select(*[_key(right, r, collation).alias(f"__k{i}") for i, r in enumerate(rkeys)])
    cond = [_key(left, lk, collation) == probe[f"__k{i}"] for i, lk in enumerate(lkeys)]
    return left.join(probe, cond, "left_anti")


def missing_in_source(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      search_column: str | None = None, period: Period | None = None,
                      collation: str | None = None) -> DataFrame:
    """D3: target rows (in the window) with no source row (in the window)."""
    source, target, skeys, tkeys, _, t_search = _sides(source, target, keys, search_column, period)
    out = tkeys + ([t_search] if t_search and t_search not in tkeys else [])
    return _anti(target, tkeys, source, skeys, collation).select(*out)


def missing_in_target(source: DataFrame, target: DataFrame, keys: Sequence[str],
                      search_column: str | None = None, period: Period | None = None,
                      collation: str | None = None) -> DataFrame:
    """Source rows (in the window) with no target row (in the window)."""
    source, target, skeys, tkeys, s_search, _ = _sides(source, target, keys, search_column, period)
    out = skeys + ([s_search] if s_search and s_search not in skeys else [])
    return _anti(source, skeys, target, tkeys, collation).select(*out)


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str],
              search_column: str | None = None, period: Period | None = None,
              collation: str | None = None) -> DataFrame:
    """One row -- src_miss, trg_miss, min_miss_dttm (NULL without a search column)."""
    source, target, skeys, tkeys, s_search, _ = _sides(source, target, keys, search_column, period)
    kcols = [f"__k{i}" for i in range(len(skeys))]
    min_expr = F.min(F.col(s_search).cast("timestamp_ntz")) if s_search else F.lit(None).cast("timestamp_ntz")
    s = (source.groupBy(*[_key(source, c, collation).alias(k) for c, k in zip(skeys, kcols)])
               .agg(F.count(F.lit(1)).alias("__sn"), min_expr.alias("__smin")))
    t = (target.groupBy(*[_key(target, c, collation).alias(k) for c, k in zip(tkeys, kcols)])
               .agg(F.count(F.lit(1)).alias("__tn")))
    cond = [s[k] == t[k] for k in kcols]
    j = s.join(t, cond, "full_outer")
    unmatched_t = s["__sn"].isNull()
    unmatched_s = t["__tn"].isNull()
    return j.agg(
        F.coalesce(F.sum(F.when(unmatched_t, t["__tn"])), F.lit(0)).cast("long").alias("src_miss"),
        F.coalesce(F.sum(F.when(unmatched_s, s["__sn"])), F.lit(0)).cast("long").alias("trg_miss"),
        F.min(F.when(unmatched_s, s["__smin"])).alias("min_miss_dttm"),
    )


def key_digests(df: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """(part, n, nulls, total, odd): a digest of the keys of each partition that no order of rows changes.

    Row count, rows with a NULL in the key, sum and exclusive or of two 64-bit
    hashes of the key.  Digests of pieces add up, so each task sends one row a
    partition.
    """
    cols = [F.col(k) for k in keys]
    null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return df.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(null).alias("nulls"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("odd"), *cols)).alias("odd"))


def differing_partitions(source: DataFrame, skeys: Sequence[str], spart: Column, target: DataFrame, tkeys: Sequence[str],
                         tpart: Column) -> list:
    """The partitions whose keys differ between the sides, or hold a NULL (which matches nothing): one value each, so few."""
    s, t = key_digests(source, skeys, spart).alias("s"), key_digests(target, tkeys, tpart).alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("n", "total", "odd")])
    clean = (F.col("s.nulls") == 0) & (F.col("t.nulls") == 0)
    found = s.join(t, F.col("s.part").eqNullSafe(F.col("t.part")), "full_outer").where(~F.coalesce(same & clean, F.lit(False)))
    # A side without the partition has no n: its value is the other side's.
    return [r[0] for r in found.select(F.when(F.col("s.n").isNotNull(), F.col("s.part")).otherwise(F.col("t.part"))).collect()]


#: Keys without a counterpart that are sent to the other partitions' tasks; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def reconcile_by_partition(source: DataFrame, target: DataFrame, keys: Sequence[str], search_column: str,
                           period: Period | None = None, collation: str | None = None, *, granularity: str = "month",
                           keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """E4 with digests: as ``reconcile``, for sides partitioned alike on the search column's truncated value.

    Partitions of equal digests hold the same keys (but for a hash collision:
    128 bits), so nothing in them is missing.  The keys of the others are
    compared; one without a counterpart may still have it in another partition,
    and is looked up there, unless the search column is part of the key.
    ``keep`` materialises the keys without a counterpart, which are read twice.
    """
    source, target, skeys, tkeys, s_search, t_search = _sides(source, target, keys, search_column, period)
    spart, tpart = (F.date_trunc(granularity, F.col(c).cast("timestamp_ntz")) for c in (s_search, t_search))
    differ = differing_partitions(source, skeys, spart, target, tkeys, tpart)

    def within(part: Column) -> Column:
        inside = part.isin([v for v in differ if v is not None])
        return F.coalesce(inside, F.lit(None in differ))

    kcols = [f"__k{i}" for i in range(len(skeys))]
    reduced = lambda df, cols, *aggs: df.groupBy(
        *[_key(df, c, collation).alias(k) for c, k in zip(cols, kcols)]).agg(*aggs)
    s = reduced(source.where(within(spart)), skeys, F.count(F.lit(1)).alias("__sn"),
                F.min(F.col(s_search).cast("timestamp_ntz")).alias("__smin")).alias("s")
    t = reduced(target.where(within(tpart)), tkeys, F.count(F.lit(1)).alias("__tn")).alias("t")
    alone = s.join(t, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in kcols], "full_outer").where("__sn is null or __tn is null")
    alone = alone.select(*[F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in kcols], "__sn", "__smin", "__tn")
    if search_column.lower() not in {k.lower() for k in keys}:
        alone = keep(alone)
        n = alone.count()
        parts = []
        for side, df, cols, part in (("__sn", target, tkeys, tpart), ("__tn", source, skeys, spart)):
            mine = alone.where(f"{side} is not null")
            if n:
                other = df.where(~within(part)).select(*[_key(df, c, collation).alias(k) for c, k in zip(cols, kcols)])
                few = mine.select(*kcols).hint("broadcast") if n <= BROADCAST_KEYS else mine.select(*kcols)
                found = other.join(few, kcols, "left_semi").distinct()
                mine = mine.join(found.hint("broadcast") if n <= BROADCAST_KEYS else found, kcols, "left_anti")
            parts.append(mine)
        alone = parts[0].unionByName(parts[1])
    return alone.agg(F.coalesce(F.sum("__tn"), F.lit(0)).cast("long").alias("src_miss"),
                     F.coalesce(F.sum("__sn"), F.lit(0)).cast("long").alias("trg_miss"), F.min("__smin").alias("min_miss_dttm"))
