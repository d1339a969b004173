"""Upsert of a staged extract into a target.

The result is the whole new target: every target row once (kept, updated or
unchanged) plus one row per inserted staged row, with an ``_action`` column.
Nothing is deleted.  Keys compare with plain ``=``: a NULL key never matches,
so it inserts and the NULL-keyed target row stays.

Plans (chosen by ``plan_merge`` from a checked size of the staged side):

* ``broadcast`` -- the delta is small: ``target LEFT JOIN broadcast(staged)``
  gives kept/updated rows; ``target LEFT SEMI broadcast(staged keys)`` gives
  the matched keys (bounded by the staged row count), and
  ``staged LEFT ANTI broadcast(matched keys)`` the inserts.  The target is
  scanned but never shuffled.
* ``full_outer`` -- the delta is large: one shuffled full outer join.  Rows
  with a NULL key can never match, so they bypass the join (kept or
  inserted as they are) and cannot pile up in one task, which AQE would not
  split for a full outer join.
* ``split`` -- the delta is large and the target has an ``ID``: as broadcast,
  but with shuffled joins and inserts as ``staged LEFT ANTI target keys``;
  NULL keys bypass the joins the same way.

Where the target is many times the delta, the shuffled plans first test its
keys against a Bloom filter of the staged ones and their least and greatest
value: target rows that cannot match are kept as they are, and only the others
are exchanged.  The least and greatest value reach the scan, so a target
clustered by key (``cluster_keys``) is not even read outside them for the join.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType, StructType

from tidemark.constants import ACTION_COL, ACTIVE, INSERT, TARGET_ONLY, UNCHANGED, UPDATE
from tidemark.functions.period import ntz
from tidemark.functions.predicates import changed, keys_equal
from tidemark.operators.bloom import bloom_filter, hashable, n_words, split_by_bloom
from tidemark.operators.shape import extra_column_exprs, target_name
from tidemark.operators.surrogate import assign_ids, assign_ids_by_place, max_id, with_places
from tidemark.plans.strategy import plan_merge, prefilter_pays
from tidemark.spec import ExtraColumn, SpecError, resolve_name


@dataclass(frozen=True)
class Stamp:
    """Run values written into housekeeping columns (arguments, so runs repeat)."""

    load_id: int
    run_ts: dt.datetime
    user: str


def _align(staged: DataFrame, target_schema: StructType) -> DataFrame:
    """Rename staged columns to the target's spelling; every one must exist there."""
    mapping = {}
    for c in staged.columns:
        try:
            t = resolve_name(target_schema, c)
        except SpecError:
            raise SpecError(f"staged column {c!r} is not a column of the target") from None
        if t != c:
            mapping[c] = t
    return staged.withColumnsRenamed(mapping) if mapping else staged


def _projection(target_schema: StructType, staged_cols: Sequence[str], extras: dict[str, Column],
                action: Column, s: Callable[[str], Column], t: Callable[[str], Column],
                stamp: Stamp | None, new_id: Column | None) -> list[Column]:
    """B5 and the SET/INSERT lists: one expression per target column."""
    is_new = action.isin(INSERT, UPDATE)
    is_ins = action == INSERT
    staged_set = set(staged_cols)
    extra_lower = {k.lower(): v for k, v in extras.items()}
    out = []
    for f in target_schema.fields:
        name, up = f.name, f.name.upper()
        if stamp is not None and up == "ID":
            v = F.when(is_ins, new_id).otherwise(t(name))
        elif stamp is not None and up == "INSERT_DTTM":
            v = F.when(is_ins, ntz(stamp.run_ts)).otherwise(t(name))
        elif stamp is not None and up == "UPDATE_DTTM":
            v = F.when(is_new, ntz(stamp.run_ts)).otherwise(t(name))
        elif stamp is not None and up == "LST_MOD_USER":
            v = F.when(is_ins, F.lit(stamp.user)).otherwise(t(name))
        elif stamp is not None and up == "MSTR_LOAD_ID":
            v = F.when(is_new, F.lit(stamp.load_id)).otherwise(t(name))
        elif stamp is not None and up == "ACTIVE_FLAG":
            v = F.when(is_ins, F.lit(ACTIVE)).otherwise(t(name))
        elif name in staged_set:
            v = F.when(is_new, s(name)).otherwise(t(name))
        elif name.lower() in extra_lower:
            v = F.when(is_new, extra_lower[name.lower()]).otherwise(t(name))
        else:
            v = t(name)  # a target-only column: kept, NULL on insert
        out.append(v.cast(f.dataType).alias(name))
    out.append(action.alias(ACTION_COL))
    return out


def merge_upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                 check_columns: Sequence[str] = (), extra_columns: Sequence[ExtraColumn] = (), *,
                 stamp: Stamp | None = None, plan: str = "auto", staged_rows: int | None = None,
                 broadcast_max_bytes: int | None = None, id_base: int | None = None, collation: str | None = None,
                 matched: DataFrame | None = None, keep_inserts: Callable[[DataFrame], DataFrame] | None = None,
                 prefilter: bool | None = None) -> DataFrame:
    """D1 (check columns given) / D2 (none: every match updates).

    Staged keys must be unique (``run_load`` checks them with E5 first): a
    repeated key would match one target row twice.  ``id_base``: the largest id already used (default: ``max(ID)`` of ``target``;
    pass it when ``target`` is only a slice of the table).  ``collation``:
    string keys and check columns compare under it (e.g. ``UNICODE_CI``).
    ``matched``: the target's keys that staged rows match, if the caller has
    them already.  ``keep_inserts`` materialises the insert set, which the ids
    read twice.  ``prefilter``: whether a shuffled plan tests the target's keys
    against a Bloom filter first (default: if its size is within the broadcast
    limit and the target is large enough; keys whose equality is not that of
    their bytes are never tested).
    """
    if not keys:
        raise SpecError("merge needs at least one key column")
    staged = _align(staged, target.schema)
    tkeys = [resolve_name(target.schema, target_name(k)) for k in keys]
    checks = [resolve_name(target.schema, target_name(c)) for c in check_columns]
    for c in tkeys + checks:
        if c not in staged.columns:
            raise SpecError(f"column {c!r} is not in the staged extract")
    extras = extra_column_exprs(extra_columns)
    for name in extras:
        resolve_name(target.schema, name)
    has_id = stamp is not None and any(f.name.upper() == "ID" for f in target.schema.fields)
    spark = target.sparkSession
    choice = plan_merge(spark, staged, plan, staged_rows=staged_rows, needs_ids=has_id,
                        broadcast_max_bytes=broadcast_max_bytes)

    tschema = target.schema
    tcols = {f.name: f.dataType for f in tschema.fields}
    scols = list(staged.columns)
    strings = {f.name for f in tschema.fields if isinstance(f.dataType, StringType)}
    upd = changed(checks, collation=collation, strings=strings)
    on = keys_equal(tkeys, collation=collation, strings=strings)

    s = staged.withColumn("__sp", F.lit(True))
    src = lambda c: F.col(f"source.{c}")
    tgt = lambda c: F.col(f"target.{c}")
    no_src = lambda c: F.lit(None).cast(tcols[c])

    if choice.name == "broadcast":
        # The target is scanned, never shuffled; NULL keys need no care here.
        kept = target.alias("target").join(F.broadcast(s).alias("source"), on, "left")
        if matched is None:
            matched = target.select(*tkeys).alias("target").join(
                F.broadcast(staged.select(*tkeys)).alias("source"), on, "left_semi")
        inserts = staged.alias("source").join(F.broadcast(matched.select(*tkeys).distinct()).alias("target"), on, "left_anti")
        parts = [kept.select(*_projection(tschema, scols, extras, _kept_action(upd), src, tgt, stamp, None))]
    else:
        # Shuffled joins see only rows whose keys are all non-NULL.  NULL-keyed
        # rows can never match, so they skip the join: target ones are kept
        # as they are, staged ones are inserts.  A third of all rows with a
        # NULL key therefore never lands in one join task.  (On parquet the
        # IS NULL side skips every row group whose statistics show no NULLs.)
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in tkeys])
        t_keyed, t_null = target.where(keyed), target.where(~keyed)
        s_keyed, s_null = s.where(keyed), staged.where(~keyed)
        if prefilter is not False and hashable(tschema, staged.schema, tkeys, collation):
            rows = choice.staged_rows if choice.staged_rows is not None else staged.count()
            if prefilter or prefilter_pays(spark, target, staged, rows, broadcast_max_bytes):
                t_keyed, t_null = possible_matches(target, staged, tkeys, rows)
        t_only = t_null.alias("target").select(*_projection(  # no source row: the extra columns stay
            tschema, scols, {}, F.lit(TARGET_ONLY), no_src, tgt, stamp, None))
        if choice.name == "full_outer":
            j = t_keyed.withColumn("__tp", F.lit(True)).alias("target").join(s_keyed.alias("source"), on,
                                                                             "full_outer")
            action = (F.when(F.col("target.__tp").isNull(), F.lit(INSERT))
                       .when(F.col("source.__sp").isNull(), F.lit(TARGET_ONLY))
                       .when(upd, F.lit(UPDATE)).otherwise(F.lit(UNCHANGED)))
            ins_null = s_null.alias("source").select(*_projection(
                tschema, scols, extras, F.lit(INSERT), src, no_src, stamp, None))
            return j.select(*_projection(tschema, scols, extras, action, src, tgt, stamp, None)) \
                .unionByName(t_only).unionByName(ins_null)
        # split: as broadcast, with shuffled joins (ids need the insert set alone)
        kept = t_keyed.alias("target").join(s_keyed.alias("source"), on, "left")
        inserts = s_keyed.drop("__sp").alias("source").join(t_keyed.select(*tkeys).alias("target"), on, "left_anti")
        inserts = inserts.unionByName(s_null)
        parts = [kept.select(*_projection(tschema, scols, extras, _kept_action(upd), src, tgt, stamp, None)),
                 t_only]
    new_id = None
    if has_id:
        id_name = resolve_name(tschema, "ID")
        base = id_base if id_base is not None else max_id(target, id_name)
        if keep_inserts is not None:
            inserts = assign_ids_by_place(keep_inserts(with_places(inserts)), base, id_col="__new_id")
        else:
            inserts = assign_ids(inserts, base, tkeys, id_col="__new_id", expected_rows=staged_rows)
        new_id = F.col("source.__new_id")
    ins_out = inserts.alias("source").select(*_projection(
        tschema, scols, extras, F.lit(INSERT), src, no_src, stamp, new_id))
    out = parts[0]
    for p in parts[1:] + [ins_out]:
        out = out.unionByName(p)
    return out


def possible_matches(target: DataFrame, staged: DataFrame, keys: Sequence[str], staged_rows: int) -> tuple[DataFrame, DataFrame]:
    """The target rows whose key may be among the staged ones, and the other rows (NULL keys among them).

    Both parts scan the target; the first only between the least and the
    greatest staged value of each number key, which row-group statistics can skip by.
    """
    words = n_words(staged_rows)
    numbers = [k for k in keys if isinstance(staged.schema[k].dataType, (IntegralType, DecimalType))]
    within = None
    if numbers:
        ends = staged.agg(*[f(k) for k in numbers for f in (F.min, F.max)]).first()
        within = reduce(lambda a, b: a & b, [F.lit(True)] + [
            F.col(k).between(lo, hi) for k, lo, hi in zip(numbers, ends[::2], ends[1::2]) if lo is not None])
    return split_by_bloom(target, keys, bloom_filter(staged, keys, words), words, within)


def _kept_action(upd: Column) -> Column:
    """Action of a target row after a left join with the staged rows."""
    return (F.when(F.col("source.__sp").isNull(), F.lit(TARGET_ONLY))
             .when(upd, F.lit(UPDATE)).otherwise(F.lit(UNCHANGED)))


def change_counts(merged: DataFrame) -> DataFrame:
    """One row of counts by action (deletes are always 0)."""
    a = F.col(ACTION_COL)
    return merged.agg(
        F.count_if(a == INSERT).alias("insert_cnt"),
        F.count_if(a == UPDATE).alias("update_cnt"),
        F.lit(0).cast("long").alias("delete_cnt"),
        F.count_if(a == UNCHANGED).alias("unchanged_cnt"),
        F.count_if(a == TARGET_ONLY).alias("target_only_cnt"),
    )


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action, one row each."""
    return merged.groupBy(F.col(ACTION_COL).alias("action")).agg(F.count(F.lit(1)).alias("n"))
