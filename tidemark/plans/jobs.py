"""Jobs: load, check, batch, readiness (H1-H4).

Each job is a composition of the operators; every data step is a Spark plan.
The driver only resolves scalars (window bounds, a max id, counts) and
writes the history records.
"""

from __future__ import annotations

import datetime as dt
import sys
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import ACTION_COL, INSERT, MISSING_MESSAGE, NO_EARLIEST_OVERRIDE, UPDATE
from tidemark.functions.period import Period, month_span, resolve_check_period, resolve_load_period
from tidemark.functions.predicates import changed, keys_equal
from tidemark.operators.bloom import hashable
from tidemark.operators.filters import period_filter, residual_filter
from tidemark.operators.merge import Stamp, merge_upsert, possible_matches
from tidemark.operators.quality import duplicate_keys
from tidemark.operators.reconcile import reconcile, reconcile_by_partition
from tidemark.operators.shape import cast_partition_column, exclude_columns, rename_reserved, target_name
from tidemark.operators.surrogate import max_id
from tidemark.plans.strategy import plan_merge, prefilter_pays
from tidemark.sources.history import HistoryRecord, append_history, format_ts, last_max_id
from tidemark.session import drop_path
from tidemark.sources.readers import Staged, read_source, stage_extract
from tidemark.sources.target import (ANY_VERSION, MAX_ID_PROPERTY, deploy_target, partition_column_name, partition_value,
                                     prune_to_window, publish_partitions, publish_snapshot, set_property,
                                     table_properties, table_version, target_schema, write_snapshot)
from tidemark.spec import JobSpec, SpecError, has_column, resolve_name, validate_spec


class DuplicateKeyError(SpecError):
    """The staged extract holds a key more than once (a merge would multiply rows)."""


@dataclass
class LoadResult:
    period: Period
    staged_cnt: int
    insert_cnt: int
    update_cnt: int
    delete_cnt: int
    plan: str
    snapshot: str | None
    history: DataFrame
    error: str | None = None


@dataclass
class CheckResult:
    period: Period
    src_miss: int
    trg_miss: int
    min_miss_dttm: dt.datetime | None
    message: str
    history: DataFrame
    error: str | None = None


def _session_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")


def build_extract(source: DataFrame, spec: JobSpec, period: Period | None, apply_window: bool = True) -> DataFrame:
    """B1 -> B3 -> B6/B7 -> B8 -> B2: the rows and columns a load stages."""
    df = exclude_columns(source, spec.excluded_columns)
    df = cast_partition_column(df, spec.partition_column)
    if apply_window and spec.search_column is not None and period is not None:
        df = period_filter(df, spec.search_column.name, period)
    df = residual_filter(df, spec.search_condition)
    return rename_reserved(df)


def matched_rows(target: DataFrame, staged: DataFrame, spec: JobSpec, extra: Sequence[str] = ()) -> DataFrame:
    """The target's keys (and ``extra`` columns) that staged rows match, and whether the match is a change.

    For a small delta: the staged keys and check columns are broadcast, and the
    target is read in as many columns, unshuffled.  The result has a row for
    each matched target row, so it is about as small as the delta.
    """
    tkeys = [resolve_name(target.schema, target_name(k)) for k in spec.keys]
    checks = [resolve_name(target.schema, target_name(c)) for c in spec.check_columns]
    strings = {f.name for f in target.schema.fields if isinstance(f.dataType, T.StringType)}
    narrow = list(dict.fromkeys(tkeys + checks))
    probe = staged.select(*[F.col(resolve_name(staged.schema, c)).alias(c) for c in narrow])
    return (target.select(*dict.fromkeys(narrow + list(extra))).alias("target")
            .join(F.broadcast(probe).alias("source"), keys_equal(tkeys, collation=spec.collation, strings=strings))
            .select(*[F.col(f"target.{c}") for c in dict.fromkeys(tkeys + list(extra))],
                    changed(checks, collation=spec.collation, strings=strings).alias("__changed")))


def unmatched_rows(target: DataFrame, staged: DataFrame, matched: DataFrame, spec: JobSpec) -> DataFrame:
    """The keys of the staged rows that match none of the ``matched`` target keys (as the collation compares them)."""
    tkeys = [resolve_name(target.schema, target_name(k)) for k in spec.keys]
    strings = {f.name for f in target.schema.fields if isinstance(f.dataType, T.StringType)}
    probe = staged.select(*[F.col(resolve_name(staged.schema, k)).alias(k) for k in tkeys])
    return probe.alias("source").join(F.broadcast(matched.select(*tkeys).distinct()).alias("target"),
                                      keys_equal(tkeys, collation=spec.collation, strings=strings), "left_anti")


def scope_to_partitions(target: DataFrame, staged: DataFrame, spec: JobSpec, source_schema: T.StructType, *,
                        matched_too: bool = True, matched: DataFrame | None = None) -> tuple[DataFrame, list]:
    """The target partitions a load can change, as a partition-pruned slice.

    A partition changes only if a staged row belongs to it (insert, or the
    new home of an updated row) or it holds a target row whose key a staged
    row matches (update; the row may move out).  The second set comes from
    ``matched`` (``matched_rows`` with the partition column, for a small delta)
    or else from a semi join of the target's key and partition columns with
    the staged keys.  ``matched_too=False`` skips it when rows never change
    partition.  The values are one per partition, so few; the slice filters on
    the partition column, so the scan lists and reads only those directories.
    """
    col = target_name(resolve_name(source_schema, spec.partition_column))
    pname = resolve_name(target.schema, partition_column_name(col, spec.partition_granularity))
    parts = staged.select(partition_value(F.col(col), spec.partition_granularity).alias("p"))
    if matched_too and matched is not None:
        parts = parts.unionByName(matched.select(F.col(pname).alias("p")))
    elif matched_too:
        tkeys = [resolve_name(target.schema, target_name(k)) for k in spec.keys]
        strings = {f.name for f in target.schema.fields if isinstance(f.dataType, T.StringType)}
        keyed, probe = target.select(*tkeys, pname), staged.select(*[F.col(k).alias(k) for k in tkeys])
        if hashable(keyed.schema, probe.schema, tkeys, spec.collation):
            rows = probe.count()
            if prefilter_pays(target.sparkSession, keyed, probe, rows):
                keyed, _ = possible_matches(keyed, probe, tkeys, rows)
        hit = (keyed.alias("target")
               .join(probe.alias("source"), keys_equal(tkeys, collation=spec.collation, strings=strings),
                     "left_semi")
               .select(F.col(pname).alias("p")))
        parts = parts.unionByName(hit)
    scope = [r[0] for r in parts.distinct().collect()]
    inside = F.col(pname).isin([v for v in scope if v is not None])
    if None in scope:
        inside = inside | F.col(pname).isNull()
    return target.where(inside), scope


def _failure(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def run_load(spark: SparkSession, spec: JobSpec, start: dt.datetime | None = None,
             end: dt.datetime | None = None, *, load_id: int, now: dt.datetime | None = None,
             user: str | None = None, source_df: DataFrame | None = None, target_df: DataFrame | None = None,
             target_table: str | None = None, output_path: str | None = None,
             history_table: str | None = None, history_path: str | None = None, plan: str = "auto",
             staging: str = "table", apply_window: bool = True,
             broadcast_max_bytes: int | None = None, raise_errors: bool = True, batch: str | None = None) -> LoadResult:
    """H1: C -> A1 -> B -> A2 -> E5 -> D1/D2 -> B5/G1 -> A5 -> E3 -> A6.

    The START row is written before anything is read.  The FINISHED row is
    written on every failure too (with the whole error), then the error is
    raised again unless ``raise_errors`` is false.

    Staged rows with a NULL in their key match nothing and insert, however
    many there are; other keys may occur once.  A load without staged rows, or
    (for a delta small enough to broadcast) without changes, publishes
    nothing.  A target that another load published into meanwhile is refused
    with ``ConcurrentLoadError``.  Everything staged is dropped at the end.
    """
    now = now or dt.datetime.now()
    user = user or spark.sparkContext.sparkUser()
    target_table = target_table or (spec.target.name if target_df is None and output_path is None else None)
    zone = _session_zone(spark)
    period = Period(start, end, None, None)
    base = dict(load_id=load_id, job=spec.name, source_table=spec.source.label,
                target_table=target_table or output_path or spec.target.label, batch=batch)

    def record(status: str, **more) -> DataFrame:
        bounds = dict(period_start=format_ts(period.start), period_end=format_ts(period.end), eff_start=period.eff_start,
                      eff_end=period.eff_end)
        return append_history(spark, [HistoryRecord(status=status, event_dttm=now, **base, **bounds, **more)],
                              path=history_path, table=history_table)

    error, exc, id_base = None, None, None
    scratch: list[str] = []

    def kept(staged: Staged) -> DataFrame:
        """The staged rows, whose folder goes when the load ends."""
        if staged.path:
            scratch.append(staged.path)
        return staged.df

    try:
        if start is not None and end is not None:  # else it takes a look at the source
            period = resolve_load_period(spec, start, end, now=now, session_zone=zone)
    except Exception as e:
        error, exc = _failure(e), e
    hist = record("START")
    spark.sparkContext.setJobDescription(f"load {spec.name} #{load_id}")
    staged_cnt = ins = upd = 0
    chosen, snapshot = "", None
    try:
        if exc is not None:
            raise exc
        source = source_df if source_df is not None else read_source(spark, spec.source)
        validate_spec(spec, source.schema)
        period = resolve_load_period(spec, start, end, now=now, source=source, session_zone=zone)
        staged = stage_extract(build_extract(source, spec, period, apply_window), staging)
        rows, staged_cnt = kept(staged), staged.rows
        tkeys = [target_name(k) for k in spec.keys]
        keyed = reduce(lambda a, b: a & b, [F.col(resolve_name(rows.schema, k)).isNotNull() for k in tkeys])
        dups = duplicate_keys(rows.where(keyed), tkeys, spec.collation).take(1)
        if dups:
            raise DuplicateKeyError(f"{spec.name}: staged extract repeats key(s) {tkeys}, e.g. {dups[0].asDict()}")
        version = ANY_VERSION
        if target_df is not None:
            target = target_df
        elif target_table:
            deploy_target(spark, spec, source.schema, target_table)
            version = table_version(spark, target_table)  # before the table is resolved: what is read is no older
            spark.catalog.refreshTable(target_table)
            target = spark.table(target_table)
        else:
            target = spark.createDataFrame([], target_schema(spec, source.schema))
        publishes = bool(target_table) and target_df is None
        pname, scope, matched = None, None, None
        if spec.partition_column:
            pname = partition_column_name(target_name(resolve_name(source.schema, spec.partition_column)),
                                          spec.partition_granularity)
        partitioned = bool(pname) and has_column(target.schema, pname)
        has_ids = any(f.name.upper() == "ID" for f in target.schema.fields)
        if has_ids:
            # No id is given twice: beyond what any load recorded, in the history or with
            # the table, and beyond what the table holds (rows put in by hand, a restored copy).
            marks = [last_max_id(spark, history_table, target_table), max_id(target, resolve_name(target.schema, "ID"))]
            if publishes:
                marks.append(int(table_properties(spark, target_table).get(MAX_ID_PROPERTY, 0)))
            id_base = max(m for m in marks if m is not None)
        chosen = plan_merge(spark, rows, plan, staged_rows=staged_cnt, needs_ids=has_ids, staged_bytes=staged.bytes,
                            broadcast_max_bytes=broadcast_max_bytes).name
        unchanged = staged_cnt == 0
        if publishes and chosen == "broadcast" and not unchanged:
            matched = kept(stage_extract(matched_rows(target, rows, spec, [resolve_name(target.schema, pname)] if partitioned else [])))
            unchanged = matched.where("__changed").isEmpty() and unmatched_rows(target, rows, matched, spec).isEmpty()
        if not (unchanged and publishes):
            if publishes and partitioned:
                # Merge and re-point only the partitions that the load can change.
                target, scope = scope_to_partitions(target, rows, spec, source.schema,
                                                    matched_too=not spec.scoped_by_partition, matched=matched)
            if partitioned:
                target = target.drop(resolve_name(target.schema, pname))
            merged = merge_upsert(target, rows, spec.keys, spec.check_columns, spec.extra_columns,
                                  stamp=Stamp(load_id, now, user), plan=chosen, staged_rows=staged_cnt, id_base=id_base,
                                  collation=spec.collation, matched=matched,
                                  broadcast_max_bytes=broadcast_max_bytes if chosen != "broadcast" else sys.maxsize,
                                  keep_inserts=lambda df: kept(stage_extract(df)))
            # E3 counts, taken in the stage that writes (once per row, even on re-runs).
            obs = Observation(f"merge-counts-{uuid.uuid4().hex[:12]}")
            counts = (obs, [F.count_if(F.col(ACTION_COL) == INSERT).alias("insert_cnt"),
                            F.count_if(F.col(ACTION_COL) == UPDATE).alias("update_cnt")])
            part = target_name(spec.partition_column) if spec.partition_column else None
            gran = spec.partition_granularity
            cluster = tkeys if spec.cluster_keys else []
            if publishes and scope is not None:
                snapshot = publish_partitions(spark, target_table, merged, part, gran, scope, counts, [ACTION_COL], version, cluster)
            elif publishes:
                snapshot = publish_snapshot(spark, target_table, merged, part, gran, counts, [ACTION_COL], version, cluster)
            elif output_path:
                snapshot = write_snapshot(merged, output_path, part, gran, observe=counts, drop=[ACTION_COL], cluster=cluster)
            else:
                merged.observe(counts[0], *counts[1]).drop(ACTION_COL).write.format("noop").mode("overwrite").save()
            m = obs.get
            ins, upd = int(m["insert_cnt"]), int(m["update_cnt"])
            if publishes and id_base is not None:
                set_property(spark, target_table, MAX_ID_PROPERTY, str(id_base + ins))
    except Exception as e:  # recorded, then raised again
        error, exc = _failure(e), e
    finally:
        for path in scratch:
            drop_path(spark, path)
    new_max = id_base + ins if (id_base is not None and error is None) else None
    hist = hist.unionByName(record("FINISHED", staged_cnt=staged_cnt, insert_cnt=ins, update_cnt=upd, delete_cnt=0,
                                   error=error, max_id=new_max))
    spark.sparkContext.setJobDescription(None)
    if exc is not None and raise_errors:
        raise exc
    return LoadResult(period, staged_cnt, ins, upd, 0, chosen, snapshot, hist, error)


def run_check(spark: SparkSession, spec: JobSpec, start: dt.datetime | None = None,
              end: dt.datetime | None = None, earliest: dt.datetime = NO_EARLIEST_OVERRIDE, *, load_id: int,
              now: dt.datetime | None = None, source_df: DataFrame | None = None,
              target_df: DataFrame | None = None, apply_residual: bool = False,
              history_table: str | None = None, history_path: str | None = None,
              raise_errors: bool = True, digests: bool = False) -> CheckResult:
    """H2: C5 -> C4 -> C1 -> C2 -> E4 -> message -> A6.

    History carries ``src_miss`` / ``trg_miss`` in the insert / update slots.
    ``digests``: compare digests of the search column's partitions first, and
    keys only where they differ (for tables that agree almost everywhere).
    """
    now = now or dt.datetime.now()
    zone = _session_zone(spark)
    period = Period(start, end, None, None)
    base = dict(load_id=load_id, job=f"CHECK_{spec.name}", source_table=spec.source.label, target_table=spec.target.label)

    def bounds() -> dict:
        return dict(period_start=format_ts(period.start), period_end=format_ts(period.end), eff_start=period.eff_start,
                    eff_end=period.eff_end)

    hist = append_history(spark, [HistoryRecord(status="START", event_dttm=now, **base, **bounds())],
                          path=history_path, table=history_table)
    spark.sparkContext.setJobDescription(f"check {spec.name} #{load_id}")
    src_miss = trg_miss = 0
    min_miss, message, error, exc = None, "", None, None
    scratch: list[str] = []

    def kept(df: DataFrame) -> DataFrame:
        staged = stage_extract(df)
        scratch.append(staged.path)
        return staged.df

    try:
        source = source_df if source_df is not None else read_source(spark, spec.source)
        target = target_df if target_df is not None else read_source(spark, spec.target)
        validate_spec(spec, source.schema)
        period = resolve_check_period(spec, start, end, now=now, earliest=earliest, source=source, session_zone=zone)
        if apply_residual:
            source = residual_filter(source, spec.search_condition)
        col = spec.search_column.name if spec.search_column else None
        target = prune_to_window(target, spec.partition_column, col, period.eff_start, period.eff_end,
                                 spec.partition_granularity)
        if digests and col:
            r = reconcile_by_partition(source, target, spec.keys, col, period, spec.collation, granularity=spec.partition_granularity,
                                       keep=kept).first()
        else:
            r = reconcile(source, target, spec.keys, col, period if col else None, spec.collation).first()
        src_miss, trg_miss, min_miss = int(r["src_miss"]), int(r["trg_miss"]), r["min_miss_dttm"]
        if trg_miss > 0:
            parts = (format_ts(min_miss), format_ts(period.start), format_ts(period.end))
            # Text joined with a NULL date is NULL (no search column: no dates).
            message = None if None in parts else MISSING_MESSAGE.format(
                job=base["job"], dttm=parts[0], start=parts[1], end=parts[2])
    except Exception as e:
        error, exc = _failure(e), e
    finally:
        for path in scratch:
            drop_path(spark, path)
    hist = hist.unionByName(append_history(
        spark, [HistoryRecord(status="FINISHED", event_dttm=now, insert_cnt=src_miss, update_cnt=trg_miss, delete_cnt=0,
                              error=error, message=message, **base, **bounds())], path=history_path, table=history_table))
    spark.sparkContext.setJobDescription(None)
    if exc is not None and raise_errors:
        raise exc
    return CheckResult(period, src_miss, trg_miss, min_miss, message, hist, error)


BATCH_SCHEMA = T.StructType([
    T.StructField("job", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("staged_cnt", T.LongType(), True),
    T.StructField("insert_cnt", T.LongType(), True),
    T.StructField("update_cnt", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
])


def run_batch(spark: SparkSession, specs: Sequence[JobSpec], job: Callable[[JobSpec], LoadResult],
              max_workers: int = 1, *, time_limit: float | None = None, grace: float = 10.0, pool: str | None = None) -> DataFrame:
    """H3: run independent jobs; one failing spec does not stop the others.

    ``job`` runs one spec (e.g. a partial of ``run_load``).  With
    ``max_workers > 1`` jobs are submitted from a small thread pool and Spark
    runs them concurrently, but for jobs on one target, which run in turn.
    Every spec's Spark jobs carry a tag of their own and, if given, run in the
    scheduler pool ``pool``.  A spec that takes longer than ``time_limit``
    seconds has its Spark jobs cancelled and is reported as TIMEOUT; it may still
    write its history record, but after each ``grace`` seconds whatever it runs is
    cancelled again.  What it had not published stays unpublished.
    """
    sc = spark.sparkContext

    def one(spec: JobSpec):
        tag, over, done = f"batch-{uuid.uuid4().hex[:12]}", threading.Event(), threading.Event()

        def watch() -> None:
            if not done.wait(time_limit):
                over.set()
                sc.cancelJobsWithTag(tag)
                while not done.wait(grace):
                    sc.cancelJobsWithTag(tag)

        watcher = threading.Thread(target=watch, daemon=True)
        sc.addJobTag(tag)
        if pool:
            sc.setLocalProperty("spark.scheduler.pool", pool)
        if time_limit is not None:
            watcher.start()
        try:
            r = job(spec)
            status = "FINISHED" if r.error is None else "TIMEOUT" if over.is_set() else "ERROR"
            return (spec.name, status, r.staged_cnt, r.insert_cnt, r.update_cnt, r.error)
        except Exception as e:
            return (spec.name, "TIMEOUT" if over.is_set() else "ERROR", None, None, None, _failure(e))
        finally:
            done.set()
            sc.removeJobTag(tag)
            if pool:
                sc.setLocalProperty("spark.scheduler.pool", None)

    by_target: dict[str, list[int]] = {}
    for i, spec in enumerate(specs):
        by_target.setdefault(spec.target.label.lower(), []).append(i)

    def in_turn(places: list[int]) -> list[tuple[int, tuple]]:
        return [(i, one(specs[i])) for i in places]

    with ThreadPoolExecutor(max(1, max_workers)) as threads:
        done = dict(r for part in threads.map(in_turn, by_target.values()) for r in part)
    rows = [done[i] for i in range(len(specs))]
    return spark.createDataFrame(rows, BATCH_SCHEMA)


def readiness_report(spark: SparkSession, specs: Sequence[JobSpec],
                     sources: dict[str, DataFrame] | None = None,
                     targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """H4: per spec -- search column present, source profile, target presence and size, first error.

    Per spec, source and target rows are tagged and unioned, and one aggregate
    pass yields the source profile and the target count; the per-spec frames
    are unioned, so the whole report is a single Spark job.
    """
    frames = []
    for spec in specs:
        err = None
        src = (sources or {}).get(spec.name)
        tgt = (targets or {}).get(spec.name)
        try:
            if src is None:
                src = read_source(spark, spec.source)
            col = spec.search_column.name if spec.search_column else None
            exists = bool(col) and has_column(src.schema, col)
            try:
                validate_spec(spec, src.schema)
            except SpecError as e:
                err = str(e)
            t_exists = tgt is not None or (spec.target.name is not None
                                           and spark.catalog.tableExists(spec.target.name))
            if tgt is None and t_exists:
                tgt = read_source(spark, spec.target)
            v = F.col(resolve_name(src.schema, col)).cast("timestamp_ntz") if exists else \
                F.lit(None).cast("timestamp_ntz")
            tagged = src.select(F.lit(True).alias("__src"), v.alias("__v"))
            if tgt is not None:
                tagged = tagged.unionByName(tgt.select(F.lit(False).alias("__src"),
                                                       F.lit(None).cast("timestamp_ntz").alias("__v")))
            agg = tagged.agg(
                F.count_if(F.col("__src")).alias("row_count"),
                F.min("__v").alias("min_value"),
                F.max("__v").alias("max_value"),
                F.count_if(~F.col("__src")).alias("target_row_count"))
            frames.append(agg.select(
                F.lit(spec.name).alias("job"), F.lit(spec.source.label).alias("source_table"),
                F.lit(col).cast("string").alias("search_column"),
                F.lit(exists).alias("search_column_exists"), "row_count", "min_value", "max_value",
                (month_span(F.col("min_value"), F.col("max_value")).cast("int") if exists
                 else F.lit(None).cast("int")).alias("month_cnt"),
                F.lit(t_exists).alias("target_exists"),
                F.when(F.lit(t_exists), F.col("target_row_count")).otherwise(F.lit(0)).cast("long")
                 .alias("target_row_count"),
                F.lit(err).cast("string").alias("error")))
        except Exception as e:
            frames.append(spark.createDataFrame(
                [(spec.name, spec.source.label, None, False, None, None, None, None, False, 0,
                  _failure(e))],
                READINESS_SCHEMA))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


READINESS_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()), T.StructField("source_table", T.StringType()),
    T.StructField("search_column", T.StringType()), T.StructField("search_column_exists", T.BooleanType()),
    T.StructField("row_count", T.LongType()), T.StructField("min_value", T.TimestampNTZType()),
    T.StructField("max_value", T.TimestampNTZType()), T.StructField("month_cnt", T.IntegerType()),
    T.StructField("target_exists", T.BooleanType()), T.StructField("target_row_count", T.LongType()),
    T.StructField("error", T.StringType()),
])


__all__ = ["run_load", "run_check", "run_batch", "readiness_report", "build_extract", "scope_to_partitions",
           "LoadResult", "CheckResult", "DuplicateKeyError"]
