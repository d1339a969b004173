"""The target table: shape, creation, partitioned snapshots, reports.

A target is never overwritten while it is read.  A load writes a new
snapshot directory (partitioned on the partition column's month by default)
under the root for targets, and the catalog table is re-pointed at it; readers
keep a consistent view.  Each publish holds a claim (a file created exclusively)
on the version that it read from and gives the table a new one; a publish that
finds another version, or the claim held, is refused.  A table's folders carry
its token, a property that no other table has.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.shape import target_name
from tidemark.spec import JobSpec, resolve_name
from tidemark.session import create_exclusive, drop_path, list_folders, path_exists, target_path, target_root

HOUSEKEEPING_FIELDS = [
    T.StructField("ID", T.LongType(), False),
    T.StructField("INSERT_DTTM", T.TimestampNTZType(), False),
    T.StructField("UPDATE_DTTM", T.TimestampNTZType(), False),
    T.StructField("LST_MOD_USER", T.StringType(), False),
    T.StructField("MSTR_LOAD_ID", T.IntegerType(), False),
    T.StructField("ACTIVE_FLAG", T.ShortType(), False),
]


def target_schema(spec: JobSpec, source_schema: T.StructType) -> T.StructType:
    """A3: housekeeping + source columns (excluded dropped, reserved renamed) + extras.

    A partitioned target also carries the partition value column (A5).
    """
    excluded = {c.lower() for c in spec.excluded_columns}
    part = spec.partition_column.lower() if spec.partition_column else None
    fields = list(HOUSEKEEPING_FIELDS)
    for f in source_schema.fields:
        if f.name.lower() in excluded:
            continue
        dt = T.TimestampNTZType() if f.name.lower() == part else f.dataType
        fields.append(T.StructField(target_name(f.name), dt, True))
    for e in spec.extra_columns:
        fields.append(T.StructField(target_name(e.name), T._parse_datatype_string(e.data_type), True))
    if spec.partition_column:
        pname = partition_column_name(target_name(resolve_name(source_schema, spec.partition_column)),
                                      spec.partition_granularity)
        fields.append(T.StructField(pname, T.DateType(), True))
    return T.StructType(fields)


def _empty_writer(spark: SparkSession, spec: JobSpec, source_schema: T.StructType, path: str | None):
    schema = target_schema(spec, source_schema)
    w = spark.createDataFrame([], schema).write.format("parquet")
    if spec.partition_column:
        w = w.partitionBy(schema.fields[-1].name)
    if path:
        w = w.option("path", path)
    return w


def create_target(spark: SparkSession, spec: JobSpec, source_schema: T.StructType, table: str,
                  path: str | None = None) -> DataFrame:
    """A3: create the empty target table when it does not exist; return it.

    The table is external, under ``path`` or else the root for targets.  A
    table left under its interim name by a replacement that was cut short is
    put in place first.
    """
    interim = _interim(table)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(interim):
        spark.sql(f"ALTER TABLE {interim} RENAME TO {table}")
    if not spark.catalog.tableExists(table):
        token = uuid.uuid4().hex[:12]
        _empty_writer(spark, spec, source_schema, path or _folder(spark, table, token, "created")).saveAsTable(table)
        set_property(spark, table, TOKEN_PROPERTY, token)
    return spark.table(table)


def recreate_target(spark: SparkSession, spec: JobSpec, source_schema: T.StructType, table: str,
                    path: str | None = None) -> DataFrame:
    """A4: with ``spec.recreate`` drop and rebuild an existing target; else keep it.

    An act of deployment: it empties the table each time it is called.
    """
    if spec.recreate and spark.catalog.tableExists(table):
        token = table_token(spark, table)
        with claimed(spark, table, ANY_VERSION):
            path = path or _folder(spark, table, token, "created")
            _empty_writer(spark, spec, source_schema, path).mode("overwrite").saveAsTable(table)
            set_property(spark, table, TOKEN_PROPERTY, token)
        spark.catalog.refreshTable(table)
        return spark.table(table)
    return create_target(spark, spec, source_schema, table, path)


def deploy_target(spark: SparkSession, spec: JobSpec, source_schema: T.StructType, table: str) -> DataFrame:
    """The target as a load needs it: created if missing, rebuilt once if the spec asks for it.

    The table remembers which spec it was rebuilt for, so later loads of the
    same spec keep its rows; ``recreate_target`` rebuilds it at any time.
    """
    if not spec.recreate:
        return create_target(spark, spec, source_schema, table)
    made_for = hashlib.sha256(repr(spec).encode()).hexdigest()
    if not spark.catalog.tableExists(table) or table_properties(spark, table).get(RECREATED_PROPERTY) != made_for:
        recreate_target(spark, spec, source_schema, table)
        set_property(spark, table, RECREATED_PROPERTY, made_for)
    return spark.table(table)


def partition_value(col: Column, granularity: str = "month") -> Column:
    """A5: the partition a row belongs to (truncated timestamp, as a date)."""
    return F.date_trunc(granularity, col.cast("timestamp_ntz")).cast("date")


def partition_column_name(column: str, granularity: str = "month") -> str:
    return f"{column}_{granularity}"


def prune_to_window(target: DataFrame, partition_column: str | None, search_column: str | None,
                    start, end, granularity: str = "month") -> DataFrame:
    """Add the partition-column form of a window filter on the search column.

    A window on the search column does not prune partitions keyed by its
    truncated value; the same window on the partition column does
    (``PartitionFilters``).  Only when the partition column is the search column.
    """
    if not (partition_column and search_column and start is not None and end is not None):
        return target
    if partition_column.lower() != search_column.lower():
        return target
    col = target_name(partition_column)
    pname = partition_column_name(col, granularity)
    if pname.lower() not in {c.lower() for c in target.columns}:
        return target
    lo = partition_value(F.lit(start.isoformat(sep=" ")), granularity)
    hi = partition_value(F.lit(end.isoformat(sep=" ")), granularity)
    return target.where(F.col(resolve_name(target.schema, pname)).between(lo, hi))


Observe = tuple  # (Observation, [aggregate Column, ...]) measured in the write's final stage


def write_snapshot(df: DataFrame, path: str, partition_column: str | None = None,
                   granularity: str = "month", mode: str = "errorifexists",
                   observe: Observe | None = None, drop: Sequence[str] = (), cluster: Sequence[str] = ()) -> str:
    """A5: write ``df`` to ``path``, partitioned on a truncated datetime column, within it clustered by ``cluster``."""
    _write_partitioned(df, path, partition_column, granularity, mode, observe, drop, cluster)
    return path


def _write_partitioned(df: DataFrame, path: str, partition_column: str | None, granularity: str,
                       mode: str = "errorifexists", observe: Observe | None = None,
                       drop: Sequence[str] = (), cluster: Sequence[str] = ()) -> list | None:
    """Write, and return the partition values written (observed in the same pass).

    ``rebalance`` lets AQE even out task sizes by partition value: a month
    holding a third of all rows is split over many tasks instead of one,
    and tiny months are coalesced.  Metrics (the caller's ``observe`` and the
    set of partition values, bounded by the partition count) are taken above
    that exchange, in the stage that writes: a stage re-run after a lost
    executor cannot count a row twice.  ``drop`` columns are removed after
    the metrics are taken.
    """
    w = df
    pname = None
    if partition_column:
        c = resolve_name(df.schema, partition_column)
        pname = partition_column_name(c, granularity)
        w = w.withColumn(pname, partition_value(F.col(c), granularity))
    by = ([pname] if pname else []) + [resolve_name(df.schema, c) for c in cluster]
    if cluster:
        w = w.repartitionByRange(*by).sortWithinPartitions(*by)
    elif pname:
        w = w.hint("rebalance", pname)
    pobs = None
    if pname:
        pobs = Observation(f"partitions-{uuid.uuid4().hex[:12]}")
        # A set leaves NULL out, so its rows are counted beside it.
        w = w.observe(pobs, F.collect_set(pname).alias("values"), F.count_if(F.col(pname).isNull()).alias("nulls"))
    if observe is not None:
        w = w.observe(observe[0], *observe[1])
    if drop:
        w = w.drop(*drop)
    writer = w.write.mode(mode).format("parquet")
    (writer.partitionBy(pname) if pname else writer).save(path)
    if pobs is None:
        return None
    return sorted(pobs.get["values"]) + ([None] if pobs.get["nulls"] else [])


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


class ConcurrentLoadError(RuntimeError):
    """Another load has published into the target since this one read it."""


VERSION_PROPERTY, MAX_ID_PROPERTY = "tidemark.version", "tidemark.max_id"
# (Spark hides the values of properties that are called tokens.)
TOKEN_PROPERTY, RECREATED_PROPERTY = "tidemark.folders", "tidemark.recreated_for"


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def table_version(spark: SparkSession, table: str) -> str | None:
    """The version of the last publish; None for a table that no load has published into."""
    return table_properties(spark, table).get(VERSION_PROPERTY)


def set_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


ANY_VERSION = object()


def table_token(spark: SparkSession, table: str) -> str:
    """What the table's folders and claims are named after, whatever the table is called; given once."""
    token = table_properties(spark, table).get(TOKEN_PROPERTY)
    if token is None:
        token = uuid.uuid4().hex[:12]
        set_property(spark, table, TOKEN_PROPERTY, token)
    return token


def _folder(spark: SparkSession, table: str, token: str, kind: str) -> str:
    return target_path(spark, f"{table.replace('.', '_')}-{token}-{kind}")


def _claim_path(spark: SparkSession, token: str, version: str | None) -> str:
    return f"{target_root(spark)}/_claims/{token}-{version or 'unpublished'}"


@contextmanager
def claimed(spark: SparkSession, table: str, expected) -> Iterator[None]:
    """Hold the version of ``table`` that was read, alone among all drivers, while it is switched.

    The claim is a file named after the table's token and version, which only
    one can create.  The table gets its new version when the switch is over,
    also when it failed half-way, and before the claim is given up: so whoever
    read the table before or during the switch is refused.
    """
    token, found = table_token(spark, table), table_version(spark, table)

    def refuse(why: str) -> ConcurrentLoadError:
        return ConcurrentLoadError(f"{table} {why}; run the load again")

    if expected is not ANY_VERSION and found != expected:
        raise refuse(f"was published into since it was read (version {found}, read at {expected})")
    claim = _claim_path(spark, token, found)
    if not create_exclusive(spark, claim, spark.sparkContext.applicationId):
        raise refuse("is being published into by another load (if that one is dead, release_claim frees the table)")
    try:
        if table_version(spark, table) != found:  # the holder before this one has just finished
            raise refuse(f"was published into since it was read (version {found})")
        try:
            yield
        finally:
            set_property(spark, table, VERSION_PROPERTY, uuid.uuid4().hex)
    finally:
        drop_path(spark, claim)


def release_claim(spark: SparkSession, table: str) -> bool:
    """Give up the claim that a dead load left on ``table``; false if there was none.

    The table gets a new version, so that a load that is not dead after all
    cannot publish on the old one.
    """
    claim = _claim_path(spark, table_token(spark, table), table_version(spark, table))
    if not path_exists(spark, claim):
        return False
    set_property(spark, table, VERSION_PROPERTY, uuid.uuid4().hex)
    return drop_path(spark, claim)


@contextmanager
def _written(spark: SparkSession, table: str, token: str, kind: str) -> Iterator[str]:
    """A new folder for the table's data, marked as being written until the table points at it."""
    path = _folder(spark, table, token, kind)
    mark = _mark(path)
    create_exclusive(spark, mark)
    try:
        yield path
    finally:
        drop_path(spark, mark)


def _mark(folder: str) -> str:
    root, name = folder.rstrip("/").rsplit("/", 1)
    return f"{root}/_writing/{name}"


def _interim(table: str) -> str:
    return f"{table}__next"


def publish_snapshot(spark: SparkSession, table: str, df: DataFrame, partition_column: str | None = None,
                     granularity: str = "month", observe: Observe | None = None, drop: Sequence[str] = (),
                     expected=ANY_VERSION, cluster: Sequence[str] = ()) -> str:
    """Write a new full snapshot of ``table`` and point the catalog at it.

    An existing table with the same columns is switched in one catalog call
    per location (the table's, or each partition's), so readers see the old
    or the new data.  A new table, or one whose columns changed, is created
    under an interim name and then renamed; ``create_target`` completes a
    replacement that was cut short.  ``expected``: the version that ``df`` was
    derived from.
    """
    exists = spark.catalog.tableExists(table)
    token = table_token(spark, table) if exists else uuid.uuid4().hex[:12]
    with _written(spark, table, token, "snapshot") as path:
        values = _write_partitioned(df, path, partition_column, granularity, observe=observe, drop=drop, cluster=cluster)
        pname = partition_column_name(resolve_name(df.schema, partition_column), granularity) if partition_column else None
        if not exists:
            _create_at(spark, table, path, pname, token)
            return path
        with claimed(spark, table, expected):
            current = spark.table(table).schema
            dropped = {d.lower() for d in drop}
            new_names = [f.name.lower() for f in df.schema.fields if f.name.lower() not in dropped] \
                + ([pname.lower()] if pname else [])
            same = sorted(f.name.lower() for f in current.fields) == sorted(new_names)
            parts = _partition_columns(spark, table)
            if same and not pname and not parts:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                spark.catalog.refreshTable(table)
            elif same and pname and [c.lower() for c in parts] == [pname.lower()]:
                _repoint_partitions(spark, table, path, pname, values, drop_others=True)
            else:
                name, kept = _interim(table), table_properties(spark, table)
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                _create_at(spark, name, path, pname, token)
                for key in (MAX_ID_PROPERTY, RECREATED_PROPERTY):
                    if key in kept:
                        set_property(spark, name, key, kept[key])
                spark.sql(f"DROP TABLE {table}")
                spark.sql(f"ALTER TABLE {name} RENAME TO {table}")
                spark.catalog.refreshTable(table)
    return path


def _create_at(spark: SparkSession, name: str, path: str, pname: str | None, token: str) -> None:
    spark.catalog.createTable(name, path=path, source="parquet")
    if pname:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    set_property(spark, name, TOKEN_PROPERTY, token)
    set_property(spark, name, VERSION_PROPERTY, uuid.uuid4().hex)
    spark.catalog.refreshTable(name)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _partition_text(value) -> str:
    """A partition value as directories and SHOW PARTITIONS have it."""
    return NO_VALUE if value is None else value.isoformat()


def _partition_sql(text: str) -> str:
    return "null" if text in (NO_VALUE, "null") else f"date'{text}'"


def _repoint_partitions(spark: SparkSession, table: str, path: str, pname: str, values: list,
                        drop_others: bool = False, scope: list | None = None) -> None:
    """Point each listed partition of ``table`` at ``path/pname=value`` (adding new ones).

    Partitions that should exist no more -- any not in ``values`` with
    ``drop_others`` (a full snapshot), or those in ``scope`` that were not
    written -- lost all their rows to updates that moved them, and are
    dropped so their old rows cannot show up twice.  The NULL partition is one
    like any other.
    """
    def text(row: str) -> str:
        value = row.split("=", 1)[1]
        return NO_VALUE if value in (NO_VALUE, "null") else value

    existing = {text(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    keep = [_partition_text(v) for v in values]
    gone = (existing if drop_others else {_partition_text(v) for v in (scope or [])} & existing) - set(keep)
    for g in sorted(gone):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({pname}={_partition_sql(g)})")
    new_parts = []
    for v in keep:
        spec, location = f"{pname}={_partition_sql(v)}", f"{path}/{pname}={v}"
        if v in existing:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{location}'")
        else:
            new_parts.append(f"PARTITION ({spec}) LOCATION '{location}'")
    if new_parts:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(new_parts))
    spark.catalog.refreshTable(table)


def publish_partitions(spark: SparkSession, table: str, df: DataFrame, partition_column: str,
                       granularity: str = "month", scope: list | None = None, observe: Observe | None = None,
                       drop: Sequence[str] = (), expected=ANY_VERSION, cluster: Sequence[str] = ()) -> str:
    """Write only the partitions in ``scope`` and re-point them in ``table``.

    ``df`` must hold every row of the scoped partitions (the merged rows of
    the partitions a load can change).  Partitions outside the scope are
    neither read nor rewritten; each scoped one moves to its new directory in
    one catalog call, so readers see the old or the new partition, never a
    half-written one.  A scoped partition left without rows is dropped.
    """
    with _written(spark, table, table_token(spark, table), "partitions") as path:
        written = _write_partitioned(df, path, partition_column, granularity, observe=observe, drop=drop, cluster=cluster)
        pname = partition_column_name(resolve_name(df.schema, partition_column), granularity)
        with claimed(spark, table, expected):
            _repoint_partitions(spark, table, path, pname, written, scope=scope)
    return path


def locations(spark: SparkSession, table: str) -> set[str]:
    """Where the table and its partitions lie, as the catalog has it (an entry a partition, no file is listed)."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(table)
    entries = [state.catalog().getTableMetadata(ident)]
    if _partition_columns(spark, table):
        found = state.catalog().listPartitions(ident, spark._jvm.scala.Option.empty()).iterator()
        while found.hasNext():
            entries.append(found.next())
    uris = [e.storage().locationUri() for e in entries]
    return {u.get().toString().rstrip("/") for u in uris if u.isDefined()}


def remove_superseded(spark: SparkSession, table: str, abandoned: bool = False) -> list[str]:
    """Remove the table's own folders that neither it nor a partition of it points at; returns them.

    Only folders that carry the table's token are its own.  Call it when no
    reader can still be on an older snapshot.  Folders that a load is still
    writing stay; with ``abandoned`` they go too (for loads that died).
    """
    token = table_token(spark, table)
    # A partition lies one level below its snapshot's folder.
    used = {part for place in locations(spark, table) for part in place.rsplit("/", 2)[1:]}
    gone = []
    for folder in list_folders(spark, target_root(spark)):
        name = folder.rstrip("/").rsplit("/", 1)[1]
        if f"-{token}-" not in name or name in used:
            continue
        if path_exists(spark, _mark(folder)):
            if not abandoned:
                continue
            drop_path(spark, _mark(folder))
        drop_path(spark, folder)
        gone.append(folder)
    return gone


def write_diffs(report: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Persist a comparison report (parquet, or csv with a header)."""
    w = report.coalesce(1).write.mode("errorifexists")
    (w.option("header", "true").csv(path) if fmt == "csv" else w.parquet(path))
    return path
