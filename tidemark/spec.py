"""Job specification: one source -> target table pair and how to load it.

A ``JobSpec`` is plain data.  ``validate_spec`` checks it against the source
schema before any data is touched; every name is matched case-insensitively.
``JobSpec.from_config`` accepts the key names of the sheet/JSON job files so
existing job files keep working.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from typing import Any, Mapping

from pyspark.sql.types import StructType

from tidemark.constants import CHECK_GRACE_HOURS


class SpecError(ValueError):
    """A job spec that cannot run against its source."""


@dataclass(frozen=True)
class TableRef:
    """Where a table lives: a catalog name, a path + format, or a JDBC source."""

    name: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def label(self) -> str:
        if self.name:
            return self.name
        if self.path:
            return self.path
        return str(self.options.get("dbtable", "<jdbc>"))


@dataclass(frozen=True)
class SearchColumn:
    name: str
    is_utc: bool = False


@dataclass(frozen=True)
class ExtraColumn:
    """A target-only column whose value is a Spark SQL expression over ``source.*``."""

    name: str
    data_type: str
    value: str


@dataclass(frozen=True)
class JobSpec:
    name: str
    source: TableRef
    target: TableRef
    keys: tuple[str, ...]
    search_column: SearchColumn | None = None
    search_condition: str = ""
    excluded_columns: tuple[str, ...] = ()
    set_day_start: bool = False
    extra_key_columns: tuple[str, ...] = ()
    extra_columns: tuple[ExtraColumn, ...] = ()
    partition_column: str | None = None
    check_columns: tuple[str, ...] = ()
    recreate: bool = False
    # Not in the job files; made explicit so runs are repeatable.
    utc_shift_hours: int | None = None
    utc_zone: str | None = None
    check_grace_hours: int = CHECK_GRACE_HOURS
    default_start: dt.datetime | None = None
    partition_granularity: str = "month"
    # True: a row never changes partition, so the staged rows' partitions are
    # all that a load can change.  Only keys that hold the partition column
    # ensure that; elsewhere it is refused.  None: true for such keys.
    partition_scoped: bool | None = None
    # String keys and check columns compare under this collation (e.g.
    # "UNICODE_CI" for case-insensitive matching); None compares bytes.
    collation: str | None = None
    # Write the target's files in ranges of the key (within partitions), so
    # that their statistics show a later load which of them can match.
    cluster_keys: bool = False

    def with_(self, **changes: Any) -> "JobSpec":
        return replace(self, **changes)

    @property
    def is_utc(self) -> bool:
        """UTC flag: explicit, or the search column's name says so."""
        sc = self.search_column
        return bool(sc and (sc.is_utc or "utc" in sc.name.lower()))

    @property
    def scoped_by_partition(self) -> bool:
        if not self.partition_column:
            return False
        in_keys = self.partition_column.lower() in {k.lower() for k in self.keys}
        return in_keys and self.partition_scoped is not False

    @classmethod
    def from_config(cls, cfg: Mapping[str, Any], name: str | None = None) -> "JobSpec":
        """Build a spec from a job file dict (upper-case keys)."""
        def table(prefix: str) -> TableRef:
            parts = [cfg.get(f"{prefix}_DATABASE"), cfg.get(f"{prefix}_SCHEMA"), cfg.get(f"{prefix}_TABLE")]
            parts = [p for p in parts if p]
            server = cfg.get(f"{prefix}_SERVER", "")
            if server and server not in ("localhost", "127.0.0.1") and cfg.get(f"{prefix}_JDBC_URL"):
                return TableRef(format="jdbc", options={"url": cfg[f"{prefix}_JDBC_URL"],
                                                        "dbtable": ".".join(parts)})
            return TableRef(name=".".join(parts))

        for key in ("SOURCE_TABLE_PRIMARY_KEY", "SOURCE_EXCLUDED_COLUMNS", "TARGET_TABLE_EXTRA_KEY_COLUMNS",
                    "TARGET_TABLE_EXTRA_COLUMNS", "UPDATE_MATCH_CHECK_COLUMNS"):
            if key in cfg and not isinstance(cfg[key], list):
                raise SpecError(f"{key}: a list is expected")
        if "SET_DAY_START" in cfg and not isinstance(cfg["SET_DAY_START"], bool):
            raise SpecError("SET_DAY_START: true or false is expected")
        sc = cfg.get("SOURCE_TABLE_SEARCH_COLUMN")
        search = None
        if sc:
            if not isinstance(sc, Mapping) or "column_name" not in sc or "is_utc" not in sc:
                raise SpecError("SOURCE_TABLE_SEARCH_COLUMN: an object with the keys column_name and is_utc is expected")
            if not sc["column_name"]:
                raise SpecError("SOURCE_TABLE_SEARCH_COLUMN: column_name is blank")
            search = SearchColumn(sc["column_name"], bool(sc["is_utc"]))
        keys = tuple(k["column_name"] if isinstance(k, Mapping) else k for k in cfg.get("SOURCE_TABLE_PRIMARY_KEY", []))
        extras = tuple(ExtraColumn(e["column_name"], e["data_type"], e["value"])
                       for e in cfg.get("TARGET_TABLE_EXTRA_COLUMNS", []))
        src = table("SOURCE")
        return cls(
            name=name or cfg.get("STORED_PROCEDURE_NAME") or src.label,
            source=src,
            target=table("TARGET"),
            keys=keys,
            search_column=search,
            search_condition=cfg.get("SOURCE_TABLE_SEARCH_CONDITION", "") or "",
            excluded_columns=tuple(cfg.get("SOURCE_EXCLUDED_COLUMNS", [])),
            set_day_start=bool(cfg.get("SET_DAY_START", False)),
            extra_key_columns=tuple(cfg.get("TARGET_TABLE_EXTRA_KEY_COLUMNS", [])),
            extra_columns=extras,
            partition_column=cfg.get("DATA_PARTITION_COLUMN") or None,
            check_columns=tuple(cfg.get("UPDATE_MATCH_CHECK_COLUMNS", [])),
            recreate=bool(cfg.get("TARGET_TABLE_RECREATE", False)),
            # Where the load server's clock stands, for columns in UTC; and a start that saves the look for the earliest date.
            utc_zone=cfg.get("LOAD_TIME_ZONE") or None,
            utc_shift_hours=cfg.get("UTC_SHIFT_HOURS"),
            default_start=dt.datetime.fromisoformat(cfg["DEFAULT_PERIOD_START"]) if cfg.get("DEFAULT_PERIOD_START") else None,
        )


def resolve_name(schema: StructType, name: str) -> str:
    """The schema's own spelling of ``name`` (case-insensitive), or raise."""
    low = name.lower()
    for f in schema.fields:
        if f.name.lower() == low:
            return f.name
    raise SpecError(f'"{name}" is not a column of the source ({", ".join(schema.fieldNames())}).')


def has_column(schema: StructType, name: str) -> bool:
    low = name.lower()
    return any(f.name.lower() == low for f in schema.fields)


def validate_spec(spec: JobSpec, source_schema: StructType) -> None:
    """Checks made before touching data.  Raises ``SpecError``."""
    if not spec.keys:
        raise SpecError(f"{spec.name}: no key columns; a merge needs at least one.")
    for k in spec.keys:
        resolve_name(source_schema, k)
    if spec.search_column is not None:
        if not spec.search_column.name:
            raise SpecError("the search column has a blank name")
        if not has_column(source_schema, spec.search_column.name):
            raise SpecError(f"search column {spec.search_column.name!r} is not in the source")
    for group, cols in (("extra key", spec.extra_key_columns), ("check", spec.check_columns),
                        ("excluded", spec.excluded_columns)):
        for c in cols:
            if not has_column(source_schema, c):
                raise SpecError(f"{group} column {c!r} is not in the source")
    excluded = {c.lower() for c in spec.excluded_columns}
    for k in spec.keys:
        if k.lower() in excluded:
            raise SpecError(f"key column {k!r} is excluded")
    if spec.partition_granularity not in ("year", "quarter", "month", "week", "day"):
        raise SpecError(f"unknown partition granularity {spec.partition_granularity!r}")
    if spec.partition_scoped and not spec.scoped_by_partition:
        raise SpecError(f"{spec.name}: partition_scoped needs the partition column among the keys; "
                        "otherwise an updated row can leave its partition")
