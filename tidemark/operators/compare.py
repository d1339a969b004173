"""Table comparison: source against target, by schema and by value.

By schema, findings are metadata (one row per column or table at most); the
only data work is the emptiness test of each table, a ``limit 1`` probe that
stops at the first row.

By value, findings come from counts over both tables: which values of a
mismatched column would not survive the cast, whether the declared keys hold
and occur on the other side, and in how many matched rows each column differs.
Each is one aggregate a table, or one join of rows reduced to their keys.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from tidemark.functions.predicates import changed, keys_equal
from tidemark.operators.shape import target_name
from tidemark.spec import resolve_name

FINDING_SCHEMA = StructType([
    StructField("pair", StringType(), False),
    StructField("kind", StringType(), False),
    StructField("column_name", StringType(), True),
    StructField("detail", StringType(), True),
])


@dataclass(frozen=True)
class Finding:
    pair: str
    kind: str
    column_name: str | None
    detail: str


@dataclass(frozen=True)
class TablePair:
    """A pair to compare; frames are given lazily so an error stays in its pair."""

    name: str
    source: Callable[[], DataFrame]
    target: Callable[[], DataFrame]
    source_keys: Sequence[str]
    target_keys: Sequence[str]
    source_label: str = "source"
    target_label: str = "target"


def _type_name(dt) -> str:
    return dt.typeName()


def type_diffs(pair: str, src: StructType, tgt: StructType) -> list[Finding]:
    """F1: per source column, the type *name* must match (no length/precision).

    The source column is looked up under its target name (reserved names are
    prefixed); a column the target lacks is a finding, not an error.
    """
    tmap = {f.name.lower(): f for f in tgt.fields}
    out = []
    for f in src.fields:
        tname = target_name(f.name)
        t = tmap.get(tname.lower())
        if t is None:
            out.append(Finding(pair, "missing_in_target", f.name, f"target has no column {tname}"))
        elif _type_name(f.dataType) != _type_name(t.dataType):
            out.append(Finding(pair, "type_mismatch", f.name,
                               f"src={f.dataType.simpleString()} tgt={t.dataType.simpleString()}"))
    return out


def key_diffs(pair: str, src_keys: Sequence[str], tgt_keys: Sequence[str]) -> list[Finding]:
    """every source key must be a target key (case and order ignored; one direction)."""
    tset = {target_name(k).lower() for k in tgt_keys} | {k.lower() for k in tgt_keys}
    if all(target_name(k).lower() in tset for k in src_keys):
        return []
    return [Finding(pair, "key_mismatch", None,
                    f"keys of the source: {', '.join(src_keys)}; of the target: {', '.join(tgt_keys)}")]


def empty_table_check(pair: str, df: DataFrame, label: str) -> list[Finding]:
    """a table with no rows."""
    return [Finding(pair, "empty_table", None, f"0 rows in {label}")] if df.isEmpty() else []


def compare_pair(p: TablePair) -> list[Finding]:
    s, t = p.source(), p.target()
    return (type_diffs(p.name, s.schema, t.schema) + key_diffs(p.name, p.source_keys, p.target_keys)
            + empty_table_check(p.name, s, p.source_label) + empty_table_check(p.name, t, p.target_label))


def findings_frame(spark: SparkSession, findings: Sequence[Finding]) -> DataFrame:
    return spark.createDataFrame([(f.pair, f.kind, f.column_name, f.detail) for f in findings], FINDING_SCHEMA)


def compare_tables(spark: SparkSession, pairs: Sequence[TablePair]) -> DataFrame:
    """findings of every pair; a pair that fails becomes an ``error`` row."""
    out: list[Finding] = []
    for p in pairs:
        try:
            out.extend(compare_pair(p))
        except Exception as e:  # isolate the pair, report, go on
            out.append(Finding(p.name, "error", None, f"{type(e).__name__}: {e}"))
    return findings_frame(spark, out)


def pairs_from_specs(spark: SparkSession, specs: Sequence) -> list[TablePair]:
    """F4 input from job specs: source vs target, target keys = the target's primary key list."""
    from tidemark.operators.quality import constraint_keys
    from tidemark.sources.readers import read_source

    def pair(spec) -> TablePair:
        return TablePair(spec.name, lambda: read_source(spark, spec.source), lambda: read_source(spark, spec.target),
                         list(spec.keys), constraint_keys(spec)["primary_key"], spec.source.label, spec.target.label)
    return [pair(s) for s in specs]


# --- by value ----------------------------------------------------------------

def _unfit(df: DataFrame, column: str, to: DataType | None) -> Column:
    """True for the values that have no counterpart in the type ``to`` (None: in no column)."""
    held = F.col(f"`{column}`").isNotNull()
    if to is None:
        return held
    try:
        fits = F.col(f"`{column}`").try_cast(to).isNotNull()
        df.select(fits)
    except AnalysisException:  # no cast between these types at all
        return held
    return held & ~fits


def _counted(df: DataFrame, tests: Sequence[tuple[str, str, Column]], side: str) -> DataFrame:
    """(column_name, <side>_values, <side>_unfit): one row for each (name, column, test), from one pass over ``df``."""
    sums = [c for i, (_, column, test) in enumerate(tests)
            for c in (F.count(F.col(f"`{column}`")).alias(f"v{i}"), F.count_if(test).alias(f"u{i}"))]
    rows = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"v{i}").alias(f"{side}_values"),
                              F.col(f"u{i}").alias(f"{side}_unfit")) for i, (name, _, _) in enumerate(tests)])
    return df.agg(*sums).select(F.inline(rows))


def type_findings(pair: str, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """F1 by value: the findings of ``type_diffs`` with what they mean for the data.

    src_values: non-NULL values of the source column; src_unfit: those that a
    cast to the target's type would lose (of a column that the target lacks,
    all); tgt_values and tgt_unfit: the same the other way round.  One
    aggregate a table; the two sides meet as one row a column.
    """
    found = type_diffs(pair, src.schema, tgt.schema)
    stypes = {f.name: f.dataType for f in src.schema.fields}
    ttypes = {f.name.lower(): f for f in tgt.schema.fields}
    mine, theirs = [], []
    for f in found:
        other = ttypes.get(target_name(f.column_name).lower())
        mine.append((f.column_name, f.column_name, _unfit(src, f.column_name, other.dataType if other else None)))
        if other:
            theirs.append((f.column_name, other.name, _unfit(tgt, other.name, stypes[f.column_name])))
    spark = src.sparkSession
    out = spark.createDataFrame([(f.pair, f.kind, f.column_name, f.detail) for f in found], FINDING_SCHEMA)
    for df, tests, side in ((src, mine, "src"), (tgt, theirs, "tgt")):
        counts = _counted(df, tests, side) if tests else spark.createDataFrame(
            [], f"column_name string, {side}_values long, {side}_unfit long")
        out = out.join(F.broadcast(counts), "column_name", "left")  # a row a column
    return out.select("pair", "kind", "column_name", "detail", "src_values", "src_unfit", "tgt_values", "tgt_unfit")


COUNTED_SCHEMA = StructType([*FINDING_SCHEMA.fields, StructField("n", LongType(), True)])


def key_findings(pair: str, src: DataFrame, tgt: DataFrame, src_keys: Sequence[str], tgt_keys: Sequence[str]) -> DataFrame:
    """F2 by value: (pair, kind, column_name, detail, n), a row for each way in which the keys do not hold.

    key_mismatch as ``key_diffs`` has it (n is NULL); source_key_null and
    target_key_null: rows with a NULL in the declared key; source_key_repeats
    and target_key_repeats: keys that occur more than once; source_key_missing:
    source keys that do not occur in the target, where it has their columns.
    Each side is reduced to one row a key before the keys meet, so a frequent
    key costs one row a task; NULL keys never take part in the join.
    """
    spark = src.sparkSession
    out = spark.createDataFrame([(f.pair, f.kind, f.column_name, f.detail, None) for f in key_diffs(pair, src_keys, tgt_keys)],
                                COUNTED_SCHEMA)

    def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], Column]:
        cols = [resolve_name(df.schema, k) for k in keys]
        return df, cols, reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in cols])

    def row(kind: str, keys: Sequence[str], n: Column) -> list[Column]:
        return [F.lit(pair).alias("pair"), F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("column_name"),
                F.lit(f"keys {', '.join(keys)}").alias("detail"), n.cast("long").alias("n")]

    sides = (("source", *keyed(src, src_keys)), ("target", *keyed(tgt, [_of_target(tgt, k) for k in tgt_keys])))
    for side, df, cols, held in sides:
        per_key = df.where(held).groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(df.agg(F.count_if(~held).alias("n")).select(*row(f"{side}_key_null", cols, F.col("n"))))
        out = out.unionByName(per_key.agg(F.count_if(F.col("n") > 1).alias("n")).select(*row(f"{side}_key_repeats", cols, F.col("n"))))
    there = {f.name.lower() for f in tgt.schema.fields}
    if all(target_name(k).lower() in there for k in src_keys):
        _, cols, held = keyed(src, src_keys)
        theirs = [resolve_name(tgt.schema, target_name(k)) for k in src_keys]
        names = [f"k{i}" for i in range(len(cols))]
        wanted = src.where(held).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(cols, names)]).distinct()
        known = tgt.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(theirs, names)]).distinct()
        missing = wanted.join(known, names, "left_anti").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(missing.select(*row("source_key_missing", cols, F.col("n"))))
    return out.where((F.col("kind") == "key_mismatch") | (F.col("n") > 0))


def _of_target(tgt: DataFrame, key: str) -> str:
    """A target key is named as in the target, or as in the source."""
    there = {f.name.lower() for f in tgt.schema.fields}
    return key if key.lower() in there else target_name(key)


def value_findings(pair: str, src: DataFrame, tgt: DataFrame, keys: Sequence[str], collation: str | None = None) -> DataFrame:
    """F4 by row: for each column that both tables hold under one type, how many matched rows differ in it.

    Rows match on the source's keys; NULLs are equal to each other (B9).  One
    join, one aggregate; columns without a difference give no row.
    """
    ttypes = {f.name.lower(): f for f in tgt.schema.fields}
    tkeys = [resolve_name(tgt.schema, target_name(k)) for k in keys]
    both = [(f.name, ttypes[target_name(f.name).lower()].name) for f in src.schema.fields
            if target_name(f.name).lower() in ttypes and _type_name(ttypes[target_name(f.name).lower()].dataType) == _type_name(f.dataType)
            and f.name.lower() not in {k.lower() for k in keys}]
    strings = {f.name for f in tgt.schema.fields if isinstance(f.dataType, StringType)}
    renamed = src.select(*[F.col(f"`{resolve_name(src.schema, k)}`").alias(t) for k, t in zip(keys, tkeys)],
                         *[F.col(f"`{s}`").alias(t) for s, t in both])
    held = reduce(lambda a, b: a & b, [F.col(f"`{t}`").isNotNull() for t in tkeys])
    joined = renamed.where(held).alias("source").join(
        tgt.where(held).select(*[F.col(f"`{c}`") for c in dict.fromkeys(tkeys + [t for _, t in both])]).alias("target"),
        keys_equal(tkeys, collation=collation, strings=strings))
    if not both:
        return src.sparkSession.createDataFrame([], COUNTED_SCHEMA)
    counts = joined.agg(*[F.count_if(changed([t], collation=collation, strings=strings)).alias(f"n{i}") for i, (_, t) in enumerate(both)])
    rows = F.array(*[F.struct(F.lit(s).alias("column_name"), F.col(f"n{i}").alias("n")) for i, (s, _) in enumerate(both)])
    return counts.select(F.inline(rows)).where("n > 0").select(
        F.lit(pair).alias("pair"), F.lit("value_diff").alias("kind"), "column_name",
        F.lit("matched rows that differ").alias("detail"), "n")


def compare_values(spark: SparkSession, pairs: Sequence[TablePair], *, collation: str | None = None, max_workers: int = 4) -> DataFrame:
    """F4 by value: (pair, kind, column_name, detail, n) of every pair; pairs are compared side by side.

    Type findings count the source values that do not fit, emptiness findings
    have no count.  A pair that fails becomes an ``error`` row.  A pair's
    findings are a few rows a column.
    """
    def one(p: TablePair) -> list[tuple]:
        try:
            s, t = p.source(), p.target()
            types = type_findings(p.name, s, t).select("pair", "kind", "column_name", "detail", F.col("src_unfit").alias("n"))
            found = types.unionByName(key_findings(p.name, s, t, p.source_keys, p.target_keys))
            if all(target_name(k).lower() in {f.name.lower() for f in t.schema.fields} for k in p.source_keys):
                found = found.unionByName(value_findings(p.name, s, t, p.source_keys, collation))
            empty = empty_table_check(p.name, s, p.source_label) + empty_table_check(p.name, t, p.target_label)
            return [tuple(r) for r in found.collect()] + [(f.pair, f.kind, f.column_name, f.detail, None) for f in empty]
        except Exception as e:  # isolate the pair, report, go on
            return [(p.name, "error", None, f"{type(e).__name__}: {e}", None)]

    with ThreadPoolExecutor(max(1, max_workers)) as pool:
        done = list(pool.map(one, pairs))
    return spark.createDataFrame([r for rows in done for r in rows], COUNTED_SCHEMA)
