"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear
through knots.  Its integral is the source's weight, which sets the target
(its share of all words).  The cumulative demand of a source at time t is
target * F(t), F being the schedule integrated to t over its whole integral.
The documents of a source stand in hashed order, one epoch after another; the
copy that starts after c words is due at the time when the demand reaches c,
t = F^-1(c / target), a closed form on each linear piece.  Sorting copies by
that time gives the training order of the whole mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, table, text_of

Knots = Sequence[tuple[float, float]]
#: Schedules of the sources in code-point order, repeating: integrals 1, 2 and 3.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 2.0), (0.5, 3.0), (1.0, 4.0)),
)
MAX_REPEATS = 3
ROWS_PER_BUCKET = 4000
HASH_SPAN = 1 << 52


def integral(knots: Knots) -> float:
    if len(knots) < 2 or knots[0][0] != 0.0 or knots[-1][0] != 1.0:
        raise ValueError("a schedule runs from time 0 to time 1")
    if any(b <= a for (a, _), (b, _) in zip(knots, knots[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("knots need rising times and weights of 0 or more")
    return sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))


def due_time(fraction: Column, knots: Knots) -> Column:
    """The time at which the normalised cumulative demand reaches ``fraction``."""
    total, reached, out = integral(knots), 0.0, F.lit(1.0)
    pieces = []
    for (a, u), (b, v) in zip(knots, knots[1:]):
        area = (b - a) * (u + v) / 2
        if area > 0:
            need = F.greatest(fraction * total - reached, F.lit(0.0))
            slope = (v - u) / (b - a)
            root = F.sqrt(F.greatest(F.lit(u * u) + need * (2 * slope), F.lit(0.0)))
            step = F.when(need > 0, need * 2 / (root + u)).otherwise(F.lit(0.0))
            pieces.append((fraction * total < reached + area, F.lit(a) + F.least(step, F.lit(b - a))))
        reached += area
    for inside, at in reversed(pieces):
        out = F.when(inside, at).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of the sources in ``sizes`` (one row a source: _source, source_size).

    The sources share the total by weight; a target stops at ``max_repeats``
    times its source, and the excess is shared again by weight.  The fixed
    point gives every source min(cap, level * weight); the level follows from
    running sums in order of cap / weight.  The windows hold one row a source.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("_source"))) - 1)
    nth = F.array(*[F.lit(float(w)) for w in weights])
    w = ranked.select("_source", "source_size", F.pmod("_rank", F.lit(len(weights))).alias("_kind")) \
        .withColumn("_weight", F.element_at(nth, (F.col("_kind") + 1).cast("int"))) \
        .withColumn("_cap", F.col("source_size") * max_repeats)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.asc_nulls_last("_source"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (w.withColumn("_before", F.coalesce(F.sum("_cap").over(
                 by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_weights", F.sum("_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("_level", (F.sum("source_size").over(whole) - F.col("_before")) / F.col("_weights"))
              .withColumn("_free", F.col("_level") < F.col("_cap") / F.col("_weight"))
              .withColumn("_level", F.max(F.when(F.col("_free"), F.col("_level"))).over(whole)))
    return level.select(
        "_source", "source_size", "_kind",
        F.when(F.col("_level").isNull(), F.col("_cap").cast("double"))
         .otherwise(F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight"))).alias("target"))


def mix(docs: DataFrame, *, schedules: Sequence[Knots] = SCHEDULES, max_repeats: int = MAX_REPEATS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
        whole: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Assign training positions to all documents.

    Returns the id, the ``carry`` columns and, for each row of ``docs``: size
    (words), source_size, target, taken (words the mix takes) and copies, an
    array of (epoch, words, position) with one entry for each time it is read.

    A source's words are taken in hashed order of its documents until they make
    its target, rounded; the last document gives only the words still wanted,
    or with ``whole`` it is taken if more than half of it is wanted, so that no
    copy is cut.

    Null texts and texts without words have size 0 and no copies.  A null
    source is a source of its own, last in order.  Equal rows are separate
    documents; which of them comes first makes no difference to the result.
    Null ids are ordered by their texts.  An empty table gives no rows.  Other
    columns are ignored, whatever their names, unless carried.

    No source is gathered in a task: a source is cut into hashed buckets, whose
    sums give running offsets, and documents add up within their bucket.
    """
    weights = [integral(k) for k in schedules]
    if min(weights) <= 0:
        raise ValueError("every schedule needs a positive integral")
    made = {"size", "source_size", "target", "taken", "copies"}
    if clash := {c.lower() for c in carry} & made:
        raise ValueError(f"carried columns clash with results: {sorted(clash)}")
    buckets = max(1, docs.count() // ROWS_PER_BUCKET)
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(text_of(text_col).cast("binary")))
    draw = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("long")
    rows = docs.select(
        F.col(id_col), *[F.col(c) for c in carry if c != id_col],
        F.coalesce(F.col(source_col), F.lit("")).alias("_s"), F.col(source_col).isNull().alias("_none"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"), draw.alias("_draw"))
    rows = rows.withColumn("_bucket", F.floor(F.col("_draw") * float(buckets) / HASH_SPAN))
    sums = rows.groupBy("_s", "_none", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_s", "_none").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_offset", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    sources = sums.groupBy("_s", "_none").agg(F.sum("_words").alias("source_size")) \
        .withColumn("_source", F.when(~F.col("_none"), F.col("_s")))
    targets = source_targets(sources.select("_source", "source_size"), weights, max_repeats).select(
        F.coalesce("_source", F.lit("")).alias("_s"), F.col("_source").isNull().alias("_none"),
        "source_size", "target", "_kind")
    plan = sums.join(targets, ["_s", "_none"]).drop("_words")
    inside = Window.partitionBy("_s", "_none", "_bucket").orderBy("_draw", id_col, "size")
    quota = F.round("target").cast("long")
    size, room = F.col("size"), F.col("_rest") - F.col("_start")
    last = F.when(room * 2 > size, size).otherwise(0) if whole else F.greatest(F.lit(0), F.least(size, room))
    out = (rows.join(plan, ["_s", "_none", "_bucket"])
           .withColumn("_start", F.col("_offset") + F.coalesce(
               F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("_full", F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size")))
                       .otherwise(0).cast("int"))
           .withColumn("_rest", quota - F.col("_full") * F.col("source_size"))
           .withColumn("_last", last.cast("long"))
           .withColumn("taken", F.col("_full") * size + F.col("_last")))
    times = F.when(size > 0, F.col("_full") + F.when(F.col("_last") > 0, 1).otherwise(0)).otherwise(0)

    def copy(epoch: Column) -> Column:
        fraction = (epoch * F.col("source_size") + F.col("_start")) / F.col("target")
        at = F.lit(1.0)
        for kind, knots in enumerate(schedules):
            at = F.when(F.col("_kind") == kind, due_time(fraction, knots)).otherwise(at)
        return F.struct(epoch.alias("epoch"), F.when(epoch < F.col("_full"), size).otherwise(F.col("_last"))
                        .alias("words"), at.alias("position"))

    epochs = F.slice(F.array(*[F.lit(e) for e in range(max_repeats + 1)]), 1, times.cast("int"))
    return out.select(F.col(id_col), *[F.col(c) for c in carry if c != id_col], "size", "source_size", "target",
                      "taken", F.transform(epochs, copy).alias("copies"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row a copy, range-sorted over the partitions by training position.

    Ties in position (the first documents of sources) may stand in any order.
    """
    one = mixed.withColumn("_copy", F.explode("copies")).select(
        *[c for c in mixed.columns if c != "copies"], "_copy.epoch", "_copy.words", "_copy.position")
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return one.repartitionByRange(n, "position").sortWithinPartitions("position")


def op2_curriculum_mix(spark, sf_dir: str) -> DataFrame:
    """Range-sorted by the position of the first copy; the positions of all copies follow the contract's columns."""
    mixed = mix(table(spark, sf_dir, "documents"))
    at = lambda n: F.try_element_at("copies", F.lit(n))["position"]
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").alias("times"),
                       at(1).alias("first_at"), at(2).alias("second_at"), at(3).alias("third_at"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash splits ties: documents that the mix passes over have no position.
    return out.repartitionByRange(n, "first_at", F.xxhash64("doc_id")).sortWithinPartitions("first_at")


def _position_sql(y: str) -> str:
    """The training position at the share ``y`` of a source's demand, by the source's weight."""
    return f"""case
            when weight = 1 then case when {y} < 1 then case when {y} > 0 then least({y} * 2 / (sqrt(greatest(2.25 - {y} * 2, 0)) + 1.5), 1.0) else 0.0 end else 1.0 end
            when weight = 2 then case when {y} * 2 < 2 then case when {y} > 0 then least({y} * 2 * 2 / (sqrt(4.0) + 2.0), 1.0) else 0.0 end else 1.0 end
            else case when {y} * 3 < 1.25 then case when {y} > 0 then least({y} * 3 * 2 / (sqrt(4.0 + {y} * 3 * 4.0) + 2.0), 0.5) else 0.0 end
                      when {y} * 3 < 3.0 then 0.5 + case when {y} * 3 > 1.25 then least(({y} * 3 - 1.25) * 2 / (sqrt(9.0 + ({y} * 3 - 1.25) * 4.0) + 3.0), 0.5) else 0.0 end
                      else 1.0 end
       end"""


OP2_SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), md5(coalesce(text, ''))) || ':mix'), 1, 13) as bigint) as draw
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, cast(1 + (row_number() over (order by source nulls last) - 1) % 3 as double) as weight,
             3 * source_size as cap from s),
l as (select *, ((select sum(source_size) from s) - coalesce(sum(cap) over (order by cap / weight, source nulls last
                  rows between unbounded preceding and 1 preceding), 0))
                / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
      from w),
t as (select source, source_size, weight, coalesce(least(cast(cap as double),
             (select max(level) from l where level < cap / weight) * weight), cast(cap as double)) as target from l),
p as (select d.*, t.source_size, t.target, t.weight, cast(round(t.target) as bigint) as quota,
             coalesce(sum(size) over (partition by d.source order by draw, doc_id, size
                                      rows between unbounded preceding and 1 preceding), 0) as start
      from d join t on d.source is not distinct from t.source),
q as (select *, case when source_size > 0 then quota // source_size else 0 end as full_epochs from p),
r as (select *, greatest(0, least(size, quota - full_epochs * source_size - start)) as last from q),
f as (select *, start / target as y1, (source_size + start) / target as y2, (2 * source_size + start) / target as y3,
             case when size = 0 then 0 else full_epochs + case when last > 0 then 1 else 0 end end as times from r)
select doc_id, size, source_size, target, cast(full_epochs * size + last as bigint) as taken, cast(times as int) as times,
""" + ",\n".join(f"       case when times >= {n} then {_position_sql(f'y{n}')} end as {name}"
                 for n, name in enumerate(("first_at", "second_at", "third_at"), 1)) + "\nfrom f\n"
