"""Sharding by a hierarchical weighted hash tree (native expressions only).

Shards are the leaves of a tree of regions and racks.  A node's weight is the
sum of the weights below it.  A document descends level by level: each child of
the node it has come to makes an exponential draw, ``-ln(u) / weight`` with
``u`` hashed from the id, the level and the child's number, and the least draw
wins, so a child gets documents in proportion to its weight.

A draw depends on nothing but the child's own weight.  Hence a change moves
documents only where weights change: weight that is shifted between two shards
of a rack leaves the rack's weight, and with it every other rack and region,
alone; a subtree that gains weight wins documents from its siblings, and none
of its siblings wins any.

The law ``key`` (one more shard takes documents into itself only) follows when
the new shard opens the topmost branch of its path that has siblings: the
documents that move into that branch find nobody else in it.  That is so for 1
to 3 shards, for whole racks up to one region, and for whole regions beyond
(``one_more_is_alone``), as for the 24 of the registered query.  At other counts
the branch's older shards gain some of what moves into it; ``law`` is then
``tree``, and movement is confined to the new shard's region.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table, text_of

SHARDS_PER_RACK, RACKS_PER_REGION = 4, 3
#: Rows in one numbering bucket: bounds the task that numbers them.
ROWS_PER_BUCKET = 1000


def hash_draw(key: Column, level: str, node: Column | int, weight: Column | float) -> Column:
    """An exponential draw of rate ``weight``, decided by the key and the node."""
    node = node if isinstance(node, Column) else F.lit(node)
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), node, key), 12)
    return -F.ln((bits + 0.5) / float(1 << 52)) / weight


def tree(n_shards: int, weights: Mapping[int, float] | None = None) -> dict[int, dict[int, dict[int, float]]]:
    """region -> rack -> shard -> weight; shards without weight are left out."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    weights = weights or {}
    regions: dict[int, dict[int, dict[int, float]]] = {}
    for shard in range(n_shards):
        rack, weight = shard // SHARDS_PER_RACK, float(weights.get(shard, 1.0))
        if weight < 0:
            raise ValueError(f"shard {shard} has a negative weight")
        if weight > 0:
            regions.setdefault(rack // RACKS_PER_REGION, {}).setdefault(rack, {})[shard] = weight
    if not regions:
        raise ValueError("all weights are zero")
    return regions


def _least(key: Column, level: str, children: Column) -> Column:
    """The child of least draw among ``children``, an array of (node, weight)."""
    return F.array_min(F.transform(children, lambda c: F.struct(
        hash_draw(key, level, c["node"], c["weight"]).alias("draw"), c["node"].alias("node"))))["node"]


def _children(nodes: Mapping[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("node"), F.lit(float(w)).alias("weight")) for n, w in nodes.items()])


def descend(key: Column, n_shards: int, weights: Mapping[int, float] | None = None) -> Column:
    """The shard that the descent reaches, by draws at each level; the tree goes along as literals."""
    regions = tree(n_shards, weights)
    shards = {rack: leaves for racks in regions.values() for rack, leaves in racks.items()}
    racks = {region: {rack: sum(leaves.values()) for rack, leaves in found.items()} for region, found in regions.items()}
    top = {region: sum(found.values()) for region, found in racks.items()}
    below = lambda nodes: F.create_map(*[x for n, found in nodes.items() for x in (F.lit(n), _children(found))])
    region = _least(key, "region", _children(top))
    rack = _least(key, "rack", F.element_at(below(racks), region))
    return _least(key, "shard", F.element_at(below(shards), rack))


def one_more_is_alone(n_shards: int) -> bool:
    """Whether one more shard would take rows into itself only (equal weights, or none zero)."""
    per_region = SHARDS_PER_RACK * RACKS_PER_REGION
    if n_shards >= per_region:
        return n_shards % per_region == 0
    return n_shards < SHARDS_PER_RACK or n_shards % SHARDS_PER_RACK == 0


def place(df: DataFrame, n_shards: int, *, id_col: str = "doc_id", weights: Mapping[int, float] | None = None,
          into: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; a column named ``into`` is replaced."""
    return df.withColumn(into, descend(F.col(id_col), n_shards, weights))


def number_within(df: DataFrame, group: str, order: Sequence[str | Column], into: str = "slot",
                  stretch: Sequence[Column] = ()) -> DataFrame:
    """Gapless numbers from 0 within each ``group``, with no group gathered in one task.

    Rows are dealt over (group, bucket); the bucket sizes become running offsets
    (one row a bucket), and rows are numbered within their bucket in ``order``.
    Buckets are hashed from a row number taken once, in the staged copy, so that
    equal rows spread; or they are the ``stretch`` that a row lies in: columns
    that cut the order into stretches of bounded length, which are then numbered
    one after another, so that the whole group follows the order.
    """
    if stretch:
        rows = staged(df.withColumn("_stretch", F.struct(*stretch)), "numbered")
        rows = rows.withColumn("_bucket", F.col("_stretch"))
    else:
        rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        buckets = max(1, rows.count() // ROWS_PER_BUCKET)
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.col("_row")), F.lit(buckets)))
        order = [*order, "_row"]
    sizes = rows.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (rows.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_bucket") == F.col("_b")))
            .withColumn(into, F.col("_offset") + F.row_number().over(within) - 1)
            .drop("_row", "_bucket", "_g", "_b", "_n", "_offset", "_stretch"))


def shard_documents(docs: DataFrame, n_shards: int = 24, *, id_col: str = "doc_id", text_col: str = "text",
                    weights: Mapping[int, float] | None = None, carry: tuple[str, ...] = (),
                    order: Sequence[str] = (), stretch: Sequence[Column] = ()) -> DataFrame:
    """Place all documents in shards; returns the id, the ``carry`` columns and

    size (UTF-8 bytes plus 8), text_crc32, law ('key', at some shard counts
    'tree': see above), shard, slot (gapless from 0 within the shard) and
    grown_shard (the shard if there were one more; null under the law 'tree').
    Slots follow ``order`` if it is given with a ``stretch`` (see
    ``number_within``); their columns have to be carried.

    Null texts count as empty.  Null ids hash alike and share a shard.  Rows
    with equal ids share a shard; repeated rows get a slot each.  An empty
    table gives no rows.  Other columns are ignored, whatever their names,
    unless carried; a carried column that clashes with a result is refused.
    """
    made = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    clash = {c.lower() for c in carry} & set(made)
    if clash:
        raise ValueError(f"carried columns clash with results: {sorted(clash)}")
    body = text_of(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col), *[F.col(c) for c in carry if c != id_col],
        (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("key" if one_more_is_alone(n_shards) else "tree").alias("law"), descend(F.col(id_col), n_shards, weights).alias("shard"),
        (descend(F.col(id_col), n_shards + 1, weights) if one_more_is_alone(n_shards) else F.lit(None).cast("int")).alias("grown_shard"))
    return number_within(rows, "shard", list(order) or [id_col], stretch=stretch).withColumn("slot", F.col("slot").cast("long"))


def op9_hash_tree_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
