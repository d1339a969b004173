"""MinHash near-duplicates by bottom-k sketches of one hash function.

1. Each document's distinct shingles are hashed to 64 bits.  Equal sets form a
   class; only classes go on.  The ``K`` smallest hashes of a set are its sketch.
2. Inverted lists map each retained value to the classes that retain it.  Two
   sets alike enough share at least ``overlap`` retained values, so if both
   order their values from the rarest to the commonest, the first
   (size - overlap + 1) of each hold a common one: lists of the rarer values
   alone generate all overlaps, and the long lists of common values are not
   read.  For sets no larger than a sketch this is exact; beyond, it fails for
   a pair right at the threshold with a probability of about 1e-6.
3. Candidates of the first round pass if the similarity estimated from the
   sketch of their union is near the threshold; all are confirmed on their full
   sets.
4. In a first round each list gives only pairs with its hub, the class whose
   values are the commonest, as those of a group's original are; the links found
   merge most groups of near copies.
   The second round takes the lists of three or more that still hold several
   components (a list of two is its hub and the other).  Each draws a hub of its
   own from its largest component and pairs it with the classes of the others,
   so that a class left over meets as many members of a large group as it has
   lists, at a cost in proportion to the lists.
   The last round pairs the classes of lists that are still mixed
   across components, each pair once: at the first value of
   its lists that the two have in common.  A pair is made only if the values
   left in both orders suffice for the overlap, and if the classes' parity
   bitmaps allow it: of two sets, every bit that differs stands for a value that
   only one of them has, so too many such bits rule out a link for certain.

Sets are read a second time only for the classes of pairs that are left, to
confirm them: wider bitmaps of theirs go to every pair, whole sets to the pairs
that these leave.  Intermediate tables are removed as soon as their successors
are written.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, release, staged, table, text_of
from tidemark.llm.components import components

K = 48
#: Values that the sketches of two sets share if their similarity is 0.8 or more (5 standard deviations below the mean).
OVERLAP = 24
#: Standard deviations that an estimate may fall below the threshold.
SLACK = 8.0  # less than 17 common values of K turn a pair down: below 1e-11 at a similarity of 0.8 (binomial)


#: Longs of a set's parity bitmap, and of the wider one of sets that are read again.
BITMAP, WIDE = 8, 64


def parity(values: np.ndarray, longs: int = BITMAP) -> np.ndarray:
    """The bitmap of a set: each bit says whether an odd number of values fall on it."""
    odd = np.bincount((values & (64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def shingles(text: str, width: int) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles of a text.

    A-Z are lower-cased; words are runs without ASCII white space.  With fewer
    words than ``width``, the whole sequence is one shingle; without, none.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    width = min(width, len(words))
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(h) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(31)
    return np.unique(out.view(np.int64))


def _pieces(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """The same rows, fewer at a time, since a set takes as much room as its text."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.iloc[at:at + rows].reset_index(drop=True)


def _sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, digest, sketch, bits, row) for each row; row numbers the rows, once they are written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            sets = [shingles(t, width) for t in b["text"]]
            yield pd.DataFrame({
                "id": b["id"], "text_hash": b["text_hash"], "n": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "sketch": [s[:K] for s in sets], "bits": [parity(s) for s in sets]})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"),
                       F.xxhash64(text_of(text_col)).alias("text_hash"))
    found = rows.mapInPandas(run, "id string, text_hash long, n long, digest binary, sketch array<long>, bits array<long>")
    return found.withColumn("id", F.col("id").cast("long")).withColumn("row", F.monotonically_increasing_id())


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set, wide) of the wanted classes, from the text of their first documents; wide is the set's wider bitmap."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            sets = [shingles(t, width) for t in b["text"]]
            same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, b["digest"])]
            sets = [s for s, ok in zip(sets, same) if ok]
            yield pd.DataFrame({"node": b["node"][same], "set": sets, "wide": [parity(s, WIDE) for s in sets]})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    same = texts["id"].eqNullSafe(wanted["first_id"]) & (F.xxhash64(texts["text"]) == wanted["first_hash"])
    rows = join_counted(texts, wanted, same).select("node", "digest", "text")
    return rows.mapInPandas(run, "node long, set array<long>, wide array<long>")


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


#: The bitmap as columns: a join condition over them stays small enough to be compiled.
BITS = [f"b{i}" for i in range(BITMAP)]


def _with_bits(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[F.get("bits", F.lit(i)).alias(b) for i, b in enumerate(BITS)])


def _few_differ(x: str, y: str, percent: int) -> Column:
    """False only for pairs whose bitmaps differ in more bits than sets alike enough can have values of their own."""
    differ = sum((F.bit_count(F.col(f"{x}.b{i}").bitwiseXOR(F.col(f"{y}.b{i}"))) for i in range(1, BITMAP)),
                 F.bit_count(F.col(f"{x}.b0").bitwiseXOR(F.col(f"{y}.b0"))))
    return differ * (100 + percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - percent)


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate from the sketch of the union is near the threshold, and whose bitmaps allow a link."""
    side = _with_bits(classes, "node", "n", "sketch")
    x, y = side.alias("x"), side.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.node")).join(y, (F.col("b") == F.col("y.node")) & _few_differ("x", "y", percent))
    union = F.sort_array(F.array_union("x.sketch", "y.sketch"))
    whole = (F.col("x.n") <= K) & (F.col("y.n") <= K)
    union = F.when(whole, union).otherwise(F.slice(union, 1, K))
    common = F.array_intersect(union, F.array_intersect("x.sketch", "y.sketch"))
    share = F.size(common) / F.size(union)
    least = F.when(whole, percent / 100 - 1e-9).otherwise(percent / 100 - SLACK * math.sqrt(0.16 / K))
    return both.where(share >= least).select("a", "b")


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose wider bitmaps allow a link."""
    side = lambda x: sets.select(F.col("node").alias(x), F.size("set").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}"))
    bits = F.zip_with("wide_a", "wide_b", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int"))
    differ = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .where(differ * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b"))


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are alike enough, written out; only these classes' texts are read again."""
    pairs = staged(pairs, "candidates")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = staged(classes.select("node", "digest", "first_id", "first_hash").join(nodes, "node"), "wanted")
    sets = staged(_full_sets(docs, wanted, width, id_col, text_col), "sets")
    if sets.count() > wanted.count():  # rows repeated whole
        sets = staged(sets.dropDuplicates(["node"]), "sets")
    close = staged(_close(pairs, sets, percent), "close-pairs")
    ends = {x: staged(close.select(F.col(x).alias("node")).distinct(), f"ends-{x}") for x in "ab"}

    def side(x: str) -> DataFrame:
        found = join_counted(sets, ends[x], sets["node"] == ends[x]["node"], "left_semi")
        return found.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))

    shared = F.size(F.array_intersect("set_a", "set_b"))
    total = F.size("set_a") + F.size("set_b")
    links = staged(close.join(side("b"), "b").join(side("a"), "a")
                   .where(shared * 100 >= (total - shared) * percent).select("a", "b"), "confirmed")
    release(pairs, wanted, sets, close, *ends.values())
    return links


def _overlap(n: Column, percent: int) -> Column:
    """Retained values that a set of ``n`` shares with any that is alike enough."""
    exact = F.ceil(n * percent / 100)
    return F.when(n * 100 < K * percent, exact).otherwise(F.least(exact, F.lit(OVERLAP)))


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """(value, node, n, at, shared, weight): the classes in each inverted list of the values in their prefixes.

    A class orders its retained values from the rarest to the commonest; ``at``
    is the place in that order among its ``shared`` values that others retain too;
    ``weight`` adds up how common these are.
    """
    posts = classes.select("node", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    often = staged(posts.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "value-counts")
    kept = (posts.join(often, "value").groupBy("node", "n", "size")
            .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"),  # at most K values a node
                 F.sum((F.log2("df") * 16).cast("long")).alias("weight")))
    alone = F.col("size") - F.size("values")
    take = (F.col("size") - _overlap(F.col("n"), percent) + 1 - alone).cast("int")
    rows = kept.withColumn("take", take).where("take > 0").select(
        "node", "n", F.size("values").alias("shared"), "weight", F.posexplode(F.slice("values.value", F.lit(1), F.col("take"))).alias("at", "value"))
    out = staged(rows, "lists")
    release(often)
    return out


def _mixed(placed: DataFrame, label: str) -> DataFrame:
    """(value): the lists that hold several components."""
    return staged(placed.groupBy("value").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("value"), label)


def _drawn(placed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of the lists of ``placed`` with a hub each, drawn from its largest component (``members``), across components."""
    hubs = staged(placed.groupBy("value").agg(F.max(F.struct("members", F.xxhash64("value", "c").alias("of_c"), "c",
                                                             F.xxhash64("value", "node").alias("of_node"), "node", "n")).alias("hub"))
                  .select("value", F.col("hub.c").alias("ca"), F.col("hub.node").alias("a"), F.col("hub.n").alias("na")), "drawn-hubs")
    pairs = staged(placed.join(hubs, "value").where((F.col("c") != F.col("ca")) & _similar_sizes(F.col("n"), F.col("na"), percent))
                   .select("a", F.col("node").alias("b")).distinct(), "drawn-pairs")
    release(hubs)
    return pairs


def _across(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) across the components c of ``placed`` (value, node, c, at, shared) that the bounds allow."""
    mixed = _mixed(placed, "mixed-lists")
    rows = placed.join(mixed, "value")
    # A node's mixed values in their order go along, so that a pair is made once, at the first value it has in common.
    order = F.sort_array(F.collect_list(F.struct("at", "value")))
    whole = rows.groupBy("node", "c", "shared").agg(order.alias("order")).join(_with_bits(classes, "node", "n"), "node")
    rows = staged(whole.select("node", "c", "n", *BITS, F.col("order.value").alias("all"), "shared", F.explode("order").alias("o"))
                  .select("node", "c", "n", *BITS, "all", F.col("o.value").alias("value"), (F.col("shared") - F.col("o.at")).alias("left")),
                  "mixed-prefixes")
    x, y = rows.alias("x"), rows.alias("y")
    need = F.greatest(_overlap(F.col("x.n"), percent), _overlap(F.col("y.n"), percent))
    return (x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.c") != F.col("y.c"))
                   & _similar_sizes(F.col("x.n"), F.col("y.n"), percent) & (F.col("x.left") >= need) & (F.col("y.left") >= need)
                   & _few_differ("x", "y", percent) & (F.get(F.array_intersect("x.all", "y.all"), F.lit(0)) == F.col("x.value")))
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _links(docs: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Confirmed links between classes that connect every component."""
    confirmed = lambda pairs: _confirmed(pairs, docs, classes, width, percent, id_col, text_col)
    posts = _lists(classes, percent)
    hubs = staged(posts.groupBy("value").agg(F.max(F.struct("weight", "node", "n")).alias("hub"), F.count(F.lit(1)).alias("m"))
                  .where("m > 1").select("value", "m", F.col("hub.node").alias("a"), F.col("hub.n").alias("na")), "hubs")
    stars = staged(posts.join(hubs, "value").where((F.col("node") != F.col("a")) & _similar_sizes(F.col("n"), F.col("na"), percent))
                   .select("a", F.col("node").alias("b")).distinct(), "stars")
    links = confirmed(_promising(stars, classes, percent))
    release(stars)
    merged = staged(components(links), "first-components")
    members = staged(merged.groupBy("component").agg(F.count(F.lit(1)).alias("members")), "members")
    placed = staged(posts.join(hubs.where("m > 2").select("value"), "value").join(merged.join(members, "component"), "node", "left")
                    .select("value", "node", "n", "at", "shared", F.coalesce("component", "node").alias("c"),
                            F.coalesce("members", F.lit(1)).alias("members")), "placed")
    release(posts, hubs, merged, members)
    mixed = _mixed(placed, "mixed-lists")
    rows = staged(placed.join(mixed, "value"), "mixed-placed")
    release(placed, mixed)
    drawn = _drawn(rows, percent)
    links = links.unionByName(confirmed(_promising(drawn, classes, percent)))
    release(drawn)
    merged = staged(components(links), "second-components")
    placed = staged(rows.drop("c", "members", "n").join(merged, "node", "left")
                    .select("value", "node", "at", "shared", F.coalesce("component", "node").alias("c")), "placed")
    release(rows, merged)
    last = confirmed(_across(placed, classes, percent))
    release(placed)
    return links.unionByName(last)


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept and text_hash for every row of ``docs`` (ids are integers).

    Two documents are linked if 100 * |A and B| >= ``percent`` * |A or B| of
    their shingle sets; component_id is the smallest id reachable over links,
    and kept says that the row's id is it.

    Texts that are null, empty or without words have an empty set, are linked
    with nothing and kept.  Rows with equal sets are linked, whatever their
    ids; repeated rows get equal results.  Null ids are passed over when the
    smallest id is sought; a component of null ids only has a null
    component_id, and its rows are kept.  An empty table gives no rows.  Other
    columns are ignored, whatever their names.  Sets are told apart by 128-bit
    digests, shingles by 64-bit hashes.
    """
    rows = staged(_sketches(docs, width, id_col, text_col), "sketches")
    # The class's least row stands for it; its sketch stays where it is, unless there are too many to send the rows' numbers.
    least = (rows.where("n > 0").groupBy("digest")
             .agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash", "row")).alias("first"), F.count(F.lit(1)).alias("copies"))
             .select("first.row", "copies"))
    least = staged(least.withColumnRenamed("row", "node"), "class-rows")
    classes = staged(join_counted(rows, least, rows["row"] == least["node"]).select(
        "node", "digest", "n", "sketch", "bits", "copies", F.col("id").alias("first_id"), F.col("text_hash").alias("first_hash")), "classes")
    release(least)
    links = _links(docs, classes, width, percent, id_col, text_col)
    merged = staged(components(links), "components")
    grouped = merged.join(classes.select("node", "digest", "first_id"), "node")
    least = staged(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "component-ids")
    linked = grouped.join(least, "component").select("digest", "component_id")
    alone = classes.where("copies > 1").join(merged, "node", "left_anti").select("digest", F.col("first_id").alias("component_id"))
    # Classes that aren't here hold a single document without links.
    known = staged(linked.unionByName(alone).withColumn("known", F.lit(True)), "known-components")
    release(classes, links, merged, least)
    out = rows.select("id", "text_hash", "n", "digest").join(known, "digest", "left") \
        .withColumn("component_id", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id; rows repeated whole count once."""
    found = staged(near_duplicates(docs, width=width, percent=percent, id_col=id_col, text_col=text_col), "near-duplicates")
    gone = staged(found.where("not kept").select(F.col(id_col).alias("_gone"), F.col("text_hash").alias("_hash")).distinct(), "gone")
    hashed = F.xxhash64(text_of(text_col))
    left = join_counted(docs, gone, docs[id_col].eqNullSafe(gone["_gone"]) & (hashed == gone["_hash"]), "left_anti")
    twice = staged(found.where("kept").groupBy(F.col(id_col).alias("_twice"), F.col("text_hash").alias("_hash"))
                   .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated")
    if twice.isEmpty():
        return left
    same = left[id_col].eqNullSafe(twice["_twice"]) & (hashed == twice["_hash"])
    return join_counted(left, twice, same, "left_anti").unionByName(
        join_counted(left, twice, same, "left_semi").dropDuplicates([id_col, text_col]))


def op3_bottom_k_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).drop("text_hash")
