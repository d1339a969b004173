"""Document fingerprints by I-Match with randomised lexicon subsets (native expressions only).

The lexicon holds the terms whose document frequency lies in a band (the band
of inverse document frequency, seen from the other side).  A text keeps its
distinct terms that are in the lexicon, sorted; hashing them whole gives the
classic I-Match value, and hashing what each of several random subsets of the
lexicon leaves of them gives values that survive edits: a subset keeps its
value if none of the terms that changed is in it.  The likeness of two
fingerprints is the share of subsets that agree, among those in which either
text has a term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table, text_of

#: Document frequencies of lexicon terms, as shares of all documents.  The lexicon has at most
#: (distinct terms a document) / RAREST terms, however many documents there are.
RAREST, COMMONEST = 1 / 2000, 1 / 5
#: Random subsets of the lexicon: the terms whose hash leaves a set remainder modulo each of these primes.  A subset
#: of density 1/p tells texts of about p lexicon terms apart best, so small texts are judged by the denser ones.
PRIMES = (7, 29, 61, 113, 127, 239, 251, 257, 263, 499, 503, 509, 521, 1009, 1013, 1019, 1021)
#: Terms of a lexicon that is broadcast; a larger one is joined by a shuffle.
BROADCAST_TERMS = 2_000_000
#: Documents in a bucket of the order by id, as long as MOST_BUCKETS allows (up to 131 million documents; beyond, the
#: buckets grow, slowly enough for the sort that orders one, which spills).  MOST_BOUNDS ids part the buckets, in
#: chunks for a quick search; stretches between them are divided evenly.
ROWS_PER_BUCKET, MOST_BUCKETS, MOST_BOUNDS, CHUNK = 500, 262_144, 16_384, 128


def term_hashes(text: Column) -> Column:
    """The distinct lower-cased terms of a text, hashed."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """(term): the hashes of the terms of ``texts`` (one column, text) within the band, written out."""
    n = texts.count()
    counts = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return staged(counts.where(f"df >= {max(2, rarest * n)} and df <= {max(2, commonest * n)}").select("term"), "lexicon")


def values(terms: Column, whole: Column) -> Column:
    """The hash of the sorted terms in each subset, the first of all of them; empty strings for empty subsets.

    Without a term in the lexicon, the first value is the hash of all terms.
    """
    def hashed(part: Column) -> Column:
        return F.when(F.size(part) > 0, F.lower(F.lpad(F.hex(F.shiftrightunsigned(F.xxhash64(part), 32)), 8, "0"))).otherwise("")

    def member(prime: int):
        return lambda t: F.pmod(t, F.lit(prime)) == prime // 2

    subsets = [hashed(F.filter(terms, member(p))) for p in PRIMES]
    return F.array(F.when(F.size(terms) > 0, hashed(terms)).otherwise(whole), *subsets)


def likeness(a: Column, b: Column) -> Column:
    """The share of subsets that agree, of those in which either has a term; 1 if neither has any."""
    pairs = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: (p["a"] != "") | (p["b"] != ""))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(F.size(pairs) == 0, F.lit(1.0)).otherwise(same / F.greatest(F.size(pairs), F.lit(1)))


def _bucket(key: Column, h: Column, bounds: Sequence[int], ends: tuple[int, int], split: int, beyond: Column) -> Column:
    """The bucket of a row in falling order of (key, h); null keys go ``beyond``.

    Each stretch between two of the falling ``bounds`` makes ``split`` buckets
    of equal width.  A key that stands several times among the bounds is that
    much more frequent, and its rows are split by hash.
    """
    chunks = [list(bounds[i:i + CHUNK]) for i in range(0, len(bounds), CHUNK)]
    if not chunks:
        return F.when(key.isNotNull(), F.lit(0)).otherwise(beyond)
    lasts = F.array(*[F.lit(c[-1]) for c in chunks])
    all_chunks = F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunks])

    def count(test) -> Column:
        full = F.size(F.filter(lasts, test))
        return full * CHUNK + F.size(F.filter(F.coalesce(F.get(all_chunks, full), F.array().cast("array<bigint>")), test))

    above = count(lambda b: b > key)
    equal = count(lambda b: b >= key) - above
    inner = F.lit(0)
    if split > 1:
        edges = F.array(*[F.lit(e).cast("double") for e in (ends[1], *bounds, ends[0])])
        upper, lower = F.get(edges, above), F.get(edges, above + 1)
        part = (upper - key.cast("double")) / F.greatest(upper - lower, F.lit(1.0))
        inner = F.greatest(F.lit(0), F.least(F.lit(split - 1), F.floor(part * split)))
    by_hash = split + F.floor((0.5 - h / 2.0 ** 64) * (2 * equal - 1) * split)
    place = F.when(equal == 0, inner).when(equal == 1, F.lit(split - 1)).otherwise(by_hash)
    return F.when(key.isNotNull(), above.cast("long") * 2 * split + place).otherwise(beyond)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Window]:
    """The rows (id, text, h, bucket, copy) in buckets of falling id, and the window over them.

    Each bucket ends with a copy of the first row of the next one (the last
    bucket's is the first row of all), marked ``copy``: so each row finds its
    successor within its bucket, and buckets are the only exchange of texts.
    Rows of one id are split by text; only rows equal in both stay together.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    n = docs.count()
    want = min(MOST_BUCKETS, max(1, n // ROWS_PER_BUCKET))
    cuts = min(want, MOST_BOUNDS)
    bounds: list[int] = []
    ends = (0, 0)
    if cuts > 1:
        found = rows.agg(F.percentile_approx("id", [i / cuts for i in range(1, cuts)], max(10_000, 4 * cuts)).alias("b"),
                         F.min("id").alias("lo"), F.max("id").alias("hi")).first()
        if found["b"]:
            bounds, ends = sorted(found["b"], reverse=True), (found["lo"], found["hi"])
    split = -(-want // cuts)
    beyond = (2 * len(bounds) + 2) * split + F.pmod("h", F.lit(want))
    rows = rows.withColumn("bucket", _bucket(F.col("id"), F.col("h"), bounds, ends, split, beyond).cast("long"))
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("id", "h")).alias("first"))  # one row a bucket
    ring = Window.orderBy("bucket")
    last = F.max("bucket").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = staged(firsts.select(F.coalesce(F.lag("bucket").over(ring), last).alias("goes_to"), F.col("first.id").alias("fid"),
                                  F.col("first.h").alias("fh")), "bucket-firsts")
    copies = (rows.join(F.broadcast(firsts), rows["id"].eqNullSafe(firsts["fid"]) & (rows["h"] == firsts["fh"]))
              .groupBy("goes_to").agg(F.first("id").alias("id"), F.first("text").alias("text"), F.first("h").alias("h"))
              .select("id", "text", "h", F.col("goes_to").alias("bucket"), F.lit(1).alias("copy")))
    order = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("id"), F.desc("h"))
    return rows.withColumn("copy", F.lit(0)).unionByName(copies), order


def fingerprint_edits(docs: DataFrame, *, rarest: float = RAREST, commonest: float = COMMONEST, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many, or all, of the next document in falling order of id (after
    the last, the first).  Returns the id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    Null texts count as empty; texts without terms have equal fingerprints, of
    likeness 1.  Texts without a term in the lexicon are told apart by all
    their terms.  Null ids come last in order, and rows of equal id stand in
    an order by text; equal rows in any order.  A single row follows
    itself.  An empty table gives no rows.  Other columns are ignored,
    whatever their names.
    """
    known = lexicon(docs.select(text_of(text_col).alias("text")), rarest, commonest)
    hint = "broadcast" if known.count() <= BROADCAST_TERMS else "shuffle_hash"
    rows, order = in_order(docs, id_col, text_col)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring(F.col("after"), F.lit(1), half))
    rows = (rows.withColumn("after", F.coalesce(F.lead("text").over(order), F.lit("")))
            .withColumn("nth", F.row_number().over(order))
            .select("bucket", "nth", "copy", "id", n.cast("long").alias("n_chars"), F.col("text"), edited.alias("edited"))
            .select("bucket", "nth", "copy", "id", "n_chars", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
                    term_hashes(F.col("text")).alias("own"), term_hashes(F.col("edited")).alias("new")))

    def all_terms(terms: Column) -> Column:
        return F.when(F.size(terms) > 0, F.lower(F.lpad(F.hex(F.shiftrightunsigned(F.xxhash64(F.sort_array(terms)), 32)), 8, "0"))).otherwise("")

    # The columns of the whole text travel on one row a document, apart from those of its terms, which stay narrow.
    whole = F.struct("copy", "id", "n_chars", "sha", all_terms(F.col("own")).alias("own"), all_terms(F.col("new")).alias("new"))
    rows = rows.select("bucket", "nth", "own", "new", whole.alias("whole"))
    nothing = F.lit(None).cast(rows.schema["whole"].dataType)

    def listed(terms: str, which: int) -> Column:
        return F.transform(terms, lambda t: F.struct(F.lit(which).alias("which"), t.alias("term"), nothing.alias("whole")))

    document = F.struct(F.lit(-1).alias("which"), F.xxhash64("bucket", "nth").alias("term"), F.col("whole"))
    terms = (rows.select("bucket", "nth", F.concat(F.array(document), listed("own", 0), listed("new", 1)).alias("listed"))
             .select("bucket", "nth", F.explode("listed").alias("t"))
             .select("bucket", "nth", "t.which", "t.term", "t.whole"))
    flagged = (terms.join(known.withColumn("in_band", F.lit(True)).hint(hint), "term", "left")
               .where(F.col("in_band") | (F.col("which") == -1)))
    pick = lambda i: F.sort_array(F.collect_list(F.when(F.col("which") == i, F.col("term"))))
    kept = (flagged.groupBy("bucket", "nth")
            .agg(F.first("whole", ignorenulls=True).alias("whole"), pick(0).alias("own_terms"), pick(1).alias("new_terms"))
            .select("bucket", "nth", "whole.*", "own_terms", "new_terms"))
    made = kept.select("bucket", "nth", "copy", "id", "n_chars", "sha", values(F.col("own_terms"), F.col("own")).alias("f"),
                       values(F.col("new_terms"), F.col("new")).alias("e"))
    following = F.lead("f").over(Window.partitionBy("bucket").orderBy("nth"))
    return (made.withColumn("next", following).where("copy = 0")
            .select(F.col("id").alias(id_col), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
                    F.array_join("f", "-").alias("fingerprint"), F.array_join("e", "-").alias("edited_fingerprint"),
                    likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("next")).alias("near_next")))


def op8_i_match_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
