"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import drop_path, fresh_path

# A word is a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive a lost executor, and gives later
    joins a plain scan (so that adaptive execution can split a hot key).
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Remove the folders of staged frames that nothing will read again (their successors are written)."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            drop_path(df.sparkSession, folder)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(column: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def held_out(column: str, n: int) -> Column:
    """True for ids whose remainder is 0; a null id is never held out."""
    return F.coalesce(id_remainder(column, n) == 0, F.lit(False))


def one_label(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label 0/1): one row for each labelled id.

    Null ids and null labels are dropped; an id labelled more than once gets
    the most frequent label, 1 on a tie.
    """
    return (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y"))
            .where("_id is not null and _y is not null")
            .groupBy("_id").agg(F.when(F.avg("_y") >= 0.5, 1).otherwise(0).alias("_label")))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, *, rows: int, folds: int = 5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _text, _label) of about ``rows`` labelled documents outside the held-out fold.

    The sample is the ids whose hash lies below ``rows`` / (number of labelled
    ids), or all of them if there are fewer; the texts come by one scan of the
    documents, joined with the sampled ids, whose number ``rows`` bounds.  Of an
    id that stands in several rows one text counts, that of least hash.
    """
    known = one_label(labels, label, id_col).where(~held_out("_id", folds))
    n = known.count()
    if n > rows:
        draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col("_id")), 11) / float(1 << 53)
        known = known.where(draw < rows / n)
    known = staged(known, "labelled-sample")
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    found = texts.join(F.broadcast(known), "_id")
    return found.groupBy("_id", "_label").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text")) \
        .select("_id", "_text", "_label")


#: Rows of a join side that may be broadcast; the side is counted first.
BROADCAST_ROWS = 500_000


def join_counted(big: DataFrame, small: DataFrame, condition, how: str = "inner") -> DataFrame:
    """Join with a staged side of narrow rows: broadcast if its count allows, else shuffled.

    Shuffled, the small side is the one hashed, so that the big side's texts
    are dealt out once and not sorted.
    """
    hint = "broadcast" if small.count() <= BROADCAST_ROWS else "shuffle_hash"
    return big.join(small.hint(hint), condition, how)
