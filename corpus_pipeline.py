"""From documents to sharded training data, in five stages.

1. ``quality``: documents that the boosted trees reject go.
2. ``near_duplicates``: of each group linked by five-word shingles (similarity
   0.8 or more), the document of the smallest id stays.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``mix``: each source gives whole documents up to its target, again from the
   start where the target is larger than the source; one row a copy, in
   training order.
5. ``shard``: every copy gets a shard and a slot in it; slots follow the
   training order.

Each stage takes what its predecessor kept, written and read again.  All but
the last return the columns of their input, extra ones too.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, near_duplicates, quality, shards
from tidemark.llm.common import staged, table

N_SHARDS = 24


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labels outside the held-out fold, by the texts of ``docs``.

    Null and empty texts are scored like others; repeated rows fare alike; all
    columns go through as they are, whatever their names.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*docs.columns).alias("_document"), "text")
    scored = quality.with_quality(packed, model, into="_quality_score")
    return scored.where(F.col("_quality_score") >= quality.REJECT_BELOW).select("_document.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group; documents without words are in no group, rows repeated whole count once."""
    return near_duplicates.drop_near_duplicates(docs, width=5, percent=80).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts hold no item and stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a copy, sorted by training position over the files that are written; documents without words are in no mix."""
    packed = docs.select(F.struct(*docs.columns).alias("_document"), "doc_id", "text", "source")
    mixed = mixing.mix(packed, whole=True, carry=("_document",))
    return mixing.training_order(mixed).select("_document.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and shard and slot (columns of ``docs`` by these names are replaced).

    Slots follow the order in which the rows of ``docs`` were written: by the
    number of the file and the place in it (rows that no file holds, by id).
    """
    columns = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    document = F.struct(*[F.col(c) for c in columns]).alias("_document")
    try:
        packed = docs.select(document, "doc_id", "text", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("_file"),
                             F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:
        done = shards.shard_documents(docs.select(document, "doc_id", "text"), N_SHARDS, carry=("_document",))
    else:
        stretch = (F.col("_file"), F.floor(F.col("_at") / shards.ROWS_PER_BUCKET))
        done = shards.shard_documents(packed, N_SHARDS, carry=("_document", "_file", "_at"), order=("_at",), stretch=stretch)
    return done.select("_document.*", "shard", "slot")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
    ("shard", shard),
]

# Classifier, sketches and edit distances have no SQL; tests/llm holds the run against a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
