import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and white texts, equal texts, whole rows repeated, a very long text, a repeated id,
    and columns named like results and internals."""
    import hashlib

    from pyspark.sql import functions as F

    long = " ".join(hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 7] for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog today", "en", "a", 49),
        (2, "The quick brown fox jumps over the lazy dog today", "en", "a", 49),
        (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n ", "fr", "b", 4), (None, "no id here", "en", None, 10),
        (None, "no id here", "en", None, 10), (6, "one", "en", "a", 3), (7, long, "de", "c", len(long)),
        (8, "repeated row text of some words", "en", "c", 31), (8, "repeated row text of some words", "en", "c", 31),
        (9, "same id first text", "en", "a", 18), (9, "same id second text", "en", "a", 19), (10, "Ünïcode ñ ß 漢字 😀 text", "es", "é", 22),
    ]
    frame = spark.createDataFrame(rows, COLUMNS)
    clash = ("score", "size", "id", "n", "term", "bucket", "copy", "position", "component_id", "kept", "shard", "slot", "word",
             "spans", "taken", "copies", "target", "_draw", "blob", "key", "held_out", "start", "section", "field", "h", "node")
    return frame.select("*", *[F.lit("clash").alias(c) for c in clash])
