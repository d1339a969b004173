"""The other side of every size switch: the shuffled join, many blocks, small flushes give the same results."""

import pytest

from tidemark.llm import common, decontaminate, fingerprints, near_duplicates

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_duplicates_by_shuffled_joins(spark, odd, monkeypatch):
    sent = rows_of(near_duplicates.near_duplicates(odd, width=2))
    kept = rows_of(near_duplicates.drop_near_duplicates(odd, width=2).select("doc_id", "text"))
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    assert rows_of(near_duplicates.near_duplicates(odd, width=2)) == sent
    assert rows_of(near_duplicates.drop_near_duplicates(odd, width=2).select("doc_id", "text")) == kept


def test_leaks_by_many_blocks(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole, left = rows_of(decontaminate.find_leaks(docs, items)), rows_of(decontaminate.without_leaks(docs, items).select("doc_id"))
    one = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda items, i, t: one(items, i, t, 300))
    assert len(list(decontaminate.blocks(items, "item_id", "text"))) > 3
    assert rows_of(decontaminate.find_leaks(docs, items)) == whole
    assert rows_of(decontaminate.without_leaks(docs, items).select("doc_id")) == left


@pytest.mark.parametrize("terms", [-1])
def test_fingerprints_by_a_shuffled_lexicon(spark, docs, monkeypatch, terms):
    sent = rows_of(fingerprints.fingerprint_edits(docs))
    monkeypatch.setattr(fingerprints, "BROADCAST_TERMS", terms)
    assert rows_of(fingerprints.fingerprint_edits(docs)) == sent
