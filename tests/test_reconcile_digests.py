"""Reconciliation by partition digests gives what the comparison of all keys gives."""

import datetime as dt
import random

import pytest

from tidemark.operators import reconcile as R
from tidemark.plans.jobs import run_check
from tidemark.session import list_folders, shared_dir
from tidemark.spec import JobSpec, SearchColumn, TableRef

SCHEMA = "k string, d timestamp_ntz"


def frames(spark, seed):
    """Sides that agree in most months; keys repeat, move between months, are NULL, differ in case."""
    rng = random.Random(seed)
    rows = [(f"k{rng.randrange(60)}", dt.datetime(2024, 1 + rng.randrange(12), 1 + rng.randrange(28))) for _ in range(200)]
    s, t = list(rows), list(rows)
    rng.shuffle(t)
    for side in (s, t):
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(side))
            side[i] = rng.choice([(side[i][0], dt.datetime(2024, 1 + rng.randrange(12), 3)), (f"new{rng.randrange(3)}", side[i][1]),
                                  (None, side[i][1]), (side[i][0], None), (side[i][0].upper() if side[i][0] else None, side[i][1])])
        if rng.random() < 0.5:
            side.append((f"k{rng.randrange(60)}", dt.datetime(2025, 1, 1)))
    return spark.createDataFrame(s, SCHEMA), spark.createDataFrame(t, SCHEMA)


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_the_comparison_of_all_keys(spark, seed, monkeypatch):
    s, t = frames(spark, seed)
    for keys in (["k"], ["k", "d"]):
        for collation in (None, "UNICODE_CI"):
            want = R.reconcile(s, t, keys, "d", None, collation).first()
            assert R.reconcile_by_partition(s, t, keys, "d", None, collation).first() == want
    monkeypatch.setattr(R, "BROADCAST_KEYS", -1)
    assert R.reconcile_by_partition(s, t, ["k"], "d").first() == R.reconcile(s, t, ["k"], "d").first()


def test_only_months_that_differ_are_compared(spark):
    rows = [(f"k{i}", dt.datetime(2024, 1 + i % 12, 5)) for i in range(240)]
    s = spark.createDataFrame(rows, SCHEMA)
    t = spark.createDataFrame([r for r in rows if r[0] != "k7"], SCHEMA)
    month = R.F.date_trunc("month", "d")
    assert R.differing_partitions(s, ["k"], month, t, ["k"], month) == [dt.datetime(2024, 8, 1)]
    assert R.differing_partitions(s, ["k"], month, s, ["k"], month) == []
    none = s.where("false")
    assert R.reconcile_by_partition(none, none, ["k"], "d").first() == R.reconcile(none, none, ["k"], "d").first()
    assert R.reconcile_by_partition(s, none, ["k"], "d").first() == R.reconcile(s, none, ["k"], "d").first()


def test_checks_by_digests(spark):
    s, t = frames(spark, 3)
    spec = JobSpec(name="DG", source=TableRef(path="/none"), target=TableRef(name="t"), keys=("k",), search_column=SearchColumn("d"))
    before = {f for f in list_folders(spark, shared_dir(spark)) if "/staged-" in f}
    bounds = (dt.datetime(2024, 1, 1), dt.datetime(2025, 6, 1))
    got = [run_check(spark, spec, *bounds, load_id=n, source_df=s, target_df=t, digests=bool(n)) for n in (0, 1)]
    assert (got[0].src_miss, got[0].trg_miss, got[0].min_miss_dttm) == (got[1].src_miss, got[1].trg_miss, got[1].min_miss_dttm)
    assert {f for f in list_folders(spark, shared_dir(spark)) if "/staged-" in f} == before
