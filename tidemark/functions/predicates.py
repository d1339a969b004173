"""Join and change predicates (B9, merge ON condition)."""

from __future__ import annotations

from functools import reduce
from typing import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(name: str, collation: str | None, strings: Collection[str]) -> Column:
    col = F.col(name)
    return F.collate(col, collation) if collation and name.split(".")[-1] in strings else col


def changed(columns: Sequence[str], target: str = "target", source: str = "source",
            collation: str | None = None, strings: Collection[str] = ()) -> Column:
    """True when any check column differs, NULL-safe.

    ``NOT (t <=> s)`` is the three-way test (t NULL and s not, t not NULL and
    s NULL, t != s) in one expression.  No check columns means every match is
    an update (D2).
    """
    if not columns:
        return F.lit(True)
    tests = [~_c(f"{target}.{c}", collation, strings).eqNullSafe(_c(f"{source}.{c}", collation, strings))
             for c in columns]
    return reduce(lambda a, b: a | b, tests)


def keys_equal(keys: Sequence[str], target: str = "target", source: str = "source",
               source_keys: Sequence[str] | None = None, collation: str | None = None,
               strings: Collection[str] = ()) -> Column:
    """Plain ``=`` on every key: a NULL key never matches (it inserts).

    With ``collation``, string keys compare under it (Spark hashes and sorts
    on the collation key, so the join still partitions on the key).
    """
    source_keys = source_keys or keys
    conds = [_c(f"{target}.{t}", collation, strings) == _c(f"{source}.{s}", collation, strings)
             for t, s in zip(keys, source_keys)]
    return reduce(lambda a, b: a & b, conds)
