"""A Bloom filter of keys as a small table, probed by a join.

The bits lie in words of 64; all bits of a key are in one word, so a probe is
one look-up.  Building is one aggregate (``bit_or`` by word, with map-side
combine), probing a broadcast semi or anti join.  Rows that the filter turns
down certainly have no equal key; of the others a few per cent have none
either.  The filter never grows with the probed side, and its size is known
from the number of keys before it is built.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits a key, bits set for each, and memory of one word in a broadcast (key, value, hash slot).
BITS_PER_KEY, PROBES, WORD_BYTES = 16, 4, 64
WORD, BITS = "__bloom_word", "__bloom_bits"
#: Types whose equal values always hash alike; floats (two zeros) and nested types are left out.
HASHABLE = (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
            T.DecimalType)


def n_words(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // 64))


def bloom_bytes(keys: int) -> int:
    """Memory of the filter of so many keys, as a broadcast table."""
    return n_words(keys) * WORD_BYTES


def hashable(left: T.StructType, right: T.StructType, keys: Sequence[str], collation: str | None = None) -> bool:
    """Whether equal keys of both sides surely have the same hash: same types, compared by bytes."""
    def plain(t: T.DataType) -> bool:
        return isinstance(t, HASHABLE) and not (isinstance(t, T.StringType) and (collation or t != T.StringType()))

    return all(left[k].dataType == right[k].dataType and plain(left[k].dataType) for k in keys)


def _word(keys: Sequence[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _mask(keys: Sequence[Column]) -> Column:
    h = F.xxhash64(F.lit("bits"), *keys)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    return reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(PROBES)])


def bloom_filter(rows: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(word, bits): the filter of the keys of ``rows``; keys with a NULL are left out, they equal nothing."""
    cols = [F.col(k) for k in keys]
    keyed = rows.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]))
    return keyed.groupBy(_word(cols, words).alias(WORD)).agg(F.bit_or(_mask(cols)).alias(BITS))


def split_by_bloom(rows: DataFrame, keys: Sequence[str], bloom: DataFrame, words: int,
                   within: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in the filter, and those whose key surely is not (NULL keys among them).

    ``within``: a condition that every row with a key of the filter meets; it is tested first.
    """
    cols = [F.col(k) for k in keys]
    first = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    if within is not None:
        first = first & within
    mask = _mask(cols)
    hit = (_word(cols, words) == F.col(WORD)) & (F.col(BITS).bitwiseAND(mask) == mask)
    small = F.broadcast(bloom)
    return rows.where(first).join(small, hit, "left_semi"), rows.join(small, first & hit, "left_anti")
