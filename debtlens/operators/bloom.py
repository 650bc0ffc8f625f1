"""A Bloom filter of keys as a small relation, for lists too long to broadcast whole.

The filter is a row per 64-bit word: a key chooses one word and sets up to ``MARKS`` bits in it.
Building it is one aggregation (``bit_or`` per word, combined on the map side), and applying it
a broadcast semi-join inside the scan task: the key's word is looked up and must have all the
key's bits. With ``BITS`` bits per key about one foreign key in 190 passes, while a word for every
four keys takes a fraction of the keys' own size.

A filter never rejects a key that it was built from, so an exact join afterwards makes the result
exact. Words and bits depend on the key alone, so any task, run again or not, agrees on them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16
MARKS = 4
WORD = 64


def words_for(keys: int) -> int:
    """Words of a filter for so many keys."""
    return max(1, -(-keys * BITS // WORD))


def filterable(kind: str) -> bool:
    """Whether keys of this type are equal exactly when their hashes' input is: zeros of two signs
    and collated texts are not."""
    return kind not in ("float", "double") and "collate" not in kind and "<" not in kind


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _marks(key: Column) -> Column:
    """The key's bits, from a hash independent of the one that chooses its word."""
    h = F.xxhash64(F.lit("marks"), key)
    places = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(WORD - 1)).cast("int") for i in range(MARKS)]
    one = F.lit(1).cast("bigint")
    return reduce(lambda a, b: a.bitwiseOR(b), (F.call_function("shiftleft", one, p) for p in places))


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """The filter of a column's non-NULL values, at most ``words`` rows."""
    known = keys.where(F.col(key).isNotNull())
    marked = known.select(_word(F.col(key), words).alias("_word"), _marks(F.col(key)).alias("_bits"))
    return marked.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def may_hold(df: DataFrame, key: str, held: DataFrame, words: int) -> DataFrame:
    """Rows of ``df`` whose key may be one of those that the filter ``held`` was built from."""
    marks = _marks(df[key])
    same = _word(df[key], words) == held["_word"]
    return df.join(F.broadcast(held), same & (held["_bits"].bitwiseAND(marks) == marks), "left_semi")
