"""A blocked Bloom filter in built-in columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a filter at most (8 MB); with more keys it only lets more values through
MOST_WORDS = 1 << 20
_KEYS_PER_WORD = 6
_BITS = 5


def words_for(keys: int) -> int:
    return min(MOST_WORDS, max(1, -(-keys // _KEYS_PER_WORD)))


def _block(key: str, words: int) -> str:
    return f"int(pmod(xxhash64({key}), {words}))"


def _mask(key: str) -> str:
    """SQL of a 64-bit word with up to five bits set, taken from a second hash of the key."""
    h = f"xxhash64({key}, 'bits')"
    return "(" + " | ".join(f"shiftleft(1L, int(shiftrightunsigned({h}, {6 * i}) & 63))" for i in range(_BITS)) + ")"


def bloom_words(keys: DataFrame, column: str, words: int) -> DataFrame:
    """One row with the filter as an array of 64-bit words; each key sets bits in one word only.

    The bits of a word are joined in the tasks first. The array is read as a scalar subquery.
    """
    some = keys.select(F.expr(_block(column, words)).alias("block"), F.expr(_mask(column)).alias("mask"))
    every = keys.sparkSession.range(words).selectExpr("int(id) AS block", "0L AS mask")
    by_word = some.unionByName(every).groupBy("block").agg(F.bit_or("mask").alias("word"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "word")))
    return by_word.agg(F.transform(ordered, lambda x: x.word).alias("words"))


def may_contain(filter_: str, key: str, words: int) -> str:
    """SQL of whether a key may be in the filter: never false for a key that is."""
    return f"(element_at({filter_}, 1 + {_block(key, words)}) & {_mask(key)}) = {_mask(key)}"
