"""Semi-join reduction: a filter of bounded size that lets all rows with wanted keys pass, and few others."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The filter is a table of 64-bit words: so many for each key, and this many (32 bytes each in a broadcast) at most.
WORDS_PER_KEY = 0.25
MOST_WORDS = 1 << 21


class KeyFilter(NamedTuple):
    """``bits(_word, _bits)``: the set bits of each word that has any; ``words``, a power of two, is how many there are."""

    key: str
    bits: DataFrame
    words: int


def _place(key: str, words: int) -> tuple[Column, Column]:
    """The word of a key, and the two bits it has there."""
    hashed = F.xxhash64(key)
    bit = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, by).bitwiseAND(63).cast("int")) for by in (40, 50)]
    return hashed.bitwiseAND(F.lit(words - 1)), bit[0].bitwiseOR(bit[1])


def filter_of(rows: DataFrame, key: str) -> KeyFilter:
    """A filter of the keys of ``rows``, which are counted by a job of their own."""
    n = rows.agg(F.approx_count_distinct(key)).first()[0]
    words = min(MOST_WORDS, 1 << max(0, math.ceil(math.log2(max(1, n * WORDS_PER_KEY)))))
    word, bits = _place(key, words)
    table = rows.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return KeyFilter(key, table, words)


def passing(rows: DataFrame, wanted: KeyFilter) -> DataFrame:
    """The rows whose key may be wanted: all that are, and a few in a hundred of the others while the filter is not full."""
    columns = rows.columns
    word, bits = _place(wanted.key, wanted.words)
    # At most MOST_WORDS rows are broadcast. A word is there once, so no row is repeated.
    met = rows.withColumn("_word", word).withColumn("_own", bits).join(F.broadcast(wanted.bits), "_word")
    return met.where(F.col("_own").bitwiseAND(F.col("_bits")) == F.col("_own")).select(*columns)
