"""Joins whose keys may be very unevenly spread."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frames measured to hold at most this many bytes are broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it holds more than 1/HOT_KEYS of all rows; hence there are fewer than HOT_KEYS of them.
HOT_KEYS = 4096


def byte_size(frame: DataFrame) -> Column:
    """Aggregate: about how many bytes the rows of a frame of plain columns take in a broadcast."""
    width = F.lit(32)
    for column in frame.columns:
        width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + 16
    return F.coalesce(F.sum(width.cast("long")), F.lit(0))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: str, spread: str) -> DataFrame:
    """Inner join of rows with a lookup that has each key once, and in ``weight`` its number of rows.

    The lookup is measured by a job of its own: a small one is broadcast and the rows stay where they are. Of a larger
    one the keys with most rows are broadcast, as many as fit, and only the rows of the others are exchanged, with
    those of hot keys divided. Both read ``rows``, which should be kept or cheap to read.
    """
    return functools.reduce(DataFrame.unionByName, lookup_parts(rows, lookup, key, weight, spread))


def lookup_parts(rows: DataFrame, lookup: DataFrame, key: str, weight: str, spread: str) -> list[DataFrame]:
    """The frames that :func:`lookup_join` puts together: rows that stay where they are, if any, and exchanged ones, if any."""
    # Quarters of a power of two: at most 256 sizes come back.
    size = F.floor(F.log2(F.greatest(F.col(weight), F.lit(1)).cast("double")) * 4)
    found = lookup.groupBy(size.alias("size")).agg(byte_size(lookup).alias("bytes")).collect()
    held, least = 0, None
    for row in sorted(found, reverse=True):
        held += row["bytes"]
        if held > BROADCAST_BYTES:
            break
        least = row["size"]
    if held <= BROADCAST_BYTES:
        return [rows.join(F.broadcast(lookup.drop(weight)), key)]
    if least is None:
        return [salted_join(rows, lookup.drop(weight), hot_keys(lookup, key, weight), key, spread)]
    common, rare = lookup.where(size >= least), lookup.where(size < least)
    others = rows.join(F.broadcast(common.select(key)), key, "left_anti")
    exchanged = salted_join(others, rare.drop(weight), hot_keys(rare, key, weight), key, spread)
    return [rows.join(F.broadcast(common.drop(weight)), key), exchanged]


def hot_keys(sizes: DataFrame, key: str, weight: str) -> DataFrame:
    """``(key, splits)`` of the hot keys, given one row per key with its number of rows.

    Fewer than ``HOT_KEYS`` rows whatever the data, and at most twice that many splits in all.
    """
    total = sizes.agg(F.sum(weight)).scalar()
    share = F.col(weight) * HOT_KEYS / total
    return sizes.where(F.col(weight) * HOT_KEYS > total).select(key, F.ceil(share).cast("int").alias("splits"))


def salted_join(
    rows: DataFrame, lookup: DataFrame, hot: DataFrame, key: str, spread: str, spread_lookup: str | None = None
) -> DataFrame:
    """Inner equi-join on ``key`` that divides the rows of each hot key over its splits.

    ``spread`` is a column of ``rows`` that varies within a key. The lookup rows of a hot key are repeated once
    per split; all other keys have one split, so nothing changes for them. A lookup that may itself be skewed
    names its own varying column: its rows of a hot key are divided over ``hot.copies``, for each of which the
    other side's rows are repeated. Every pair meets exactly once.
    """
    both = spread_lookup is not None
    # Broadcast is safe: hot_keys() returns fewer than HOT_KEYS rows, two of them together fewer than twice that.
    factors = F.broadcast(hot.select(key, "splits", *(["copies"] if both else [])))
    on = [key, "_salt", "_copy"] if both else [key, "_salt"]

    def part(column: str, of: str) -> Column:
        return F.pmod(F.xxhash64(column), F.coalesce(of, F.lit(1))).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(of, F.lit(1)) - 1))

    left = rows.join(factors, key, "left").withColumn("_salt", part(spread, "splits"))
    right = lookup.join(factors, key, "left").withColumn("_salt", every("splits"))
    if both:
        left = left.withColumn("_copy", every("copies"))
        right = right.withColumn("_copy", part(spread_lookup, "copies"))
    return left.drop("splits", "copies").join(right.drop("splits", "copies"), on).drop("_salt", "_copy")
