"""Global row numbers and top-n without a task that sees everything."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.skew import hot_keys, salted_join
from termloom.session import durable

# Scores that agree to this many decimals rank by id, so the order of a floating-point sum cannot swap them.
SCORE_DECIMALS = 9

# Tasks whose best rows one task of a query takes in; those of more are ranked in groups first.
ONE_LEVEL = 1024


def number_rows(frame: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Dense row numbers from 0 in a global order that has no ties.

    Rows are range-partitioned and sorted, numbered within their partition, and shifted by the sizes of the
    partitions before. The numbered rows are checkpointed, so the shift and the rows see the same partitions.
    """
    numbered = durable(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
    )
    # The mark holds the partition number in its upper 31 bits and the row's place in the lower 33.
    placed = numbered.withColumn("_part", F.shiftright("_mark", 33)).withColumn(
        "_place", F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per shuffle partition: a bounded window, and a bounded broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.col("_place"))
        .drop("_mark", "_part", "_place", "_shift")
    )


def top_n(
    scored: DataFrame, n: int, per: tuple[str, ...] = ("query_id",), single: bool = False, tasks: int = 1
) -> DataFrame:
    """The ``n`` best rows of each ``per`` by relevance, then id, with ``rank`` from 1.

    ``single`` promises that all rows have the same ``per``. ``tasks`` is how many tasks they come from: the best of
    very many are first ranked in groups of tasks, so that no task gets more than ``n`` rows from the square root of them.
    """
    order = [F.round("relevance", SCORE_DECIMALS).desc(), F.col("id")]
    threshold = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        if single:
            # Every task keeps its own best n in a heap, without sorting its rows.
            scored = scored.orderBy(*order).limit(n)
        elif tasks > ONE_LEVEL:
            group = F.spark_partition_id() % math.ceil(math.sqrt(tasks))
            grouped = scored.withColumn("_group", group)
            within = Window.partitionBy(*per, "_group").orderBy(*order)
            scored = grouped.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= n).drop("_group", "rank")
        # Every task keeps its own best n before the exchange.
        ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
        return ranked.where(F.col("rank") <= n)
    # A long result list is numbered by a distributed sort instead of one window task per query.
    numbered = number_rows(scored, *per, *order).withColumn("_list", F.struct(*per))
    first = numbered.groupBy("_list").agg(F.min("row_index").alias("_first"), F.count("*").alias("_matches"))
    hot = hot_keys(first, "_list", "_matches")
    place = F.col("row_index") - F.col("_first")
    best = salted_join(numbered, first, hot, "_list", "id").where(place < n)
    return best.withColumn("rank", (place + 1).cast("int")).drop("row_index", "_list", "_first", "_matches")
