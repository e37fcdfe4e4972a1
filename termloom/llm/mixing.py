"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Every source gets a target number of words. Its weight changes during training as a schedule says; the integral of the
schedule is its cumulative demand. A document that begins after ``c`` words of its source is due when the demand reaches
``c``: the demand function is inverted, which gives the document its position between 0 and 1, and documents are sorted by
position.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.tables import staged, unused, word_count
from termloom.operators.ranking import number_rows

WEIGHTS = (3, 1, 2)
# Relative weight of a source at the start and at the end of training; it changes linearly in between.
SCHEDULES = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
# Rows of one source that one window group is meant to hold.
GROUP = 512


def targets(
    sizes: DataFrame, share: float = 1.5, weights: Sequence[int] = WEIGHTS, cap: int = 2
) -> DataFrame:
    """``(source, source_size, place, target)`` from ``(source, source_size)``.

    Sources are placed by code point, null last, and weigh ``weights`` in turn. Together they share ``share`` times all
    sizes; a target stops at ``cap`` times its source's size, and what is above is shared again by weight among the
    others until no target is above.
    """
    placed = staged(number_rows(sizes, F.col("source").asc_nulls_last(), name="place"), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight)
    total = (placed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, free = -1.0, None
    while True:  # the level rises with every source that is found full
        full = cap * F.col("source_size") <= level * F.col("weight")
        spent, left, rest = placed.agg(
            F.sum(F.when(full, cap * F.col("source_size"))),
            F.sum(F.when(~full, F.col("weight"))),
            F.count(F.when(~full, 1)),
        ).first()
        if not left or rest == free:
            break
        free, level = rest, (total - (spent or 0)) / left
    target = F.least((cap * F.col("source_size")).cast("double"), F.lit(float(level)) * F.col("weight"))
    return placed.select("source", "source_size", "place", F.greatest(target, F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame,
    share: float = 1.5,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    cap: int = 2,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    size: str | None = None,
    ordered: bool = True,
    name: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` with a column ``name``, a struct, and sorted by its ``position`` (unless ``ordered`` is off).

    It has ``size`` (words of the text, or the column that ``size`` names; 0 for null), ``source_size``, ``target``, ``taken`` (words the mix takes,
    repeats counted), ``position`` (when the document is first due, null if it is not taken) and ``placements``, one
    ``(epoch, words, position)`` for each time it is taken. The documents of a source are taken in the order of the MD5
    of their id, up to the target: whole ones, and the first words of the one at the boundary, so the taken words of a
    source add up to its target, rounded down. No document is taken more than ``cap`` times its size. Rows of the
    same id and size may change places; a null id counts as an empty one and a null source as a source of its own. Columns
    of any name are carried along; one called ``name`` is replaced.
    """
    digits = max(0, math.ceil(math.log(max(1, docs.count()) / GROUP, 16)))
    rows = docs.drop(name).select(F.struct("*").alias("row"))
    # A text key, as null sources must meet one another.
    key = F.coalesce(F.concat(F.lit("="), f"row.{source}"), F.lit(""))
    order = F.md5(F.coalesce(F.col(f"row.{id}").cast("string"), F.lit("")))
    words = F.coalesce(F.col(f"row.{size}"), F.lit(0)).cast("long") if size else word_count(f"row.{text}")
    rows = rows.select(
        "row", key.alias("key"), F.col(f"row.{source}").alias("source"), order.alias("order"),
        F.substring(order, 1, digits).alias("part"), words.alias("size"),
    )
    # Sums of parts of each source, and from them where each part begins: no window sees a whole source's documents.
    parts = staged(rows.groupBy("key", "source", "part").agg(F.sum("size").alias("words")), "parts")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("key", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("begins"))
    sources = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), share, weights, cap)
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")
    # Tables of the size of the sources and parts: Spark broadcasts them if their files are small, or joins by exchange.
    found = staged(begins.join(sources.select(named, "source_size", "place", "target"), "key"), "begins")

    inside = Window.partitionBy("key", "part").orderBy("order", f"row.{id}", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("begins") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = rows.join(found, ["key", "part"]).withColumn("offset", offset)
    placements = F.filter(
        F.array(*(_placement(epoch, schedules) for epoch in range(cap))), lambda p: p["words"] > 0
    )
    placed = placed.withColumn("placements", placements)
    taken = F.aggregate("placements", F.lit(0).cast("long"), lambda total, p: total + p["words"])
    position = F.get("placements", F.lit(0))["position"]
    found = F.struct("size", "source_size", "target", taken.alias("taken"), position.alias("position"), "placements")
    mixed = placed.select("row.*", found.alias(name))
    return mixed.orderBy(F.col(name)["position"].asc_nulls_last(), F.col(id)) if ordered else mixed


def _placement(epoch: int, schedules: Sequence[tuple[float, float]]) -> Column:
    size, source_size, target, offset = (F.col(c) for c in ("size", "source_size", "target", "offset"))
    wanted = F.floor("target") - epoch * source_size
    words = F.greatest(F.lit(0).cast("long"), F.least(size, wanted - offset))
    at = due(F.try_divide(epoch * source_size + offset, target), F.col("place"), schedules)
    return F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), at.alias("position"))


def due(share: Column, place: Column, schedules: Sequence[tuple[float, float]]) -> Column:
    """When a source has met ``share`` of its demand: the inverse of the integral of its schedule."""
    kind = place % len(schedules)
    at = None
    for number, (start, end) in enumerate(schedules):
        rise = end - start
        found = share if rise == 0 else (F.sqrt(start * start + rise * (start + end) * share) - start) / rise
        at = F.when(kind == number, found) if at is None else at.when(kind == number, found)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), at))


def taken_rows(mixed: DataFrame, text: str = "text", name: str = "mix") -> DataFrame:
    """One row for each time a document is taken, in training order, without the column ``name``.

    A document of which only the first words are taken keeps these, joined by single spaces.
    """
    at = unused(mixed, "place")
    place, mix_of = F.col(at), F.col(name)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    cut = F.when(place["words"] < mix_of["size"], F.array_join(F.slice(words, 1, place["words"].cast("int")), " "))
    columns = [F.coalesce(cut, F.col(c)).alias(c) if c == text else c for c in mixed.columns if c != name]
    exploded = mixed.withColumn(at, F.explode(mix_of["placements"]))
    return exploded.orderBy(place["position"]).select(*columns)
