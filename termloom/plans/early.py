"""Exact early termination: the best documents of each query without scoring all that have one of its words.

Every word of a query has a largest score that it can add to any document (MaxScore). A bar for each query, below which no
document can be among its best, comes from scoring the documents of a few buckets in full. The words that together cannot
add more than a part of the bar come late: documents are first scored by the others alone, and only those that can still
reach the bar, raised by then to the nth best of these sums, are looked up for the late ones.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import scoring
from termloom.operators import querying
from termloom.operators.ranking import SCORE_DECIMALS, top_n
from termloom.plans.index import Index, StoredIndex, broadcast_small
from termloom.session import durable

# Postings of the query words from which early termination is worth its jobs; results are the same on either route.
WORTHWHILE = 64_000_000
# One in so many buckets is scored in full for the bars.
SAMPLED = 16
# The part of a bar that the late words may add.
LATE = 0.5
# Room for sums that are taken in another order, and for the rounding of scores that are compared.
ROOM = 1e-9


class Candidates(NamedTuple):
    """``scores(query_id, id, relevance)``, exact, with all of the best; ``pairs(query_id, id)`` that were scored in full."""

    scores: DataFrame
    pairs: DataFrame


def possible(index: Index, solver: str | scoring.Scorer, n: int) -> bool:
    """Whether there are bounds: for a saved index and a named solver, and lists that one window keeps."""
    most = int(index.spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    return isinstance(index, StoredIndex) and isinstance(solver, str) and 0 < n <= most and index.buckets > 1


def best_candidates(index: StoredIndex, terms: DataFrame, solver: str, n: int) -> Candidates:
    """Documents among which the ``n`` best of each query are, with their relevance.

    ``terms`` has ``query_id, term, qtf, idf`` and the term's ``max_tf`` and ``peak``; it must be small enough to broadcast.
    Ties with the bar stay. Words without bounds are never late.
    """
    terms = durable(terms.withColumn("largest", F.coalesce(scoring.largest_score(solver), F.lit(float("inf")))))
    sample = index.some_buckets(list(range(math.ceil(index.buckets / SAMPLED))))
    ranked = top_n(_relevance(sample, terms, solver), n).where(F.col("rank") == n)
    bars = ranked.select("query_id", F.col("relevance").alias("bar"))
    so_far = Window.partitionBy("query_id").orderBy("largest", "term").rowsBetween(Window.unboundedPreceding, 0)
    cut = terms.join(F.broadcast(bars), "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(0.0)))
    cut = durable(cut.withColumn("late", F.sum("largest").over(so_far) <= LATE * F.col("bar")))

    rest = F.coalesce(F.sum(F.when(F.col("late"), F.col("largest"))), F.lit(0.0)) * (1 + ROOM) + 10.0**-SCORE_DECIMALS
    limits = durable(cut.groupBy("query_id").agg(F.max("bar").alias("bar"), rest.alias("rest")))
    reaches = F.col("relevance") >= F.col("bar") * (1 - ROOM) - F.col("rest")
    first = _relevance(index, cut.where("NOT late"), solver)
    near = durable(first.join(F.broadcast(limits), "query_id").where(reaches).select("query_id", "id", "relevance"))
    # What a document has so far is less than its score, so the nth best of that is a bar too.
    raised = top_n(near, n).where(F.col("rank") == n).select("query_id", F.col("relevance").alias("bar"))
    raised = F.broadcast(limits.drop("bar").join(F.broadcast(raised), "query_id"))
    near = durable(near.join(raised, "query_id", "left").where(F.coalesce(reaches, F.lit(True))).select("query_id", "id", "relevance"))

    late = cut.where("late").select("query_id", "term", "qtf", "idf")
    words = index.postings.join(F.broadcast(late.select("term").distinct()), "term", "left_semi")
    held = words.join(broadcast_small(near.select("query_id", "id")), "id").join(F.broadcast(late), ["query_id", "term"])
    rest = querying.term_scores(held, index.avgdl, {"relevance": solver}).select("query_id", "id", "relevance")
    both = near.unionByName(rest).groupBy("query_id", "id").agg(F.sum("relevance").alias("relevance"))
    return Candidates(both.where("relevance <> 0"), near.select("query_id", "id"))


def _relevance(index: Index, terms: DataFrame, solver: str) -> DataFrame:
    matched = querying.matching_postings(index.postings, terms.withColumn("df", F.lit(None)), small=True)
    return querying.relevance(querying.term_scores(matched, index.avgdl, {"score": solver}))
