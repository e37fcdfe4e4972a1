"""Retrieval quality: average precision and its mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_REL = ("returned", "corpus")


def average_precision(results: DataFrame, qrels: DataFrame, k: int = 10, n_rel: str = "returned") -> DataFrame:
    """``(query_id, relevant, ap)``: precision at each relevant rank up to ``k``, over the relevant documents.

    ``results`` is ``(query_id, rank, id)``, ``qrels`` is ``(query_id, id, rel)``. "returned" divides by the
    relevant documents among the first ``k``, "corpus" by all judged relevant. A query whose relevant documents
    were not returned has 0; a query without relevant documents is left out.
    """
    if n_rel not in N_REL:
        raise ValueError(f"n_rel must be one of {N_REL}, not {n_rel!r}")
    good = qrels.where("rel > 0").select("query_id", "id").distinct()
    judged = (
        results.where(F.col("rank") <= k)
        .select("query_id", "rank", "id")
        .join(good.withColumn("rel", F.lit(1)), ["query_id", "id"], "left")
        .withColumn("rel", F.coalesce("rel", F.lit(0)))
    )
    # At most k rows per window group.
    so_far = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    precision = F.sum("rel").over(so_far) / F.col("rank") * F.col("rel")
    sums = (
        judged.withColumn("precision", precision)
        .groupBy("query_id")
        .agg(F.sum("precision").alias("total"), F.sum("rel").alias("found"))
    )
    wanted = good.groupBy("query_id").agg(F.count("*").alias("judged"))
    relevant = F.coalesce("found", F.lit(0)) if n_rel == "returned" else F.col("judged")
    return (
        wanted.join(sums, "query_id", "left")
        .withColumn("relevant", relevant)
        .select("query_id", "relevant", F.coalesce(F.try_divide("total", "relevant"), F.lit(0.0)).alias("ap"))
    )


def mean_average_precision(ap: DataFrame) -> DataFrame:
    """One row ``(n_queries, map)`` over the queries of :func:`average_precision`."""
    return ap.agg(F.count("*").alias("n_queries"), F.avg("ap").alias("map"))
