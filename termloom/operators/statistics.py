"""Corpus and term statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import analysis, doc_length, entries, tokens

AVGDL_MODES = ("floor", "exact")


def documents(corpus: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``(id, title, url, doc_length)``."""
    return corpus.select("id", "title", "url", doc_length(tokens(F.col("text"), drop_empty)).alias("doc_length"))


def analysed(corpus: DataFrame, drop_empty: bool = False, only: list[str] | None = None) -> DataFrame:
    """``(id, title, url, doc_length, terms)``: whole documents with the counts of their terms, or of ``only`` some.

    Keep this somewhere before using it twice, or the texts are analysed twice.
    """
    described = corpus.select("id", "title", "url", analysis(F.col("text"), drop_empty, only).alias("a"))
    return described.select("id", "title", "url", "a.doc_length", "a.terms")


def term_frequency(corpus: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``(id, term, tf, doc_length)``, one row per document and distinct term; no exchange."""
    return corpus.select("id", F.inline(entries(F.col("text"), drop_empty)))


def distinct_terms(corpus: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``(id, term)``: each term of a document once; no exchange."""
    return corpus.select("id", F.explode(F.array_distinct(tokens(F.col("text"), drop_empty))).alias("term"))


def document_frequency(pairs: DataFrame) -> DataFrame:
    """``(term, df)`` from rows that are distinct per document and term.

    The partial count runs before the exchange, so the commonest word costs one row per task.
    """
    return pairs.groupBy("term").agg(F.count("*").alias("df"))


def average_length(total_tokens: Column, n_docs: Column, mode: str = "floor") -> Column:
    """Mean document length, rounded down unless ``mode`` is "exact"; 0 for an empty corpus."""
    if mode not in AVGDL_MODES:
        raise ValueError(f"avgdl must be one of {AVGDL_MODES}, not {mode!r}")
    mean = F.try_divide((total_tokens - total_tokens % F.nullif(n_docs, F.lit(0))), n_docs)
    if mode == "exact":
        mean = F.try_divide(total_tokens, n_docs)
    return F.coalesce(mean, F.lit(0.0))


def corpus_stats(docs: DataFrame, avgdl: str = "floor") -> DataFrame:
    """One row ``(n_docs, total_tokens, avgdl)``; documents without tokens count."""
    totals = docs.agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum("doc_length"), F.lit(0)).cast("long").alias("total_tokens")
    )
    return totals.withColumn("avgdl", average_length(F.col("total_tokens"), F.col("n_docs"), avgdl))
