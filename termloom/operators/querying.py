"""From query texts to scored documents."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.scoring import SOLVERS, Scorer, scorer
from termloom.functions.text import tokens
from termloom.operators import bloom, skew
from termloom.session import durable

# Queries that go with a posting in one row.
LISTED = 256


def query_terms(queries: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``(query_id, term, qtf)`` from ``(query_id, text)``."""
    words = queries.select("query_id", F.explode(tokens(F.col("text"), drop_empty)).alias("term"))
    return words.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


class QuerySize(NamedTuple):
    queries: int
    terms: int
    small: bool


def measure(terms: DataFrame) -> QuerySize:
    """How many queries and distinct terms there are, and whether they are small enough to broadcast.

    This is a job of its own: nothing is sent to every executor on an estimate.
    """
    row = terms.agg(
        F.count_distinct("query_id").alias("queries"),
        F.count_distinct("term").alias("terms"),
        skew.byte_size(terms).alias("bytes"),
    ).first()
    return QuerySize(row["queries"], row["terms"], row["bytes"] <= skew.BROADCAST_BYTES)


def known_terms(terms: DataFrame, vocab: DataFrame, small: bool, more: tuple[str, ...] = ()) -> DataFrame:
    """Query terms that are in the vocabulary, with its ``df`` and ``idf``; the vocabulary is never broadcast.

    Of a vocabulary that is exchanged, only the words that a filter of the query terms lets pass are. ``more`` names
    further columns to take from it.
    """
    words = vocab.select("term", "df", "idf", *more)
    if small:
        return words.join(F.broadcast(terms), "term")
    words = bloom.passing(words, bloom.filter_of(terms, "term"))
    return skew.salted_join(terms, words, skew.hot_keys(_askers(terms), "term", "askers"), "term", "query_id")


def _askers(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count("*").alias("askers"))


def query_vector(terms: DataFrame, vocab: DataFrame, solver: str = "BM25", small: bool = False) -> DataFrame:
    """``(query_id, term, qtf, q_weight)``: idf per distinct word for BM25, once per occurrence for Basic."""
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {tuple(SOLVERS)}, not {solver!r}")
    weight = F.col("idf") if solver == "BM25" else F.col("qtf") * F.col("idf")
    return known_terms(terms, vocab, small).select("query_id", "term", "qtf", weight.alias("q_weight"))


def matching_postings(postings: DataFrame, known: DataFrame, small: bool) -> DataFrame:
    """``(query_id, id, term, tf, doc_length, idf, qtf)`` of every posting whose term a query holds.

    A small query side is broadcast and the postings stay where they are. Otherwise both sides are exchanged
    by term, with the postings, and the queries, of the commonest terms divided over many tasks. Postings that a
    filter of the query terms rules out are left where they are. A posting meets lists of the queries that ask for
    its term, and goes with them to the other postings of its document; there it becomes a row for each query, so
    that what is added up per document is not exchanged.
    """
    columns = ["query_id", "id", "term", "tf", "doc_length", "idf", "qtf"]
    if small:
        return postings.join(F.broadcast(known.drop("df")), "term").select(*columns)
    sizes = known.groupBy("term").agg(F.first("df").alias("df"))
    lists = durable(_asker_lists(known))
    per_term = lists.groupBy("term").agg(F.count("*").alias("lists"))
    many_lists = skew.hot_keys(per_term, "term", "lists").join(per_term.where("lists > 1"), "term")
    many_lists = many_lists.select("term", F.least("splits", F.col("lists").cast("int")).alias("copies"))
    hot = skew.hot_keys(sizes, "term", "df").join(many_lists, "term", "full")
    wanted = bloom.passing(postings, bloom.filter_of(known, "term"))
    met = skew.salted_join(wanted, lists, hot, "term", "id", "list").repartition("id")
    # Given as an expression: see text.entries().
    pairs = F.inline(F.arrays_zip("query_id", "qtf"))
    return met.select("id", "term", "tf", "doc_length", "idf", pairs).select(*columns)


def _asker_lists(known: DataFrame) -> DataFrame:
    """``(term, list, idf, query_id, qtf)``: the queries of each term in lists of about ``LISTED`` at most, as two arrays."""
    askers = _askers(known)
    rows = skew.salted_join(known, askers, skew.hot_keys(askers, "term", "askers"), "term", "query_id")
    part = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("askers") / LISTED)).alias("list")
    queries = F.collect_list(F.struct("query_id", "qtf")).alias("queries")
    lists = rows.groupBy("term", part).agg(F.first("idf").alias("idf"), queries)
    return lists.select("term", "list", "idf", "queries.query_id", "queries.qtf")


def term_scores(matched: DataFrame, avgdl: Column, solvers: dict[str, str | Scorer]) -> DataFrame:
    """Matched postings with one score column per named solver."""
    inputs = [F.col(name) for name in ("tf", "idf", "qtf", "doc_length")]
    return matched.withColumns({name: scorer(solver)(*inputs, avgdl) for name, solver in solvers.items()})


def relevance(scores: DataFrame, score: str = "score") -> DataFrame:
    """``(query_id, id, relevance)``: summed term scores, without the documents that sum to 0."""
    summed = scores.groupBy("query_id", "id").agg(F.sum(score).alias("relevance"))
    return summed.where("relevance <> 0")
