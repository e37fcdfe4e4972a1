"""Ranked retrieval for one query or a table of queries."""

from __future__ import annotations

import functools
import operator
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.scoring import SOLVERS, Scorer, scorer
from termloom.functions.text import tokens
from termloom.operators import querying
from termloom.operators.evaluation import average_precision, mean_average_precision
from termloom.operators.ranking import SCORE_DECIMALS, top_n
from termloom.plans.early import ROOM, WORTHWHILE, best_candidates, possible
from termloom.plans.index import PUSHED_VALUES, Index
from termloom.session import durable, published, stored

RESULT_COLUMNS = ("query_id", "rank", "id", "title", "url", "relevance")
# What the vocabulary of a saved index has for early termination.
BOUNDS = ("max_tf", "peak")
# Groups of documents for each of the best n, of which the best give a bar; and the longest lists that have bars.
GROUPS = 8
MOST_BARRED = 1000


def check_n(n: int) -> None:
    if isinstance(n, bool) or not isinstance(n, int) or not 0 <= n < 2**31:
        raise ValueError(f"n must be a whole number of at least 0 and below 2**31, not {n!r}")


def search(
    index: Index, text: str, n: int, solver: str | Scorer = "BM25", early: bool | None = None
) -> DataFrame:
    """The ``n`` most relevant documents for one text: ``(rank, id, title, url, relevance)``, best first.

    ``early`` chooses or refuses early termination (:mod:`termloom.plans.early`) where an index has bounds; by default
    the number of postings of the words decides. Results are the same.
    """
    check_n(n)
    scorer(solver)
    if not isinstance(text, str):
        raise ValueError(f"the query must be a text, not {text!r}")
    spark = index.spark
    # The words of the text itself, read back so that they can be pushed into the scans.
    words = spark.range(1).select(tokens(F.lit(text), index.drop_empty).alias("w")).first()["w"]
    counts = [(0, word, count) for word, count in Counter(words).items()]
    terms = spark.createDataFrame(counts, "query_id bigint, term string, qtf bigint")
    narrow = index.restricted([word for _, word, _ in counts])
    if _ends_early(narrow, terms, True, solver, n, early):
        known = querying.known_terms(terms, narrow.vocab, small=True, more=BOUNDS)
        scored = best_candidates(narrow, known, solver, n).scores
    else:
        known = querying.known_terms(terms, narrow.vocab, small=True)
        matched = querying.matching_postings(narrow.postings, known, small=True)
        scored = querying.relevance(querying.term_scores(matched, narrow.avgdl, {"score": solver}))
    ranked = top_n(scored, n, single=True)
    # Where ids repeat, a rank has a row for each document of its id; none is cut off.
    return index.with_documents(ranked, at_most=n).select(*RESULT_COLUMNS[1:]).orderBy("rank")


def _ends_early(
    index: Index, terms: DataFrame, small: bool, solver: str | Scorer, n: int, early: bool | None
) -> bool:
    if early is False or not small or not possible(index, solver, n):
        return False
    if early:
        return True
    asked = terms.groupBy("term").agg(F.count("*").alias("askers"))
    total = index.vocab.join(F.broadcast(asked), "term").agg(F.sum(F.col("df") * F.col("askers"))).first()[0]
    return (total or 0) >= WORTHWHILE


def search_batch(
    index: Index,
    queries: DataFrame,
    n: int,
    solver: str | Scorer = "BM25",
    broadcast: bool | None = None,
    early: bool | None = None,
) -> DataFrame:
    """The ``n`` most relevant documents for each ``(query_id, text)``, as one job.

    ``early`` is as for :func:`search`.

    The query words are measured first: a side that fits is broadcast, a larger one is joined by exchange.
    ``broadcast=False`` takes the exchange whatever the size. Query words are counted once and kept.
    """
    check_n(n)
    scorer(solver)
    terms = durable(querying.query_terms(queries, index.drop_empty))
    size = querying.measure(terms)
    if broadcast is not None:
        size = size._replace(small=broadcast and size.small)
    if _ends_early(index, terms, size.small, solver, n, early):
        known = querying.known_terms(terms, index.vocab, small=True, more=BOUNDS)
        scored = best_candidates(index, known, solver, n).scores
    else:
        scored = querying.relevance(_term_scores(index, terms, size, {"score": solver}))
    ranked = top_n(scored, n, tasks=getattr(index, "buckets", 1))
    return index.with_documents(ranked, at_most=n * size.queries).select(*RESULT_COLUMNS)


def _term_scores(
    index: Index, terms: DataFrame, size: querying.QuerySize, solvers: dict[str, str | Scorer]
) -> DataFrame:
    if size.terms <= PUSHED_VALUES:
        index = index.restricted([row["term"] for row in terms.select("term").distinct().collect()])
    else:
        index = index.once()
    known = querying.known_terms(terms, index.vocab, size.small)
    if not size.small:
        known = durable(known)  # it is read for the hot terms, their sizes and the join
    return querying.term_scores(querying.matching_postings(index.postings, known, size.small), index.avgdl, solvers)


def result_listing(results: DataFrame) -> DataFrame:
    """``(num, title, relevance)`` for display: numbered from 0, long titles cut, three decimals."""
    shown = F.when(F.length("title") > 28, F.concat(F.substring("title", 1, 28), F.lit(".."))).otherwise(F.col("title"))
    return results.orderBy("rank").select(
        (F.col("rank") - 1).alias("num"), shown.alias("title"), F.format_string("%.3f", "relevance").alias("relevance")
    )


def write_results(results: DataFrame, path: str) -> None:
    """Results as JSON lines, best first, to a path that must not exist."""
    order = [c for c in ("query_id", "rank") if c in results.columns]
    with published(results.sparkSession, path) as work:
        results.orderBy(*order).write.json(work)


def compare_solvers(
    index: Index, queries: DataFrame, qrels: DataFrame, n: int = 10, n_rel: str = "returned"
) -> DataFrame:
    """``(solver, n_queries, map)`` of both solvers on the same queries."""
    return compare_results(ranked_by_solver(index, queries, n), qrels, n, n_rel)


def compare_results(
    results: dict[str, DataFrame], qrels: DataFrame, n: int = 10, n_rel: str = "returned"
) -> DataFrame:
    """``(solver, n_queries, map)`` of result lists by solver name."""
    rows = [
        mean_average_precision(average_precision(ranked, qrels, n, n_rel)).select(
            F.lit(solver).alias("solver"), "n_queries", "map"
        )
        for solver, ranked in results.items()
    ]
    return functools.reduce(DataFrame.unionByName, rows)


def within_reach(summed: DataFrame, n: int, scores: tuple[str, ...]) -> DataFrame:
    """``summed(query_id, id, *scores)`` without documents that are not among the ``n`` best of a query by any score.

    Documents are divided into groups by their ids. There are ``n`` documents at least as good as the nth best of the
    groups' best ones, which is a bar for the query: far fewer are left to be sorted. Ties stay. The bars, a row for each
    query, are broadcast. ``summed`` is read twice.
    """
    group = F.pmod(F.xxhash64("id"), F.lit(GROUPS * n)).alias("group")
    best = summed.groupBy("query_id", group).agg(*(F.max(name).alias(name) for name in scores))
    nth = [F.get(F.sort_array(F.collect_list(name), asc=False), F.lit(n - 1)).alias(f"_bar_{name}") for name in scores]
    bars = best.groupBy("query_id").agg(*nth)
    reaches = [
        F.coalesce(F.col(name) >= F.col(f"_bar_{name}") - F.abs(f"_bar_{name}") * ROOM - 10.0**-SCORE_DECIMALS, F.lit(True))
        for name in scores
    ]
    left = summed.join(F.broadcast(bars), "query_id", "left").where(functools.reduce(operator.or_, reaches))
    return left.select(*summed.columns)


def ranked_by_solver(index: Index, queries: DataFrame, n: int) -> dict[str, DataFrame]:
    """``(query_id, rank, id, relevance)`` for each solver; the scores are worked out once and kept."""
    check_n(n)
    terms = durable(querying.query_terms(queries, index.drop_empty))
    size = querying.measure(terms)
    scores = _term_scores(index, terms, size, {name: name for name in SOLVERS})
    summed = scores.groupBy("query_id", "id").agg(*(F.sum(name).alias(name) for name in SOLVERS))
    if size.small and 0 < n <= MOST_BARRED:
        summed = within_reach(stored(summed, "scores"), n, tuple(SOLVERS))
    by_solver = F.array(*(F.struct(F.lit(name).alias("solver"), F.col(name).alias("relevance")) for name in SOLVERS))
    scored = summed.select("query_id", "id", F.inline(by_solver)).where("relevance <> 0")
    kept = durable(top_n(scored, n, per=("solver", "query_id")))
    return {name: kept.where(F.col("solver") == name).drop("solver") for name in SOLVERS}
