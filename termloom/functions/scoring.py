"""Weights and the two relevance solvers, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

IDF_TYPES = ("log", "normal")

# BM25 saturation and length normalisation.
K1 = 2.0
B = 0.75

Scorer = Callable[..., Column]


def idf(df: Column, n_docs: Column, idf_type: str = "log") -> Column:
    """Inverse document frequency: ``ln(N / df)`` or ``1 / df``."""
    if idf_type not in IDF_TYPES:
        raise ValueError(f"idf_type must be one of {IDF_TYPES}, not {idf_type!r}")
    if idf_type == "normal":
        return F.lit(1.0) / df
    return F.log(n_docs.cast("double") / df)


def tfidf(tf: Column, idf: Column) -> Column:
    return tf * idf


def bm25(k1: float = K1, b: float = B) -> Scorer:
    """BM25 term score from the stored term frequency; a repeated query word counts once.

    A corpus whose floored average length is 0 has no defined length ratio: its scores are 0.
    """
    if k1 < 0 or not 0 <= b <= 1:
        raise ValueError(f"need k1 >= 0 and 0 <= b <= 1, not k1={k1}, b={b}")

    def score(tf: Column, idf: Column, qtf: Column, doc_length: Column, avgdl: Column) -> Column:
        saturation = _saturation(tf, doc_length, avgdl, k1, b)
        return F.coalesce(F.try_divide(tf * idf * F.lit(k1 + 1), saturation), F.lit(0.0))

    return score


def _saturation(tf: Column, doc_length: Column, avgdl: Column, k1: float, b: float) -> Column:
    ratio = F.try_divide(doc_length, avgdl)
    return tf + F.lit(k1) * (F.lit(1.0) + F.lit(b) * (ratio - F.lit(1.0)))


def peak(tf: Column, doc_length: Column, avgdl: Column) -> Column:
    """Aggregate over the postings of a term: the largest factor that BM25 gives its idf, before ``k1 + 1``."""
    return F.max(F.coalesce(F.try_divide(tf, _saturation(tf, doc_length, avgdl, K1, B)), F.lit(0.0)))


def largest_score(solver: str) -> Column:
    """What a query word can add to a document at most, from ``idf``, ``qtf``, and the term's ``peak`` and ``max_tf``."""
    if solver == "BM25":
        return F.col("idf") * F.lit(K1 + 1) * F.col("peak")
    return (F.col("qtf") * F.col("idf")) * (F.col("max_tf") * F.col("idf"))


def basic() -> Scorer:
    """Dot product of the query's and the document's TF-IDF weights."""

    def score(tf: Column, idf: Column, qtf: Column, doc_length: Column, avgdl: Column) -> Column:
        return F.coalesce((qtf * idf) * (tf * idf), F.lit(0.0))

    return score


SOLVERS: dict[str, Callable[[], Scorer]] = {"BM25": bm25, "Basic": basic}


def scorer(solver: str | Scorer) -> Scorer:
    """The scorer of a solver name; a callable ``(tf, idf, qtf, doc_length, avgdl) -> Column`` is itself one."""
    if callable(solver):
        return solver
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {tuple(SOLVERS)}, not {solver!r}")
    return SOLVERS[solver]()
