"""Exact top-k by inner product, with the no-random-access algorithm in blocks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.tables import limit_batches, staged

SCALE = 1024
# Vectors of one block of candidates, and queries that meet it together, at most.
CANDIDATES = 16_384
QUERIES = 16_384
# Queries of a group that are answered together.
TOGETHER = 64
# Shares of the sorted lists after which the bounds are looked at.
DEPTHS = (1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1)
# Reading stops when one in so many candidates can still qualify; their scores are then resolved.
ENOUGH = 16
# The bar of a query of which nothing is known.
NO_BAR = -(1 << 62)


def whole_numbers(vectors: DataFrame, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``(vec_id, v)``: components x become floor(1024 x). Vectors that are null, or have a null or a component that is
    not finite, and rows without an id are left out; equal rows count once."""
    component = F.col(vector)
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(component, lambda x: F.floor(SCALE * x.cast("double")))
    kept = vectors.where(component.isNotNull() & F.col(id).isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(id).cast("long").alias("vec_id"), scaled.alias("v")).distinct()


def top_k(vectors: DataFrame, queries: Column, k: int = 10, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of each row that meets ``queries``.

    Candidates are all rows with another id; the score is the integer inner product, a component that one of the two
    lacks being 0, and ties go to the smaller id. Fewer than ``k`` candidates are all returned. Blocks of queries meet
    blocks of candidates; in each meeting the components of the candidates are sorted lists that are read from their
    best ends until few candidates have an upper bound that reaches the query's bar, of which the scores are resolved. The
    bar is the ``k``-th best score that is known: of the first block, which all queries meet first, and of the candidates
    that are ahead in this one. Each meeting returns at most ``k`` rows for a query, of which the best are kept. Vectors
    of a block are held in one task; rows are dealt to blocks by a hash of id and vector.
    """
    limit_batches(vectors.sparkSession)
    rows = staged(whole_numbers(vectors, vector, id), "vectors")
    asked = staged(rows.where(queries), "queries")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, wanted = rows.count(), asked.count()
    blocks = max(1, math.ceil(n / CANDIDATES), min(parts, math.ceil(n / 1024)))
    groups = max(1, math.ceil(wanted / QUERIES))

    def dealt(frame: DataFrame, own: str, of: int, other: str, among: Column) -> DataFrame:
        place = F.pmod(F.xxhash64("vec_id", "v"), F.lit(of)).cast("int").alias(own)
        columns = ["vec_id", "v", *(["bar"] if "bar" in frame.columns else [])]
        return frame.select(*columns, place, F.explode(among).alias(other))

    def meet(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        return meeting(ask, have, k)

    def met(asked: DataFrame, first: int, last: int) -> DataFrame:
        """All queries and the candidates of the blocks from ``first`` to before ``last``."""
        mine = dealt(asked, "group", groups, "block", F.sequence(F.lit(first), F.lit(last - 1)))
        there = dealt(rows, "block", blocks, "group", F.sequence(F.lit(0), F.lit(groups - 1)))
        there = there.where(F.col("block").between(first, last - 1))
        both = mine.groupBy("group", "block").cogroup(there.groupBy("group", "block"))
        return both.applyInPandas(meet, "query_id long, vec_id long, score long")

    # The first block gives each query a bar with which it meets the others.
    found = staged(met(asked.withColumn("bar", F.lit(NO_BAR)), 0, 1), "first")
    if blocks > 1:
        reached = found.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n"))
        reached = reached.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bar"))
        barred = asked.join(reached, "vec_id", "left").withColumn("bar", F.coalesce("bar", F.lit(NO_BAR)))
        found = found.unionByName(met(barred, 1, blocks))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def meeting(ask: pd.DataFrame, have: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best candidates of each query within one block."""
    out: list[tuple[np.ndarray, ...]] = []
    if len(ask) and len(have):
        width = max(map(len, [*ask["v"], *have["v"]]))
        block = SortedLists(have["vec_id"].to_numpy(), _matrix(have["v"], width))
        asked, bars, queries = _matrix(ask["v"], width), ask["bar"].to_numpy(), ask["vec_id"].to_numpy()
        for at in range(0, len(ask), TOGETHER):
            part = slice(at, at + TOGETHER)
            for query, (ids, scores) in zip(queries[part], block.best(queries[part], asked[part], k, bars[part]), strict=True):
                out.append((np.full(len(ids), query), ids, scores))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class SortedLists:
    """For each component the candidates of a block in the order of their values, read from both ends.

    A query reads the list of a component from the end where the products with its own component are largest. After a
    depth it knows the components at or beyond the value that the list has come to; any other is at most that value.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        self.floats = vectors.astype(float)
        self.lists = np.sort(self.floats, axis=0)
        # Entries of the lists that queries have read, and all that there were.
        self.read = self.entries = 0

    def best(self, queries: np.ndarray, asked: np.ndarray, k: int, bars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the ``k`` best of each query, best first; those below its bar may be left out."""
        out = []
        for survivors, query, vector in zip(self._survivors(queries, asked, k, bars), queries, asked, strict=True):
            # The final scores of the few that may still qualify.
            scores = self.vectors[survivors] @ vector
            chosen = np.lexsort((self.ids[survivors], -scores))[:k]
            chosen = chosen[self.ids[survivors][chosen] != query]
            out.append((self.ids[survivors][chosen], scores[chosen]))
        return out

    def _survivors(self, queries: np.ndarray, asked: np.ndarray, k: int, bars: np.ndarray) -> list[np.ndarray]:
        n, width = self.vectors.shape
        out: list[np.ndarray] = [np.flatnonzero(self.ids != q) for q in queries]
        self.entries += n * width * len(queries)
        if n <= 2 * k + 1:
            self.read += n * width * len(queries)
            return out
        # What a product of whole numbers can lose as a sum of floating-point ones: nothing, unless they are huge.
        room = 0.5 + 1e-12 * (np.abs(asked).astype(float) @ np.abs(self.floats).max(axis=0))
        least, left = bars.astype(float), np.arange(len(queries))
        before = 0
        for depth in DEPTHS:
            upto = max(1, int(n * depth))
            self.read += (upto - before) * width * len(left)
            before = upto
            upper = self._upper(asked[left].astype(float), upto)
            upper[self.ids == queries[left][:, None]] = -np.inf
            # The lower bounds: the true scores of those that are ahead.
            ahead = np.argpartition(upper, -2 * k, axis=1)[:, -2 * k :]
            scores = np.einsum("qcw,qw->qc", self.floats[ahead], asked[left].astype(float))
            scores[upper[np.arange(len(left))[:, None], ahead] == -np.inf] = -np.inf
            least[left] = np.maximum(least[left], np.partition(scores, -k, axis=1)[:, -k] - room[left])
            near = upper >= (least[left] - room[left])[:, None]
            few = (near.sum(axis=1) <= max(2 * k, n // ENOUGH)) | (upto == n)
            for i in np.flatnonzero(few):
                out[left[i]] = np.flatnonzero(near[i])
            left = left[~few]
            if not len(left):
                break
        return out

    def _upper(self, asked: np.ndarray, upto: int) -> np.ndarray:
        """For each query the largest score that each candidate can have, as the lists are read so far."""
        high, low = self.lists[-upto], self.lists[upto - 1]
        positive, negative = np.maximum(asked, 0), np.minimum(asked, 0)
        return positive @ np.maximum(self.floats, high).T + negative @ np.minimum(self.floats, low).T
