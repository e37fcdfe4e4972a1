"""Clustering of vectors around moving centroids, with distance bounds that follow the centroids' moves.

Each vector carries an upper bound of its distance to its own centroid and a lower bound of that to any other. While the
first is below the second its cluster cannot change and no distance is computed. When centroids move, the lower bound is
loosened by less than the whole drift: the members of a cluster lie in a ball around its old centroid, and in the plane of
that centroid and another one's old and new place it shows how much nearer the other can have come to any point of the ball.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.tables import map_batches, staged

# Relative and absolute room for rounding when bounds are compared.
ROOM = 1e-9
# Whole components beyond this are refused: squared distances of 64 of them would not fit in 64 bits.
LARGEST = 1 << 27


class Clustering(NamedTuple):
    """``rows(vec_id, v, cluster, distance)``, the final centroids, and how many vectors each pass scanned in full."""

    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def whole_vectors(
    vectors: DataFrame, dimensions: int = 64, scale: int = 64, vector: str = "embedding", id: str = "vec_id"
) -> DataFrame:
    """``(vec_id, v)``: components x become floor(scale * x). Vectors that are null, of another length, or with a null or
    non-finite component are left out; repeated rows and rows without an id stay."""
    component = F.col(vector)
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.coalesce((F.size(component) == dimensions) & finite, F.lit(False)))
    return kept.select(F.col(id).cast("long").alias("vec_id"), F.transform(component, lambda x: F.floor(scale * x.cast("double"))).alias("v"))


def first_centroids(whole: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order; fewer if there are fewer.

    Equal ids are ordered by their components, rows without an id come last.
    """
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.select(place.alias("place"), "v").orderBy(F.asc_nulls_last("place"), "v").limit(k).collect()
    return np.array([row["v"] for row in rows], np.int64)


def cluster(whole: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, tighten: bool = True) -> Clustering:
    """Clusters the rows ``(vec_id, v)`` of whole vectors of one length.

    Each of ``rounds`` rounds assigns every vector to the nearest centroid (squared Euclidean distance, ties to the smaller
    number) and replaces every centroid that has vectors by the floor of their mean; then vectors are assigned once more.
    All of it is exact. No vector: no row and no centroid. ``tighten=False`` loosens lower bounds by the full drift.

    The vectors and their bounds are a written table of each round. Each task goes through its own vectors; per cluster
    the sums of the components, computed by a grouped aggregate, and its radius come back.
    """
    centers = first_centroids(whole, k, seed)
    if not len(centers):
        empty = whole.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}).where("false")
        return Clustering(empty, centers, [])
    scanned: list[int] = []
    state = staged(_assigned(whole, centers, None, None), "assigned")
    for last in [*[False] * (rounds - 1), True] if rounds else []:
        moved, radius, seen = _moved(state, centers)
        scanned.append(seen)
        drift = np.sqrt(((moved - centers).astype(float) ** 2).sum(axis=1))
        state = staged(_assigned(state, moved, drift, loosened(centers, moved, radius, tighten), exact=last), "assigned")
        centers = moved
    scanned.append(state.agg(F.count_if("scanned")).first()[0])
    return Clustering(state.select("vec_id", "v", "cluster", "distance"), centers, scanned)


def _moved(state: DataFrame, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The next centroids, the radius of each cluster around its present one, and the number of vectors scanned."""
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(centers.shape[1])]
    rows = state.groupBy("cluster").agg(
        F.count("*").alias("n"), F.max("upper").alias("radius"), F.count_if("scanned").alias("seen"), *sums
    )
    moved, radius, seen = centers.copy(), np.zeros(len(centers)), 0
    for row in rows.collect():  # one for each centroid
        c, n = row["cluster"], row["n"]
        moved[c] = [row[f"s{i}"] // n for i in range(centers.shape[1])]
        radius[c] = row["radius"]
        seen += row["seen"]
    return moved, radius, seen


def loosened(old: np.ndarray, new: np.ndarray, radius: np.ndarray, tighten: bool = True) -> np.ndarray:
    """For each cluster how much nearer any other centroid can have come to a point of the ball around its old centroid.

    ``d(x, old) - d(x, new)`` is constant on branches of hyperbolas with these foci. A branch with value ``drift * cos(a)``
    lies within the cone around the drift, from the middle between the foci, of the angle ``a``. So with ``a`` the angle
    between the drift and the tangent to the ball from that middle, no point of the ball has more.
    """
    k = len(old)
    out = np.zeros(k)
    for j in range(k):
        move = (new[j] - old[j]).astype(float)
        drift = np.sqrt(move @ move)
        if drift == 0:
            continue
        middle = (old[j] + new[j]) / 2
        for i in range(k):
            if i == j:
                continue
            most = drift
            way = old[i] - middle
            far = np.sqrt(way @ way)
            reach = radius[i] * (1 + ROOM) + ROOM
            if tighten and far > reach:
                toward = np.arccos(np.clip(way @ move / (far * drift), -1, 1))
                angle = toward - np.arcsin(reach / far)
                most = drift * min(1.0, max(0.0, np.cos(max(angle, 0.0)) + ROOM)) if angle < np.pi / 2 else 0.0
            out[i] = max(out[i], most)
    return out


def squared(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column for each centroid."""
    out = np.empty((len(vectors), len(centers)), np.int64)
    for c, center in enumerate(centers):
        apart = vectors - center
        out[:, c] = np.einsum("ij,ij->i", apart, apart)
    return out


def _assigned(
    rows: DataFrame, centers: np.ndarray, drift: np.ndarray | None, loose: np.ndarray | None, exact: bool = False
) -> DataFrame:
    """The rows with ``cluster``, bounds, whether they were scanned, and the ``distance``, which is 0 unless ``exact``."""
    several = len(centers) > 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch["v"]
            n = len(batch)
            vectors = v.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if n and np.abs(vectors).max() > LARGEST:
                raise OverflowError(f"a component beyond {LARGEST}")
            if drift is None:
                own = np.zeros(n, np.int32)
                upper, lower, scan = np.full(n, np.inf), np.zeros(n), np.ones(n, bool)
            else:
                own = batch["cluster"].to_numpy().copy()
                upper = batch["upper"].to_numpy() + drift[own]
                lower = np.maximum(batch["lower"].to_numpy() - loose[own], 0)
                scan = _ambiguous(upper, lower)
                near = np.flatnonzero(scan)
                apart = vectors[near] - centers[own[near]]
                upper[near] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                scan = _ambiguous(upper, lower)
            at = np.flatnonzero(scan)
            if len(at):
                distances = squared(vectors[at], centers)
                own[at] = distances.argmin(axis=1)
                upper[at] = np.sqrt(distances.min(axis=1))
                lower[at] = np.sqrt(np.partition(distances, 1, axis=1)[:, 1]) if several else np.inf
            distance = np.zeros(n, np.int64)
            if exact or drift is None:
                apart = vectors - centers[own]
                distance = np.einsum("ij,ij->i", apart, apart)
            columns = [batch["vec_id"], v, *map(pa.array, (own.astype(np.int32), upper, lower, scan, distance))]
            yield pa.record_batch(columns, ["vec_id", "v", "cluster", "upper", "lower", "scanned", "distance"])

    schema = "vec_id long, v array<long>, cluster int, upper double, lower double, scanned boolean, distance long"
    return map_batches(rows.select("vec_id", "v", *(["cluster", "upper", "lower"] if drift is not None else [])), run, schema)


def _ambiguous(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return upper * (1 + ROOM) + ROOM >= lower
