import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, k, rounds, seed=1):
    """(clusters, distances, centroids) of whole vectors [(id, v)], comparing all."""
    order = sorted(vectors, key=lambda r: (r[0] is None, r[0] is not None and hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in vectors]
        for c in range(len(centers)):
            mine = [v for (_, v), o in zip(vectors, own, strict=True) if o == c]
            if mine:
                centers[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, tuple(v), *reversed(nearest(v))) for i, v in vectors], centers


def clustered(spark, vectors, k, rounds=3, **how):
    rows = spark.createDataFrame(vectors, "vec_id long, v array<long>")
    return centroids.cluster(rows, k, rounds, **how)


def mixture(rng, n, d, middles=5, spread=40):
    places = [[rng.randrange(-500, 500) for _ in range(d)] for _ in range(middles)]
    return [(i, [x + int(rng.gauss(0, spread)) for x in rng.choice(places)]) for i in range(n)]


@pytest.mark.parametrize(("n", "d", "k", "rounds"), [(300, 4, 7, 3), (200, 2, 5, 8), (40, 3, 1, 2), (5, 3, 16, 3), (100, 6, 9, 0)])
@pytest.mark.parametrize("tighten", [True, False])
def test_equals_comparing_all(spark, n, d, k, rounds, tighten):
    rng = random.Random(n + k)
    vectors = mixture(rng, n, d) + [(n + i, [0] * d) for i in range(3)]
    found = clustered(spark, vectors, k, rounds, tighten=tighten)
    want, centers = plain(vectors, k, rounds)
    assert found.centroids.tolist() == centers
    got = [(r.vec_id, tuple(r.v), r.cluster, r.distance) for r in found.rows.collect()]
    assert sorted(got) == sorted(want)


def test_ties_go_to_the_smaller_number_and_repeated_rows_stay(spark):
    vectors = [(1, [0, 0]), (2, [4, 0]), (3, [2, 0]), (3, [2, 0]), (None, [2, 0])]
    found = clustered(spark, vectors, 2, 0)
    want, _ = plain(vectors, 2, 0)
    got = [(r.vec_id, tuple(r.v), r.cluster, r.distance) for r in found.rows.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_tightened_bounds_scan_less(spark):
    vectors = mixture(random.Random(9), 1500, 8, middles=12, spread=60)
    scans = [sum(clustered(spark, vectors, 12, 6, tighten=t).scanned) for t in (True, False)]
    assert scans[0] < scans[1] < 7 * len(vectors)


def test_loosened_covers_every_point_of_the_ball():
    rng = np.random.default_rng(2)
    for _ in range(200):
        old, new = rng.integers(-50, 50, (2, 2, 3))
        new[0] = old[0]
        radius = np.array([rng.uniform(0, 60), 0.0])
        bound, full = (centroids.loosened(old, new, radius, t)[0] for t in (True, False))
        assert bound <= full * (1 + 1e-6)
        way = rng.normal(size=(400, 3))
        points = old[0] + way / np.linalg.norm(way, axis=1)[:, None] * radius[0] * rng.uniform(0, 1, (400, 1))
        nearer = np.linalg.norm(points - old[1], axis=1) - np.linalg.norm(points - new[1], axis=1)
        assert nearer.max() <= bound + 1e-6


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -0.5]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, [0.26, 0.0]), (None, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit(1), "cluster": F.lit("x")})
    kept = centroids.whole_vectors(frame, 2, 4).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, [4, -2]), (7, [1, 0]), (None, [0, 0])], key=repr)


def test_empty_table(spark):
    found = centroids.cluster(centroids.whole_vectors(spark.createDataFrame([], SCHEMA)))
    assert found.rows.collect() == [] and len(found.centroids) == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(1, [1 << 40]), (2, [0])], 2)
