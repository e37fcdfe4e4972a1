import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(1024 * float(np.float32(x))) for x in v]
    out = []
    for q, a in whole.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole.items() if c != q)
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, k=10, every=5):
    frame = spark.createDataFrame([(*r, 1, [1]) for r in rows], SCHEMA + ", v int, block array<int>")
    return sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % every == 0, k).collect()))


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(2500)]
    rows += [(3000 + i, rows[7][1]) for i in range(200)] + [rows[10]] * 5
    rows += [(5000, None), (5005, [None] * 16), (5010, [float("nan")] + [0.0] * 15), (5015, [float("-inf")] * 16)]
    rows += [(6000, [0.0] * 16), (6005, []), (6010, [0.5]), (None, [1.0] * 16)]
    assert run(spark, rows) == brute(rows, 10, 5)


@pytest.mark.parametrize("n", [0, 1, 2, 11])
def test_few_vectors(spark, n):
    rows = [(i * 5, [float(i), 1.0 - i]) for i in range(n)]
    assert run(spark, rows) == brute(rows, 10, 5)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25]) for _ in range(4)]) for i in range(300)]
    assert run(spark, rows, k=3) == brute(rows, 3, 5)


def test_most_of_the_lists_of_embeddings_is_not_read(spark):
    """Entries of the sorted lists that are read, with the bar that other blocks have given, of those there are."""
    rows = topk.whole_numbers(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).collect()
    vectors, ids = np.array([r.v for r in rows]), np.array([r.vec_id for r in rows])
    block = topk.SortedLists(ids, vectors)
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -(1 << 40))
    asked = np.arange(0, len(ids), 100)
    best = np.sort(scores[asked], axis=1)[:, ::-1][:, :10]
    for bars in (best[:, -1], np.full(len(asked), topk.NO_BAR)):
        found = block.best(ids[asked], vectors[asked], 10, bars)
        assert [s.tolist() for _, s in found] == best.tolist()
    assert block.read < 0.8 * block.entries


def test_reading_stops_early():
    rng = np.random.default_rng(1)
    block = topk.SortedLists(np.arange(1000), rng.integers(-50, 50, (1000, 2)))
    asked, bars = np.array([[30, 1], [-3, -40]]), np.full(2, topk.NO_BAR)
    assert all(len(s) <= 1000 // topk.ENOUGH for s in block._survivors(np.array([-1, -2]), asked, 5, bars))
    assert block.read < 0.3 * block.entries
