import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from termloom.llm import minhash

SCHEMA = "doc_id long, text string"


def plain_set(text, words=5):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return frozenset()
    return frozenset(b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1)))


def plain(rows, percent=85):
    """(id, size, component) of each row, comparing all pairs."""
    sets = [plain_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(ids, default=None)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def found(spark, rows, **how):
    frame = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in minhash.near_duplicates(frame, **how).collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def family(rng, n, words, most, start=0):
    """Copies of one text of which up to ``most`` words are replaced."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = base.copy()
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(own)))
    return rows


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"),
        (None, "alone here"), (8, "é b c d e"), (8, "É b c d e"), (9, "word " * 30_000), (10, "word " * 20_000), (8, "a b"),
    ]
    same(found(spark, rows), plain(rows))


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("k", [16, 128])
def test_all_links_of_loose_families(spark, k):
    rng = random.Random(k)
    rows = family(rng, 60, 120, 9) + family(rng, 50, 400, 20, 100) + family(rng, 30, 12, 2, 200)
    rng.shuffle(rows)
    same(found(spark, rows, k=k), plain(rows))


def test_long_lists_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SHORT", 3)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(4)
    rows = family(rng, 80, 60, 5) + family(rng, 40, 300, 12, 100)
    same(found(spark, rows, k=64), plain(rows))


def test_chain_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(12):
        own = base.copy()
        for i in range(step):
            own[i * 16] = f"x{i}"
        rows.append((20 - step, " ".join(own)))
    want = plain(rows)
    assert {c for _, _, c in want} == {9}
    same(found(spark, rows), want)


def test_documents_that_share_a_long_passage_only(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) + " " + passage) for i in range(90)]
    assert all(c == doc for doc, _, c in found(spark, rows))


def test_other_columns_do_not_matter(spark):
    frame = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], SCHEMA)
    more = frame.select("*", *(F.lit(0).alias(c) for c in ("mark", "sketch", "n", "value", "u", "component_id")))
    assert sorted(map(tuple, minhash.near_duplicates(more).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_boundary_is_exact(spark):
    # 17 of 20 shingles shared: 85 % and linked; 16 of 19 is less.
    a = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20 w21"
    rows = [(1, a + " b c d"), (2, a), (3, " ".join(a.split()[:-1]) + " q r s")]
    same(found(spark, rows), plain(rows))
    assert plain(rows)[1] == (2, 17, 1)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same([tuple(r) for r in minhash.near_duplicates(docs).collect()], plain(rows))


def test_blocks_return_a_forest():
    def frame(rows):
        return pd.DataFrame(rows, columns=("mark", "root", "asks", "shingles"))

    shingles = np.arange(20)
    rows = [(bytes([i]), bytes([i]), True, shingles) for i in range(5)]
    rows.append((b"z", b"z", False, shingles))
    u, v = minhash.meeting(0, frame(rows[:5]), frame(rows), 128, 85, 10)
    assert len(u) == 5
    # They share a smaller listed value, so another list has them.
    assert minhash.meeting(3, frame(rows[:5]), frame(rows), 128, 85, 10) == ([], [])


@pytest.mark.parametrize("k", [8, 40])
def test_block_estimate_equals_that_of_single_pairs(k):
    rng = np.random.default_rng(k)
    base = rng.choice(10**6, 60, replace=False)
    sets = []
    for _ in range(40):
        own = np.where(rng.random(60) < rng.choice([0.03, 0.1, 0.4]), rng.integers(10**6, 10**7, 60), base)
        sets.append(np.unique(own[: rng.integers(20, 61)]))
    for i, mine in enumerate(sets):
        other = sets[(i + 1) % len(sets)]
        rows = [pd.DataFrame({"mark": [m], "root": [m], "asks": [a], "shingles": [x]}) for m, a, x in ((b"a", True, mine), (b"b", False, other))]
        met = minhash.meeting(-1, *rows, k, 85, 10)[0]
        common = len(np.intersect1d(mine, other))
        linked = 100 * common >= 85 * (len(mine) + len(other) - common)
        sizes = min(len(mine), len(other)), max(len(mine), len(other))
        wanted = linked and minhash.may_be_linked(len(mine), len(other), mine[:k], other[:k], k, 85)
        assert bool(met) == (wanted and 100 * sizes[0] >= 85 * sizes[1])


def test_bad_parameters(spark):
    with pytest.raises(ValueError):
        minhash.near_duplicates(spark.createDataFrame([], SCHEMA), percent=0)
