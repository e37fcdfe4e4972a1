import random

import numpy as np
import pytest
import xxhash

from termloom.llm import simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text, words=3):
    tokens = [w for w in (text or "").encode().lower().split()]
    if not tokens:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), 42) for i in range(max(1, len(tokens) - words + 1))
    ]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, budget=2):
    """From (id, fingerprint) pairs, comparing all of them."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (doc, _) in enumerate(prints):
        ids = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return [least[find(i)] for i in range(len(prints))]


def test_whole_operator_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    texts = [None, "", "  \t\n", "One", "one", "ONE two", "é È ü", "\x0c a\x0bb", "word " * 3000]
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "One"), (None, "One"), (None, "quite alone here now")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA + ", fingerprint string, node long")
    out = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    wanted = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints), strict=True)]
    assert sorted(map(tuple, out), key=repr) == sorted(wanted, key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("leaf", [4, 64])
def test_trie_join_finds_every_link(spark, leaf):
    rng = random.Random(leaf)
    values = {0, 2**64 - 1, 2**63, 2**63 - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        values |= {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(3)}
    crowd = rng.getrandbits(64)
    values |= {crowd ^ (1 << b) for b in range(30)}
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fingerprint long")
    links = simhash.trie_join(frame, 2, leaf=leaf).collect()
    ordered = sorted(values)
    place = {v: i for i, v in enumerate(ordered)}
    root = simhash._forest(len(ordered), *(np.array([place[r[k] % 2**64] for r in links]) for k in (0, 1)))
    assert [ordered[i] for i in root] == plain_components([(v, v) for v in ordered])


def test_fingerprint_of_long_texts_counts_every_shingle():
    text = " ".join(str(i % 977) for i in range(9000))
    assert int(simhash.fingerprint(simhash.shingle_hashes(text.encode(), 3))) == plain_fingerprint(text)


def test_a_different_text_with_the_id_of_a_copy_stays(spark):
    same, other = "one text of some words that is there twice", "quite another one, seen nowhere else at all"
    docs = spark.createDataFrame([(1, same), (7, same), (7, other), (8, None), (9, None)], SCHEMA)
    kept = sorted(map(tuple, simhash.one_of_each(docs).collect()))
    assert kept == [(1, same), (7, other), (8, None)]
