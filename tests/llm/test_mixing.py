import collections
import re

from termloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def filled(sizes, share=1.5, cap=2):
    """Targets by sharing again and again, in plain Python."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while open_ and left > 1e-9:
        total, given = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=str):
            add = min(left * weight[s] / total, cap * sizes[s] - target[s])
            target[s] += add
            given += add
        open_ = {s for s in open_ if target[s] < cap * sizes[s] - 1e-9}
        left -= given
    return target


def run(spark, rows):
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "source", "mix.*").collect()
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
    return out, size


def test_targets_are_met(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 4}" if i % 3 else "hot") for i in range(300)]
    rows += [(1000, "x " * 5000, "hot"), (1001, None, None), (1002, "a b c\x1f", None), (None, "z", None), (7, "w", "tiny")]
    out, size = run(spark, rows)
    wanted = filled(size)
    assert len(out) == len(rows)
    taken = collections.Counter()
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == size[r.source]
        assert abs(r.target - wanted[r.source]) < 1e-6
        assert sum(p.words for p in r.placements) == r.taken
        assert all(0 <= p.position <= 1 for p in r.placements)
    for source in size:
        assert 0 <= wanted[source] - taken[source] < 1
    positions = [r.position for r in out if r.position is not None]
    assert positions == sorted(positions)
    again, _ = run(spark, rows[::-1])
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)


def test_demand_follows_the_schedule(spark):
    """Half way through training a rising source has had less than half of its words."""
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(3000)]
    out, _ = run(spark, rows)
    early, total = collections.Counter(), collections.Counter()
    for r in out:
        for p in r.placements:
            total[r.source] += p.words
            early[r.source] += p.words * (p.position < 0.5)
    for source, share in (("s0", 0.375), ("s1", 0.5), ("s2", 0.625)):
        assert abs(early[source] / total[source] - share) < 0.01


def test_taken_rows_repeat_and_cut(spark):
    rows = [(1, "a b c d", "s"), (2, "e f  g h", "s")]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    out = mixing.taken_rows(mixed).collect()
    assert sum(len(r.text.split()) for r in out) == 12
    assert {r.text for r in out} <= {"a b c d", "e f  g h"} | {"a b c d"[:k] for k in (1, 3, 5)} | {"e f", "e f g"}


def test_empty_and_wordless(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    out, _ = run(spark, [(1, None, "a"), (2, "", None)])
    assert [(r.size, r.target, r.taken, r.position) for r in out] == [(0, 0.0, 0, None)] * 2


def test_other_columns_are_carried(spark):
    frame = spark.createDataFrame([(1, "a b", "s", 5, "k", "old")], SCHEMA + ", size long, key string, mix string")
    row = mixing.mix(frame).first()
    assert (row.size, row.key, row.mix.size) == (5, "k", 2)
