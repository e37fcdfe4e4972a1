"""Near-duplicate documents by bottom-k sketches of their shingle sets.

One hash function orders all shingles. A document keeps the ``k`` smallest hashes of its set, its sketch. Inverted lists of
retained values bring documents together, the smallest ``k`` of two sketches' union estimate their Jaccard similarity, and
what passes is compared by its full sets.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import connected_components
from termloom.llm.tables import limit_batches, map_batches, staged

# Hashes that a sketch retains.
RETAINED = 128
# A pair of the wanted similarity fails the estimate, or shares none of its listed values, with at most this probability.
MISSED = 1e-8
# Members of a list up to which its pairs are written by a join. Longer lists are compared in blocks of about so many
# members, and about so many shingles.
SHORT = 32
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
# Words of which a task remembers the hashes.
REMEMBERED = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache
def least_shared(k: int, percent: int, missed: float = MISSED) -> int:
    """Of the ``k`` smallest hashes of a union, so many are shared but for a probability of ``missed``."""
    p, below = percent / 100, 0.0
    for shared in range(k + 1):
        below += math.comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if below > missed:
            return shared
    return k


def listed_values(percent: int, missed: float = MISSED) -> int:
    """Smallest hashes of each of two sets of which one is shared: each of a union's smallest is, with that similarity."""
    return math.ceil(math.log(missed) / math.log(1 - percent / 100)) if percent < 100 else 1


def sketches(docs: DataFrame, words: int = 5, k: int = RETAINED, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(doc_id, n, mark, sketch, text_mark)``, a row for each row of ``docs``.

    ``n`` is the size of the set of shingles of ``words`` words, ``mark`` a 128-bit hash of the whole set (null if it is
    empty), ``sketch`` its ``k`` smallest hashes in ascending order, ``text_mark`` a hash by which the text is found again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(x.as_py(), words, hashes) for x in batch[1]]
            marks = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            sizes = pa.array([len(x) for x in sets], pa.int64())
            columns = [batch[0], sizes, pa.array(marks, pa.binary()), _listed([x[:k] for x in sets]), batch[2]]
            yield pa.record_batch(columns, ["doc_id", "n", "mark", "sketch", "text_mark"])

    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = "doc_id long, n long, mark binary, sketch array<long>, text_mark long"
    return map_batches(plain.withColumn("text_mark", F.xxhash64("text")), run, schema)


class WordHashes(dict):
    """Hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending as signed numbers.

    A-Z are lower-cased. A text of fewer words has one shingle, a text without a word none.
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.int64)
    each = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    last = len(tokens) - width + 1
    mixed = each[:last]
    for i in range(1, width):
        mixed = _mixed(mixed * _ODD + each[i : i + last])
    return np.unique(_mixed(mixed + _ODD).view(np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _listed(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *arrays]))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 85, k: int = RETAINED, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, n, component_id)``: one row per row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` holds for their sets of distinct shingles;
    ``component_id`` is the smallest ``doc_id`` reachable over links, itself included. Shingles are told apart by 64-bit
    hashes. A null, empty or blank text has the empty set, ``n`` 0, and is linked with nothing. A null id takes part and
    names no component (null if no member has an id). Repeated rows stay, each with its component.

    Documents with one set are one node. A node with more values that no other has than any linked pair's estimate allows
    has no link. The others are posted in the lists of their smallest values. First each meets the best
    member of each of its lists; then, in lists that are still in several components, members of different components
    meet: by a join in short lists, and in long ones in tasks of two blocks, all that are not in the list's largest
    component against all, from which only a spanning forest of links comes back. Pairs whose union sketch passes are
    confirmed on the full sets. A pair of exactly the wanted similarity is missed with a probability of about ``MISSED``,
    closer ones less often. Loose families, of which many members are neither linked nor ruled out by their own
    values, cost a comparison in a task for each pair of such a member.
    """
    if not 0 < percent <= 100 or k < 1:
        raise ValueError("a percentage of 1 to 100 and a sketch of at least one value")
    limit_batches(docs.sparkSession)
    marked = staged(sketches(docs, words, k, text, id), "sketches")
    nodes = marked.where("mark IS NOT NULL").groupBy("mark").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.min("text_mark").alias("text_mark"),
    )
    nodes = staged(nodes, "nodes")
    possible = staged(_with_partners(nodes, k, percent), "possible")
    values = F.slice("sketch", 1, listed_values(percent))
    lists = staged(possible.select(F.explode(values).alias("value"), "mark", "alone", "copies"), "lists")
    best = F.max_by("mark", F.struct(-F.col("alone"), F.col("copies"), F.col("mark"))).alias("leader")
    led = lists.groupBy("value").agg(best, F.count("*").alias("members")).where("members > 1")
    led = staged(led, "led")
    first = lists.join(led, "value").where("mark <> leader").select(F.col("mark").alias("u"), F.col("leader").alias("v"))

    texts = docs.select(F.col(text).cast("binary").alias("text"))
    sets = staged(_sets(texts, possible, words), "sets")
    links = _confirmed(_estimated(first.distinct(), possible, k, percent), sets, percent)
    members = staged(connected_components(links), "members")
    more = _across(lists, led, possible, sets, members, k, percent)
    if not more.isEmpty():
        stars = members.select(F.col("node").alias("u"), F.col("root").alias("v"))
        members = staged(connected_components(stars.unionByName(more)), "members")

    grouped = nodes.select("mark", "least").join(members, F.col("mark") == F.col("node"), "left")
    grouped = grouped.select("mark", "least", F.coalesce("root", "mark").alias("root"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = staged(grouped.join(named, "root").select("mark", "component_id"), "labels")
    found = marked.select("doc_id", "n", "mark").join(labels, "mark", "left")
    return found.select("doc_id", "n", F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _with_partners(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """The nodes that can have a link, and in ``alone`` how many of their retained values no other node retains."""
    values = nodes.select("mark", F.explode("sketch").alias("value"))
    # The only holder of a value is its smallest one: no join back is needed.
    single = values.groupBy("value").agg(F.count("*").alias("holders"), F.min("mark").alias("mark")).where("holders = 1")
    alone = single.groupBy("mark").agg(F.count("*").alias("alone"))
    shared = F.size("sketch") - F.col("alone")
    # Sets that are so small that a partner's is also retained whole share their part of it for certain.
    whole = F.col("n") * 100 <= percent * k
    enough = F.when(whole, shared * 100 >= percent * F.col("n")).otherwise(shared >= least_shared(k, percent))
    joined = nodes.join(alone, "mark", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    return joined.where(enough)


def _estimated(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of which the union sketch does not rule out a link."""
    for end in ("u", "v"):
        own = nodes.select(F.col("mark").alias(end), F.col("n").alias(f"{end}_n"), F.col("sketch").alias(f"{end}_sketch"))
        pairs = pairs.join(own, end)
    low, high = F.least("u_n", "v_n"), F.greatest("u_n", "v_n")
    alike = pairs.where(low * 100 >= percent * high).select("u", "v", "u_n", "v_n", "u_sketch", "v_sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch["u_n"].to_pylist(), batch["v_n"].to_pylist(), strict=True)
            pairs = zip(sizes, batch["u_sketch"], batch["v_sketch"], strict=True)
            kept = [may_be_linked(*n, u.values.to_numpy(), v.values.to_numpy(), k, percent) for n, u, v in pairs]
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return staged(map_batches(alike, run, "u binary, v binary"), "estimated")


def may_be_linked(u_n: int, v_n: int, u: np.ndarray, v: np.ndarray, k: int, percent: int) -> bool:
    """Whether sets of these sizes with these sketches may have the similarity; exact if both are retained whole."""
    common = np.intersect1d(u, v, assume_unique=True)
    if max(u_n, v_n) <= k:
        return 100 * len(common) >= percent * (u_n + v_n - len(common))
    enough = least_shared(k, percent)
    if len(common) < enough:
        return False
    last = np.union1d(u, v)[:k][-1]
    return int(np.searchsorted(common, last, "right")) >= enough


def _sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``(mark, shingles)``: the full sets of the nodes that can have a link, each from one of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(x.as_py(), words, hashes) for x in batch[1]]
            yield pa.record_batch([batch[0], _listed(sets)], ["mark", "shingles"])

    needed = texts.withColumn("text_mark", F.xxhash64("text")).join(nodes.select("mark", "text_mark"), "text_mark")
    one = needed.groupBy("mark").agg(F.first("text").alias("text"))
    return map_batches(one, run, "mark binary, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough."""
    for end in ("u", "v"):
        pairs = pairs.join(sets.select(F.col("mark").alias(end), F.col("shingles").alias(f"{end}_set")), end)
    shared, both = F.size(F.array_intersect("u_set", "v_set")), F.size("u_set") + F.size("v_set")
    return staged(pairs.where(shared * 100 >= percent * (both - shared)).select("u", "v"), "confirmed")


def _across(
    lists: DataFrame, led: DataFrame, nodes: DataFrame, sets: DataFrame, members: DataFrame, k: int, percent: int
) -> DataFrame:
    """Links ``(u, v)`` of members of one list that are not in one component: enough of them to connect what is linked."""
    roots = members.select(F.col("node").alias("mark"), "root")
    placed = lists.join(led.select("value", "members"), "value").join(roots, "mark", "left")
    placed = staged(placed.select("value", "members", "mark", F.coalesce("root", "mark").alias("root")), "placed")
    parts = placed.groupBy("value", "members", "root").agg(F.count("*").alias("held"))
    several = parts.groupBy("value", "members").agg(F.max_by("root", F.struct("held", "root")).alias("largest"), F.count("*").alias("parts"))
    several = staged(several.where("parts > 1"), "several").drop("members")
    still = placed.join(several.select("value", "largest"), "value")

    short = still.where(F.col("members") <= SHORT)
    ends = [short.select("value", F.col("mark").alias(x), F.col("root").alias(f"{x}_root")) for x in ("u", "v")]
    pairs = ends[0].join(ends[1], "value").where("u < v AND u_root <> v_root").select("u", "v").distinct()
    found = _confirmed(_estimated(pairs, nodes, k, percent), sets, percent)

    long = still.where(F.col("members") > SHORT).withColumn("asks", F.expr("root <> largest"))
    long = staged(long.join(nodes.select("mark", "n"), "mark").select("value", "mark", "root", "asks", "n"), "long")
    if long.isEmpty():
        return found
    # Askers are divided into blocks, as are all members; each block of the one meets each of the other in one task.
    asking = F.when(F.col("asks"), F.col("n"))
    sizes = long.groupBy("value").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"),
        F.greatest(F.ceil(F.count(asking) / BLOCK), F.ceil(F.sum(asking) / BLOCK_SHINGLES)).alias("groups"),
    )
    dealt = long.join(sizes, "value").join(sets, "mark")
    zero = F.lit(0).cast("long")
    columns = ["value", "block", "group", "asking", "mark", "root", "asks", "shingles"]
    own, ask = (F.pmod(F.xxhash64("mark"), F.col(c)) for c in ("blocks", "groups"))
    every = dealt.withColumn("block", own).withColumn("group", F.explode(F.sequence(zero, F.col("groups") - 1)))
    askers = dealt.where("asks").withColumn("group", ask).withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    rows = every.withColumn("asking", F.lit(False)).select(columns).unionByName(
        askers.withColumn("asking", F.lit(True)).select(columns)
    )
    first = listed_values(percent)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        asking = group["asking"].to_numpy()
        u, v = meeting(group["value"].iloc[0], group[asking], group[~asking], k, percent, first)
        return pd.DataFrame({"u": u, "v": v})

    across = rows.groupBy("value", "block", "group").applyInPandas(meet, "u binary, v binary")
    return staged(found.unionByName(across).distinct(), "across")


def meeting(
    value: int, askers: pd.DataFrame, others: pd.DataFrame, k: int, percent: int, listed: int
) -> tuple[list[bytes], list[bytes]]:
    """Links between askers and other members of the list of ``value`` that join different components.

    A pair that shares a smaller one of their ``listed`` values meets in that list instead.
    """
    out: tuple[list[bytes], list[bytes]] = ([], [])
    if not len(askers) or not len(others):
        return out
    sets = list(others["shingles"])
    n = np.array([len(x) for x in sets])
    universe, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(n) - n
    # Sketches as rows of ranks; what is missing has the rank beyond all.
    ranks = np.full((len(sets), k), len(universe))
    inside = np.arange(k) < n[:, None]
    ranks[inside] = code[(starts[:, None] + np.arange(k))[inside]]
    marks, asks = others["mark"].to_numpy(), others["asks"].to_numpy()
    # Components by number; they grow together as links are found.
    names = {root: i for i, root in enumerate(dict.fromkeys([*others["root"], *askers["root"]]))}
    component = np.arange(len(names))
    root = np.array([names[x] for x in others["root"]])
    enough = least_shared(k, percent)
    for mine, own_root, values in zip(askers["mark"], askers["root"], askers["shingles"], strict=True):
        size, own = len(values), names[own_root]
        low, high = np.minimum(n, size), np.maximum(n, size)
        twice = asks & (marks < mine)  # met the other way round
        near = np.flatnonzero((component[root] != component[own]) & (low * 100 >= percent * high) & ~twice)
        held = np.zeros(len(universe) + 1, np.int64)
        at = np.searchsorted(universe, values).clip(0, len(universe) - 1)
        held[at[universe[at] == values]] = 1
        smaller = np.zeros(len(universe) + 1, bool)
        at = at[: min(listed, size)][values[:listed] < value]
        smaller[at[held[at] == 1]] = True
        near = near[~smaller[ranks[near, :listed]].any(axis=1)]
        if not len(near):
            continue
        # Of the smallest k of the union, those that both have.
        shared = held[ranks[near]]
        before = np.append(np.searchsorted(values, universe, "right"), k + 1)
        place = np.arange(1, k + 1) + before[ranks[near]] - np.cumsum(shared, axis=1)
        whole = high[near] <= k
        near = near[whole | ((shared * (place <= k)).sum(axis=1) >= enough)]
        if not len(near):
            continue
        # The full sets.
        lengths = n[near]
        ends = np.cumsum(lengths)
        flat = np.repeat(starts[near] - (ends - lengths), lengths) + np.arange(ends[-1])
        common = np.add.reduceat(held[code[flat]], ends - lengths)
        for i in near[common * 100 >= percent * (size + lengths - common)]:
            if component[root[i]] != component[own]:
                component[component == component[root[i]]] = component[own]
                out[0].append(mine)
                out[1].append(marks[i])
    return out
