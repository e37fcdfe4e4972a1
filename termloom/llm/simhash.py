"""Near-duplicate detection by SimHash fingerprints joined in a binary trie.

Documents get fingerprints from the hashes of their word shingles; fingerprints that differ in few bits are found by a
self-join of the binary trie of all fingerprints: pairs of nodes are traversed together from the root, the bits in
which they differ are added up, and a pair is dropped as soon as it exceeds the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import connected_components
from termloom.llm.tables import limit_batches, map_batches, staged

# Fingerprints below a trie node from which its pairs are finished inside one task.
LEAF = 8192
# Bits by which a pair of larger nodes is extended in one round.
STEP = 2
# Pairs of leaves that one step of a task compares at most, and leaves that are small enough to compare.
CHUNK = 1 << 20
SMALL = 8

BITS = 64
SEED = 42


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Unsigned XXH64 of every shingle of a UTF-8 text, repeats included; A-Z are lower-cased."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    return np.array([digest(view[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half the hashes. No hash: 0."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255 * 16):
        bits = np.unpackbits(hashes[at : at + 255 * 16].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for row in range(0, len(bits), 255):  # sums of 255 bits fit in a byte
            ones += np.add.reduce(bits[row : row + 255], axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes)).view(">u8").astype(np.uint64)[0]


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, mark)``: one row per row of ``docs``; the fingerprint's 64 bits are those of a long.

    A null, empty or blank text has no shingle and gets 0. Texts are taken as bytes and whole; ``mark`` is a hash of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(x, words)) for x in batch[1].to_pylist()]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.record_batch([batch[0].cast(pa.int64()), values, batch[2]], ["doc_id", "fingerprint", "mark"])

    columns = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_batches(columns.withColumn("mark", F.xxhash64("text")), run, "doc_id long, fingerprint long, mark long")


def near_duplicates(
    docs: DataFrame, words: int = 3, budget: int = 2, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``docs``.

    Two fingerprints are linked when they differ in at most ``budget`` bits; all such pairs are found.
    ``component_id`` is the smallest ``doc_id`` reachable over links, itself included. A null ``doc_id`` takes part and never
    names a component (null if no member has an id). Documents without words all have fingerprint 0 and are linked like
    any others. Repeated rows stay. Equal fingerprints are one node of the join, so copies cost nothing there.
    """
    return _labelled(docs, words, budget, text, id).select("doc_id", "fingerprint", "component_id")


def _labelled(docs: DataFrame, words: int, budget: int, text: str, id: str) -> DataFrame:
    """The same, with ``mark``, a hash of the text."""
    marked = staged(fingerprints(docs, words, text, id), "fingerprints")
    nodes = staged(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    links = staged(trie_join(nodes.select("fingerprint"), budget), "links")
    members = connected_components(links)
    grouped = nodes.join(members, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    grouped = staged(grouped.select("fingerprint", "least", "root"), "members")
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    # A fingerprint may have a great many documents, a component a great many fingerprints: Spark splits both joins.
    labels = staged(grouped.join(named, "root").select("fingerprint", "component_id"), "labels")
    return marked.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id", "mark")


def one_of_each(docs: DataFrame, words: int = 3, budget: int = 2, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; the rest is as for :func:`near_duplicates`.

    A row goes by its id and its text: of different texts with one id each is judged for itself. Rows that are equal in
    every column count once where an id repeats; rows without an id stay. The rows that go are a written table of ids and
    hashes of texts: Spark broadcasts it if its files are small, or joins by exchange.
    """
    found = staged(_labelled(docs, words, budget, text, id), "labelled")
    gone = found.where("doc_id <> component_id").select("doc_id", "mark").distinct()
    again = staged(found.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    own = F.xxhash64(docs[text].cast("binary"))
    kept = docs.join(gone, (docs[id] == gone["doc_id"]) & (own == gone["mark"]), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(again, kept[id] == again["doc_id"], "left_semi").dropDuplicates()
    return kept.join(again, kept[id] == again["doc_id"], "left_anti").unionByName(once)


def trie_join(values: DataFrame, budget: int, leaf: int = LEAF) -> DataFrame:
    """``(u, v)`` of distinct ``(fingerprint)`` that differ in at most ``budget`` bits, as spanning trees of each task.

    Pairs of trie nodes start at the root. A pair whose nodes are small is finished in one task; a pair with a node of over
    ``leaf`` fingerprints is replaced by the pairs of its children ``STEP`` bits further down, and those that differ in
    more than ``budget`` bits are dropped. So a task holds two small nodes at most.
    """
    limit_batches(values.sparkSession)

    def node(depth: int):
        return (F.shiftrightunsigned("fingerprint", BITS - depth) if depth else F.lit(0).cast("long")).alias("node")

    def sizes(depth: int) -> DataFrame:
        return staged(values.groupBy(node(depth)).agg(F.count("*").alias("n")), "sizes")

    depth, ready = 0, []
    root = sizes(0)
    pairs = root.select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
    small = F.greatest("na", "nb") <= leaf
    while True:
        pairs = staged(pairs, "pairs")
        ready.append((depth, pairs.where(small)))
        wide = pairs.where(~small)
        if wide.isEmpty():
            break
        depth += STEP
        children, parent = sizes(depth), F.shiftrightunsigned("node", STEP)
        left = children.select(parent.alias("a"), F.col("node").alias("x"), F.col("n").alias("na"))
        right = children.select(parent.alias("b"), F.col("node").alias("y"), F.col("n").alias("nb"))
        grown = wide.select("a", "b").join(left, "a").join(right, "b")
        grown = grown.where("a <> b OR x <= y").where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= budget)
        pairs = grown.select(F.col("x").alias("a"), F.col("y").alias("b"), "na", "nb")

    ends = F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))
    dealt = None
    for depth, found in ready:
        needed = found.select("a", "b", F.explode(ends).alias("node"))
        rows = values.withColumn("node", node(depth)).join(needed, "node")
        rows = rows.select(F.lit(depth).alias("depth"), "a", "b", "fingerprint")
        dealt = rows if dealt is None else dealt.unionByName(rows)

    def finish(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        value = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
        u, v = linked(value, budget, None if key[1] == key[2] else int(key[0]))
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.groupBy("depth", "a", "b").applyInPandas(finish, "u long, v long")


def linked(value: np.ndarray, budget: int, apart: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within one trie node, or between two.

    ``apart`` is the depth at which two nodes meet; only links between them are then looked for.
    """
    value = np.sort(value)
    pairs = list(_close(value, budget, apart))
    if not pairs:
        return value[:0], value[:0]
    root = _forest(len(value), *(np.concatenate([pair[k] for pair in pairs]) for k in (0, 1)))
    child = np.flatnonzero(root != np.arange(len(value)))
    return value[root[child]], value[child]


def _close(value: np.ndarray, budget: int, apart: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of sorted distinct values that differ in 1 to ``budget`` bits, found by walking node pairs.

    A node is a run of the sorted values with a common prefix. The pairs of one depth are held together; a pair of
    small nodes is compared value by value. When a depth has very many pairs they are walked in parts.
    """
    if apart is None:
        stack = [(0, *(np.array([x]) for x in (0, len(value), 0, len(value))))]
    else:
        prefix = value >> np.uint64(64 - apart)
        half = int((prefix == prefix[0]).sum())
        if half == len(value):
            return
        stack = [(apart, *(np.array([x]) for x in (0, half, half, len(value))))]
    while stack:
        depth, la, ra, lb, rb = stack.pop()
        while len(la):
            if len(la) > CHUNK // 4:
                half = len(la) // 2
                stack.append((depth, la[half:], ra[half:], lb[half:], rb[half:]))
                la, ra, lb, rb = la[:half], ra[:half], lb[:half], rb[:half]
                continue
            done = (np.maximum(ra - la, rb - lb) <= SMALL) | (depth == 64)
            yield from _compare(value, la[done], ra[done], lb[done], rb[done], budget)
            la, ra, lb, rb = la[~done], ra[~done], lb[~done], rb[~done]
            if not len(la):
                break
            depth += 1
            bit = np.uint64(1) << np.uint64(64 - depth)
            ma, mb = _middle(value, la, ra, bit), _middle(value, lb, rb, bit)
            same = la == lb
            children = [
                (la, ma, lb, mb, np.ones(len(la), bool)),
                (ma, ra, mb, rb, np.ones(len(la), bool)),
                (la, ma, mb, rb, np.ones(len(la), bool)),
                (ma, ra, lb, mb, ~same),
            ]
            la, ra, lb, rb = (
                np.concatenate([child[k][child[4]] for child in children]) for k in range(4)
            )
            keep = (ra > la) & (rb > lb)
            la, ra, lb, rb = la[keep], ra[keep], lb[keep], rb[keep]
            shift = np.uint64(64 - depth)
            differ = np.bitwise_count((value[la] >> shift) ^ (value[lb] >> shift)) if len(la) else np.empty(0)
            keep = differ <= budget
            la, ra, lb, rb = la[keep], ra[keep], lb[keep], rb[keep]


def _middle(value: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where the values of each run begin to have the bit set."""
    mask = ~(bit | (bit - np.uint64(1)))
    return np.searchsorted(value, (value[low] & mask) | bit).clip(low, high)


def _compare(value, la, ra, lb, rb, budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    per = (ra - la) * (rb - lb)
    ends = np.cumsum(per)
    at = 0
    while at < len(la):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        part = slice(at, upto)
        n = per[part]
        which = np.repeat(np.arange(len(n)), n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = (rb[part] - lb[part])[which]
        i, j = la[part][which] + place // width, lb[part][which] + place % width
        near = (i < j) & (np.bitwise_count(value[i] ^ value[j]) <= budget)
        yield i[near], j[near]
        at = upto


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of n nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(root, before):
            return root


def hex_fingerprint(fingerprint: str = "fingerprint"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
