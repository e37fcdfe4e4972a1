"""Ranked lexical search for a table of items over all documents, by two trees at once.

Items and documents are vectors over the items' terms: weights here, impacts there, and a score is their product. A node of
either tree holds the largest value of each coordinate below it, so the product of two nodes bounds every score below them.
A pair of nodes is left when its bound is less than what each item below has as its weakest of the best so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.tables import map_batches, staged

# Bytes that are not separators stay, A-Z become a-z, all others a space.
_LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()

# Bytes of item texts that are searched for together, and of the dense block of documents that a task looks at together.
ITEM_BYTES = 1 << 18
DENSE_BYTES = 1 << 26
# Documents or items of a leaf, nodes of a parent, and document leaves that are scored together.
LEAF = 16
ITEM_LEAF = 4
FANOUT = 8
TOGETHER = 8

# Stands for the id of a document that has none.
_NO_ID = (1 << 63) - 1


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text: runs of digits, letters and bytes beyond 7 bits, A-Z in lower case."""
    return (text or b"").translate(_LETTERS).split()


def impact(tf, m):
    """What one term adds for each unit of its weight; whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score above 0 for each row of ``items``.

    Equal scores go to the smaller ``doc_id``, rows without one last; fewer than ``k`` documents are all returned. Every row
    of either table counts for itself, so repeated rows each have their place; rows of items with one id each have
    their ranks. Null or empty texts, and texts without a term, match nothing and do not count as documents.

    Items are taken in blocks of bounded text, of which a block's terms are sent to all tasks. A pass over the documents
    counts them; document frequencies come from a grouped count. In a second pass over the counts each task keeps the best
    of each item from block to block of its documents, and the few best of all tasks are ranked.
    """
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    size = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / ITEM_BYTES))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = None
    for block in range(blocks):
        rows = asked.where(place == block).collect()  # a bounded part of the stated queries
        part = _block(texts, rows, block, k, items.schema[item_id].dataType.simpleString())
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _block(texts: DataFrame, rows: list, block: int, k: int, id_type: str) -> DataFrame:
    spark = texts.sparkSession
    counted = [terms_of(row["text"]) for row in rows]
    vocabulary = {term: i for i, term in enumerate(dict.fromkeys(t for terms in counted for t in terms))}
    counts = staged(term_counts(texts, vocabulary), "counts")
    n_docs, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term
    weight = np.zeros(len(vocabulary), np.int64)
    for term, df in frequency:
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    vectors = [np.unique([vocabulary[t] for t in terms], return_counts=True) for terms in counted]
    queries = [(terms.astype(np.int64), times * weight[terms.astype(np.int64)]) for terms, times in vectors]
    best = best_of_each(counts.where(F.size("terms") > 0), queries, len(vocabulary), n_docs, total, k)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(rows)], f"item int, item_id {id_type}")
    return best.join(names, "item").withColumn("block", F.lit(block))


def term_counts(texts: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of each document with a term: all its terms counted, and each of the vocabulary's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            sizes, terms, tfs, there = [], [], [], []
            for i, x in enumerate(batch[1]):
                words = terms_of(x.as_py())
                if not words:
                    continue
                there.append(i)
                sizes.append(len(words))
                own, times = np.unique(np.array([t for t in map(known, words) if t is not None], np.int32), return_counts=True)
                terms.append(own)
                tfs.append(times)
            columns = [
                batch[0].take(pa.array(there, pa.int64())), pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64())),
            ]
            yield pa.record_batch(columns, ["doc_id", "n", "terms", "tfs"])

    return map_batches(texts, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def best_of_each(counts: DataFrame, queries: list, width: int, n_docs: int, total: int, k: int) -> DataFrame:
    """``(item, doc_id, score)``: of each task's documents the ``k`` best of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = ItemTree(queries, width, k)
        most = max(LEAF, DENSE_BYTES // (4 * max(width, 1)))
        for batch in batches:
            for at in range(0, len(batch), most):
                part = batch.slice(at, most)
                ids = part["doc_id"].fill_null(_NO_ID).to_numpy()
                m = 100 - 25 + (25 * part["n"].to_numpy() * n_docs) // total
                widths = part["terms"].value_lengths().to_numpy()
                terms, tfs = part["terms"].flatten().to_numpy(), part["tfs"].flatten().to_numpy()
                tree.meet(Documents(ids, np.repeat(np.arange(len(ids)), widths), terms, impact(tfs, np.repeat(m, widths)), width))
        yield tree.results()

    return map_batches(counts, run, "item int, doc_id long, score long")


class Documents:
    """A block of documents as a tree: a leaf holds documents whose strongest terms are alike.

    ``levels[0]`` has the leaves' coordinate maxima, each further level those of ``FANOUT`` nodes below.
    """

    def __init__(self, ids: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
        n = len(ids)
        dense = np.zeros((n, width), np.float32)  # impacts are whole and below 2**24
        dense[row, term] = value
        # Documents are put in the order of the rarest of their terms within the block.
        held = np.bincount(term, minlength=width)
        order = np.lexsort((value, held[term], row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))] if len(row) else order
        order = np.lexsort((ids, term[first]))
        self.ids, self.dense = ids[order], dense[order]
        level = np.maximum.reduceat(self.dense, np.arange(0, n, LEAF), axis=0)
        self.levels = [level]
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), FANOUT), axis=0)
            self.levels.append(level)


class _Node:
    """Items, or nodes below; the coordinates that any of them has, and the largest weight of each."""

    def __init__(self, items: np.ndarray, terms: np.ndarray, largest: np.ndarray, below: list[_Node]):
        self.items, self.terms, self.largest, self.below = items, terms, largest, below
        self.weights = np.empty((0, 0))  # of a leaf: a row for each item


class ItemTree:
    """All items as a tree, and the best documents of each so far."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], width: int, k: int):
        self.k = k
        self.scores = np.zeros((len(queries), k), np.int64)  # 0: no document yet
        self.ids = np.full((len(queries), k), _NO_ID)
        self.scored = 0  # documents that were scored, for all items
        self.root = self._grown(queries, width)

    def _grown(self, queries: list, width: int) -> _Node | None:
        useful = [i for i, (terms, weights) in enumerate(queries) if weights.any()]
        # Items with the same heaviest term are neighbours.
        useful.sort(key=lambda i: (int(queries[i][0][queries[i][1].argmax()]), i))
        nodes = []
        for at in range(0, len(useful), ITEM_LEAF):
            items = useful[at : at + ITEM_LEAF]
            terms = np.unique(np.concatenate([queries[i][0] for i in items]))
            weights = np.zeros((len(items), len(terms)))
            for row, i in enumerate(items):
                weights[row, np.searchsorted(terms, queries[i][0])] = queries[i][1]
            node = _Node(np.array(items), terms, weights.max(axis=0), [])
            node.weights = weights
            nodes.append(node)
        while len(nodes) > 1:
            above = []
            for at in range(0, len(nodes), FANOUT):
                below = nodes[at : at + FANOUT]
                largest = np.zeros(width)
                for node in below:
                    largest[node.terms] = np.maximum(largest[node.terms], node.largest)
                terms = np.unique(np.concatenate([node.terms for node in below]))
                above.append(_Node(np.concatenate([node.items for node in below]), terms, largest[terms], below))
            nodes = above
        return nodes[0] if nodes else None

    def meet(self, documents: Documents) -> None:
        """Takes what the documents add to the best of each item."""
        if self.root is not None and len(documents.ids):
            top = len(documents.levels) - 1
            self._visit(self.root, documents, top, np.arange(len(documents.levels[top])))

    def _visit(self, node: _Node, documents: Documents, level: int, at: np.ndarray) -> None:
        bounds = documents.levels[level][np.ix_(at, node.terms)].astype(float) @ node.largest
        # The weakest kth score below; a document of an equal score may still have the smaller id.
        near = bounds >= max(1, self.scores[node.items, -1].min())
        at, bounds = at[near], bounds[near]
        if not len(at):
            return
        if level == 0 and not node.below:
            self._score(node, documents, at, bounds)
            return
        if level:
            size = len(documents.levels[level - 1])
            at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            at, level = at[at < size], level - 1
        for below in node.below or [node]:
            self._visit(below, documents, level, at)

    def _score(self, node: _Node, documents: Documents, leaves: np.ndarray, bounds: np.ndarray) -> None:
        """Leaves by falling bound, until none can reach the weakest of the items."""
        order = np.argsort(-bounds, kind="stable")
        for begin in range(0, len(order), TOGETHER):
            chosen = order[begin : begin + TOGETHER]
            chosen = chosen[bounds[chosen] >= max(1, self.scores[node.items, -1].min())]
            if not len(chosen):
                return
            rows = (leaves[chosen][:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < len(documents.ids)]
            # Whole numbers below 2**53: exact, and in any order.
            scores = (node.weights @ documents.dense[np.ix_(rows, node.terms)].astype(float).T).astype(np.int64)
            self.scored += scores.size
            for item, own in zip(node.items, scores, strict=True):
                good = np.flatnonzero(own >= max(1, self.scores[item, -1]))
                if len(good):
                    both = np.concatenate([self.scores[item], own[good]])
                    ids = np.concatenate([self.ids[item], documents.ids[rows[good]]])
                    best = np.lexsort((ids, -both))[: self.k]
                    self.scores[item], self.ids[item] = both[best], ids[best]

    def results(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.scores)
        ids = self.ids[item, place]
        columns = [pa.array(item, pa.int32()), pa.array(ids, mask=ids == _NO_ID), pa.array(self.scores[item, place])]
        return pa.record_batch(columns, ["item", "doc_id", "score"])
