"""Encoding texts to the pieces of a SentencePiece model, and back.

A text is marked (a space becomes the mark, one mark is put in front) and falls into marked words: marks followed by other
characters. No piece reaches over the start of a marked word, so words are encoded one by one. The distinct words of a block
of texts are sorted, which puts them in the order of a depth-first walk of their trie: what the forward pass has found for a
prefix is reused for every word that shares it.

The forward pass keeps for each prefix its best last piece. For a unigram model this is Viterbi: the best score of a prefix
is the best over its last pieces of the score before plus the piece's. A BPE model has no sums of scores; its encoding of a
prefix is the one in which all neighbouring pieces are stable, that is, merging the two of them afresh gives the same two
pieces. Every prefix has exactly one such encoding, so the same pass finds the last piece that is stable behind what the
prefix before ends with.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termloom.llm.tables import map_batches

MARK = "▁"
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

# Words, and pairs of pieces, that a worker remembers from task to task; beyond it starts anew, results are the same. A
# word takes about 250 bytes.
REMEMBERED = 600_000
PAIRS = 300_000
# Characters of texts that are split into words together. Before them a worker may forget, so it remembers at most their words more.
TOGETHER = 1 << 20

# What stands before the first piece of a word.
_START = 1 << 21


def read_model(path: str) -> bytes:
    """A model file, read where the query is planned; its size is that of a vocabulary."""
    with open(os.fspath(path), "rb") as file:
        return file.read()


class PieceCodec:
    """Encoder and decoder of one model (BPE or unigram, identity normalizer, mark in front of words)."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        self.remembered = remembered
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        self.pieces = [processor.id_to_piece(i) for i in range(size)]
        special = [processor.is_control(i) or processor.is_unknown(i) for i in range(size)]
        self.bytes_of = {i: bytes([int(self.pieces[i][3:-1], 16)]) for i in range(size) if processor.is_byte(i)}
        self.byte_ids = {value[0]: i for i, value in self.bytes_of.items()}
        self.unknown = processor.unk_id()
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.bytes_of}
        self.scores = {p: processor.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece reaches over the start of a word")
        self.is_bpe = _is_bpe(model)
        self.ends: dict | None = None
        self.least = min(self.scores.values(), default=0.0) - 10.0
        self._text = [self._plain(i) for i in range(size)]
        self._forget()
        self._stable: dict[int, bool] = {}
        for i in range(size):  # what a special piece stands for when decoded
            if special[i]:
                self._text[i] = b" \xe2\x81\x87 " if processor.is_unknown(i) else b""

    def _plain(self, i: int) -> bytes:
        return self.bytes_of.get(i) or self.pieces[i].replace(MARK, " ").encode()

    # --- words

    def encode_words(self, words: set[str]) -> dict[str, int]:
        """The number of each distinct word, by a depth-first walk of the trie of the sorted words.

        The ids of the word numbered w are ``flat[starts[w]:starts[w + 1]]``.
        """
        if len(self.number) > self.remembered:
            self._forget()
        if self.ends is None:
            self.ends = _reversed_trie(self.ids)
        number = self.number
        extend = self._extend_bpe if self.is_bpe else self._extend_unigram
        # For each prefix the last piece of its best encoding (a character that is no piece as -1 - its code), and its score.
        last: list[int] = [_START]
        score: list[float] = [0.0]
        before = ""
        for word in sorted(words.difference(number)):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], score[shared + 1 :]
            extend(word, shared, last, score)
            number[word] = len(self.starts) - 1
            ids = self._ids_of(word, last)
            self.flat.extend(ids)
            self.starts.append(len(self.flat))
            self.whole.append(self._stands_for(ids, word))
            before = word
        return number

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.starts, self.whole = array("i"), array("q", [0]), array("b")

    def _stands_for(self, ids: list[int], word: str) -> bool:
        """Whether the ids decode to the word, and if it is marked begin with a mark."""
        text = self._text
        same = b"".join([text[i] for i in ids]) == word.replace(MARK, " ").encode()
        return same and (not word.startswith(MARK) or self.pieces[ids[0]].startswith(MARK))

    def _extend_unigram(self, word: str, at: int, last: list[int], score: list[float]) -> None:
        scores, pieces = self.scores, self.pieces
        for end in range(at, len(word)):
            best, piece = score[end] + self.least, -1 - ord(word[end])
            node, start = self.ends, end
            while start >= 0 and (node := node.get(word[start])) is not None:
                if (i := node.get("")) is not None and (total := score[start] + scores[pieces[i]]) > best:
                    best, piece = total, i
                start -= 1
            last.append(piece)
            score.append(best)

    def _extend_bpe(self, word: str, at: int, last: list[int], score: list[float]) -> None:
        ends, stable = self.ends, self._stable
        for end in range(at, len(word)):
            node, start, found = ends, end, []
            while start >= 0 and (node := node.get(word[start])) is not None:
                if (i := node.get("")) is not None:
                    found.append((i, start))
                start -= 1
            chosen = -1 - ord(word[end])  # not a piece: it stays a character and becomes bytes
            for i, start in reversed(found):
                pair = last[start] << 22 | i
                kept = stable.get(pair)
                if kept is None:
                    kept = self._is_stable(last[start], i, pair)
                if kept:
                    chosen = i
                    break
            last.append(chosen)
            score.append(0.0)

    def _is_stable(self, left: int, right: int, pair: int) -> bool:
        if len(self._stable) > PAIRS:
            self._stable.clear()
        before = "" if left == _START else chr(-1 - left) if left < 0 else self.pieces[left]
        piece = self.pieces[right]
        kept = self._stable[pair] = self._merged(before + piece) == [p for p in (before, piece) if p]
        return kept

    def _merged(self, text: str) -> list[str]:
        """A short text by the rule of BPE: the neighbours whose union scores best are merged, leftmost first."""
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = scores.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _ids_of(self, word: str, last: list[int]) -> list[int]:
        found: list[int] = []
        end = len(word)
        while end:
            i = last[end]
            if i >= 0:
                found.append(i)
                end -= len(self.pieces[i])
                continue
            end -= 1
            if self.byte_ids:
                found += [self.byte_ids[b] for b in reversed(word[end].encode())]
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        return found[::-1]

    # --- texts

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        """Ids of whole texts; none for an empty text, null for null."""
        return self.encode_batch(texts)[0].to_pylist()

    def encode_batch(self, texts: list[str | None]) -> tuple[pa.ListArray, np.ndarray]:
        """Ids of whole texts, and whether all words of each decode to it. Words of some texts are held at a time.

        A text is its words put together, so each distinct word is looked at once.
        """
        lengths, whole = np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        parts: list[np.ndarray] = [np.empty(0, np.int32)]
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size < TOGETHER):
                size += len(texts[upto] or "")
                upto += 1
            lengths[at:upto], ids, whole[at:upto] = self._encode(texts[at:upto])
            parts.append(ids)
            at = upto
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        mask = pa.array([t is None for t in texts], pa.bool_())
        return pa.ListArray.from_arrays(offsets, np.concatenate(parts), mask=mask), whole

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        split = [MARKED_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        number = self.encode_words(set().union(*split))
        counts = np.array([len(words) for words in split], np.int64)
        words = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(counts.sum()))
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.int32)
        sizes = (starts[1:] - starts[:-1])[words]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(starts[words] - (ends - sizes), sizes) + np.arange(total)] if total else np.empty(0, np.int32)
        # Sums for each text of what its words have.
        upto = np.concatenate([[0], np.cumsum(counts)])
        before = np.concatenate([[0], ends])
        wrong = np.concatenate([[0], np.cumsum(np.frombuffer(self.whole, np.int8)[words] == 0)])
        return before[upto[1:]] - before[upto[:-1]], ids, wrong[upto[1:]] == wrong[upto[:-1]]

    def decode(self, ids: list[int] | np.ndarray | None) -> str | None:
        """The text of ids: bytes are put together, marks become spaces, and the mark put in front goes."""
        if ids is None:
            return None
        text = self._text
        whole = b"".join([text[i] for i in ids])
        first = next((i for i in ids if text[i]), None)
        marked = first is not None and self.pieces[first].startswith(MARK)
        return (whole[1:] if marked else whole).decode(errors="replace")

    @functools.cached_property
    def _table(self) -> tuple[pa.Array, np.ndarray]:
        """What each id stands for, and whether it begins with a mark."""
        return pa.array(self._text, pa.large_binary()), np.array([p.startswith(MARK) for p in self.pieces])

    def decode_batch(self, ids: pa.ListArray) -> list[str | None]:
        """The texts of many lists of ids: what all ids stand for is put together at once and cut where the lists end."""
        text, marked = self._table
        offsets = ids.offsets.to_numpy()
        flat = ids.values.slice(offsets[0], offsets[-1] - offsets[0])
        found = text.take(flat)
        starts = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)
        whole = found.buffers()[2] or b""
        cuts = starts[offsets - offsets[0]]
        begins, ends = cuts[:-1], cuts[1:]
        # The first id of a list that stands for something: the last one that begins where the list's bytes do.
        some = np.flatnonzero(begins < ends)
        first = flat.to_numpy()[np.searchsorted(starts, begins[some], "right") - 1]
        begins = begins.copy()
        begins[some] += marked[first]
        view = memoryview(whole)
        there = ids.is_valid().to_pylist()
        return [
            str(view[a:b], "utf-8", "replace") if valid else None
            for a, b, valid in zip(begins.tolist(), ends.tolist(), there, strict=True)
        ]


def _reversed_trie(ids: dict[str, int]) -> dict:
    """The pieces as a trie read from their ends: what can end at a position is found by one walk backwards."""
    root: dict = {}
    for piece, i in ids.items():
        node = root
        for letter in reversed(piece):
            node = node.setdefault(letter, {})
        node[""] = i
    return root


def _is_bpe(model: bytes) -> bool:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    kind, normalizer = proto.trainer_spec.model_type, proto.normalizer_spec
    if kind not in (1, 2) or normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces:
        raise ValueError("a BPE or unigram model that takes texts as they are")
    return kind == 2


@functools.lru_cache(1)
def _codec(model: bytes, remembered: int = REMEMBERED) -> PieceCodec:
    """The codec of a worker; one model at a time."""
    return PieceCodec(model, remembered)


def encode(
    docs: DataFrame,
    model: bytes,
    text: str = "text",
    name: str = "ids",
    verified: str | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The rows of ``docs`` with the ids of the whole text as ``array<int>``.

    ``verified`` names a column that tells whether the ids decode to the text: whether those of each of its words do.

    A null text has null ids, an empty one none; every other text decodes to itself (where it has the mark character
    itself, to a space). Rows are encoded where they are read and nothing is exchanged; a worker remembers ``remembered``
    words that it has met. An existing column of that name is replaced.
    """
    docs = docs.drop(name, *([verified] if verified else []))
    place = docs.columns.index(text)
    added = [T.StructField(name, T.ArrayType(T.IntegerType()))]
    added += [T.StructField(verified, T.BooleanType())] if verified else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, remembered)
        for batch in batches:
            texts = batch[place].to_pylist()
            ids, whole = codec.encode_batch(texts)
            columns = [*batch.columns, ids]
            if verified:
                columns.append(pa.array(whole, pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(f.name for f in added)])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, *added]))


def decode(docs: DataFrame, model: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows of ``docs`` with the text of their ids; null for null. An existing column of that name is replaced."""
    docs = docs.drop(name)
    place = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = codec.decode_batch(batch[place])
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))
