"""Boolean trigram queries derived from regular expressions, and an inverted trigram index of a block of texts.

A query is ``True`` (any text may match), a trigram as bytes, or ``("and" | "or", parts)``. It is a necessary condition: a
text that lacks it has no match. Trigrams are of UTF-8 bytes with A-Z lower-cased, for patterns read with ``re.ASCII``.
"""

from __future__ import annotations

import itertools
from re import _constants as sre
from re import _parser as parser

import numpy as np

# Strings of one stretch of a pattern that are told apart; more become an open part of the query.
MOST_STRINGS = 64
# Bytes that are looked at together.
CHUNK = 1 << 20

Query = bool | bytes | tuple
REPEATS = (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT)


def trigram_query(pattern: str) -> Query:
    """The trigrams that every match of a pattern has; ``True`` if there are no mandatory ones."""
    strings, query = _sequence(parser.parse(pattern))
    return _and([query, _having(strings)])


def _and(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _or(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _having(strings: set[bytes] | None) -> Query:
    """The query of texts that contain one of the strings."""
    if strings is None or any(len(s) < 3 for s in strings):
        return True
    return _or([_and([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _sequence(tokens) -> tuple[set[bytes] | None, Query]:
    """The strings a sequence matches, None if they are not few, and a query that holds besides."""
    stretch, closed, queries = {b""}, True, []
    for kind, value in tokens:
        strings, query = _token(kind, value)
        queries.append(query)
        if strings is not None and len(strings) * len(stretch) <= MOST_STRINGS:
            stretch = {a + b for a, b in itertools.product(stretch, strings)}
        else:
            queries.append(_having(stretch))
            stretch, closed = strings or {b""}, False
    return (stretch, _and(queries)) if closed else (None, _and([*queries, _having(stretch)]))


def _token(kind, value) -> tuple[set[bytes] | None, Query]:
    if kind is sre.LITERAL:
        return {chr(value).encode().lower()}, True
    if kind is sre.IN:
        return _characters(value), True
    if kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return {b""}, True
    if kind is sre.SUBPATTERN:
        return _sequence(value[-1])
    if kind is sre.ATOMIC_GROUP:
        return _sequence(value)
    if kind is sre.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in found):
            union = set().union(*(strings for strings, _ in found))
            if len(union) <= MOST_STRINGS:
                return union, True
        return None, _or([_and([query, _having(strings)]) for strings, query in found])
    if kind in REPEATS:
        least, most, inner = value
        strings, query = _sequence(inner)
        if least == 0:
            return ({b""} | strings, True) if most == 1 and strings is not None else (None, True)
        times = {b""}
        for _ in range(least if strings is not None else 0):
            longer = {a + b for a, b in itertools.product(times, strings)}
            if len(longer) > MOST_STRINGS:
                return None, _and([query, _having(times)])
            times = longer
        return (times, query) if strings is not None and most == least else (None, _and([query, _having(times)]))
    return None, True


def _characters(members) -> set[bytes] | None:
    codes: set[int] = set()
    for kind, value in members:
        if kind is sre.LITERAL:
            codes.add(value)
        elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
            codes.update(range(value[0], value[1] + 1))
        else:
            return None
    return {chr(c).encode().lower() for c in codes} if len(codes) <= MOST_STRINGS else None


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """For each wanted trigram, which of the texts have it. One block of texts at a time, so memory is bounded."""

    def __init__(self, trigrams: set[bytes]):
        self.trigrams = sorted(trigrams)
        # Which pairs of bytes begin a wanted trigram; few do, and only there the whole is looked up.
        self._codes = np.array([int.from_bytes(gram, "big") for gram in self.trigrams], np.uint32)
        self._begins = np.zeros(1 << 16, bool)
        self._begins[self._codes >> 8] = True

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Ascending rows by trigram."""
        # 0xFF is not in UTF-8, so nothing is found across the end of a text.
        data = np.frombuffer(b"\xff\xff".join([*texts, b""]).lower(), np.uint8)
        starts = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])]) if texts else np.empty(0, np.int64)
        numbers, rows = [], []
        for at in range(0, max(0, len(data) - 2), CHUNK):
            piece = data[at : at + CHUNK + 2]
            place = np.flatnonzero(self._begins[(piece[:-2].astype(np.uint16) << 8) | piece[1:-1]])
            codes = (piece[place].astype(np.uint32) << 16) | (piece[place + 1].astype(np.uint32) << 8) | piece[place + 2]
            number = np.searchsorted(self._codes, codes).clip(0, max(0, len(self._codes) - 1))
            wanted = self._codes[number] == codes if len(self._codes) else np.zeros(0, bool)
            place, number = place[wanted], number[wanted]
            numbers.append(number.astype(np.uint16) + 1)
            rows.append(np.searchsorted(starts, place + at, "right") - 1)
        number = np.concatenate(numbers) if numbers else np.empty(0, np.uint16)
        row = np.concatenate(rows) if rows else np.empty(0, np.int64)
        return {gram: np.unique(row[number == i]) for i, gram in enumerate(self.trigrams, 1)}


def candidates(query: Query, postings: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    """Rows that meet a query, by intersecting and uniting postings."""
    if query is True:
        return np.arange(rows)
    if isinstance(query, bytes):
        return postings[query]
    found = [candidates(part, postings, rows) for part in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    found.sort(key=len)
    common = found[0]
    for more in found[1:]:
        common = np.intersect1d(common, more, assume_unique=True)
    return common
