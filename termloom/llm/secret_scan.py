"""Secrets in texts: regular-expression rules behind a trigram index."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.tables import map_batches
from termloom.llm.trigrams import TrigramIndex, candidates, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping, ``re.ASCII``) whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# What the base scan looks for.
BASE = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# Further published token formats.
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abp]-[A-Za-z0-9-]+", least=15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", least=40),
)
RULES = BASE + MORE

SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


class _Scanner:
    """The rules, compiled in a task."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        # A run of one character class is only looked at where it is long enough.
        self.compiled = [re.compile(_long_runs(rule), re.ASCII) for rule in rules]
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        self.index = TrigramIndex(set().union(*map(trigrams_of, self.queries)))

    def scan(self, texts: list[str], encoded: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its ``(start, rule number, end)`` in code points, ascending."""
        postings = self.index.postings(encoded)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, pattern, query) in enumerate(zip(self.rules, self.compiled, self.queries, strict=True)):
            for row in candidates(query, postings, len(texts)):
                for m in pattern.finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), number, m.end()))
        for spans in found:
            spans.sort()
        return found


def _long_runs(rule: Rule) -> str:
    # One class, repeated: its matches are the maximal runs, so the least length can be part of the pattern.
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) else rule.pattern


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", name: str = "secrets") -> DataFrame:
    """The rows of ``docs`` with a column ``name``, an array of ``(kind, start, end)`` by start, then in the order of the rules.

    Start and end are in code points, end exclusive. Each rule is turned into a Boolean query over the trigrams that a
    match must have. For every block of texts an inverted index of these trigrams is built, the postings are
    intersected, and only the candidates are scanned; a rule without mandatory trigrams scans all texts. A null text
    is empty and a text without secrets has an empty array. Texts are scanned whole, on the executors that read
    them: nothing is exchanged. An existing column of that name is replaced.
    """
    return _scanned(docs, rules, text, None, name)


def redact(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", mark: str = "[REDACTED]", name: str = "secrets"
) -> DataFrame:
    """The rows of ``docs`` with every secret of the text replaced by ``mark``, and ``name`` as in :func:`scan`.

    Overlapping spans are replaced together. A null text stays null.
    """
    return _scanned(docs, rules, text, mark, name)


def _scanned(docs: DataFrame, rules: Sequence[Rule], text: str, mark: str | None, name: str) -> DataFrame:
    docs = docs.drop(name)
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            values = batch[place].to_pylist()
            texts = [v or "" for v in values]
            found = scanner.scan(texts, [t.encode() for t in texts])
            spans = [[{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in row] for row in found]
            columns = batch.columns
            if mark is not None:
                masked = [v and _masked(v, row, mark) for v, row in zip(values, found, strict=True)]
                columns[place] = pa.array(masked, pa.string())
            yield pa.record_batch([*columns, pa.array(spans, kind)], [*batch.schema.names, name])

    return map_batches(docs, run, schema)


def _masked(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def count_of(kind: str):
    """Number of secrets of a kind."""
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def joined(kinds: Sequence[str] | None = None):
    """Spans as ``kind:start:end``, comma-joined."""
    spans = F.col("secrets") if kinds is None else F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
