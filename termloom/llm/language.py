"""Language of texts: a model learned from labelled texts, scripts, and Viterbi over words with a switching penalty."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.tables import limit_batches, map_batches

# A word is a run of letters.
LETTERS = re.compile(r"[^\W\d_]+")

# The main Unicode ranges of each script; letters outside them are of the script "other".
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF),
    ("tibetan", 0x0F00, 0x0FFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x2FFFF),
)

# Bounds of the model: labelled rows learned from for each language, languages, and letter groups for each language.
TRAINING_ROWS = 2000
MOST_LANGUAGES = 1024
MOST_GRAMS = 8000
# A language is a candidate for a script that has this share of its letters.
SCRIPT_SHARE = 0.01
# What a change of language between two words costs, in nats.
SWITCH = 12.0
# Words times languages that are decoded together, and words a task remembers.
BLOCK = 8_000_000
REMEMBERED = 500_000
# Characters of texts that are split into words together.
TOGETHER = 1 << 21


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    grams: dict[str, int]  # row of each letter group in scores
    scores: np.ndarray  # log probability by group (the last row: unknown groups) and language
    scripts: dict[str, tuple[bool, ...]]  # candidate languages by script


def script_of(letter: str) -> str:
    code = ord(letter)
    return next((name for name, low, high in SCRIPTS if low <= code <= high), "other")


def grams_of(word: str) -> list[str]:
    """Groups of three letters of a lower-cased word with its ends marked."""
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text leaves 2 when divided by 4. False for null."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id: str = "doc_id",
    rows: int = TRAINING_ROWS,
    grams: int = MOST_GRAMS,
    languages: int = MOST_LANGUAGES,
) -> LanguageModel:
    """A model from the rows that have an id, a text and a language and are not held out.

    About ``rows`` rows of each language are used, whole, chosen by a hash of the id; their groups of three letters are
    counted in Spark and the commonest ``grams`` of each language kept. Labels of more than ``languages`` languages are
    refused with a ``ValueError`` (none is left out in silence), so what comes to the driver is bounded by these three
    numbers.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(id).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(id))
    counts = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
    most = counts.limit(languages + 1).collect()
    if len(most) > languages:
        raise ValueError(f"labels of more than {languages} languages: raise languages if so many are meant")
    names = tuple(sorted(r["lang"] for r in most))
    if not names:
        return LanguageModel((), {}, np.zeros((1, 0)), {})
    share = {r["lang"]: min(1.0, rows / r["n"]) for r in most}
    draw = F.pmod(F.xxhash64(F.col(id)), F.lit(1 << 30)) / float(1 << 30)
    rates = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
    chosen = known.where(draw < F.element_at(rates, F.col(lang))).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for name, value in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                by_lang.setdefault(name, Counter()).update(LETTERS.findall(value.lower()))
            found: Counter = Counter()
            for name, words in by_lang.items():
                for word, times in words.items():
                    found[name, f"script:{script_of(word[0])}"] += times * len(word)
                    for gram in grams_of(word):
                        found[name, gram] += times
            keys = list(found)
            columns = [[k[0] for k in keys], [k[1] for k in keys], [found[k] for k in keys]]
            types = (pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "gram", "n"])

    limit_batches(spark)
    counted = chosen.mapInArrow(count, "lang string, gram string, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A group is the distinct letter groups of a language's sample.
    order = Window.partitionBy("lang", F.length("gram") > 3).orderBy(F.desc("n"), "gram")
    kept = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= grams)
    return _model(names, [(r["lang"], r["gram"], r["n"]) for r in kept.select("lang", "gram", "n").collect()])


def _model(names: tuple[str, ...], counts: list[tuple[str, str, int]]) -> LanguageModel:
    place = {name: i for i, name in enumerate(names)}
    letters = {g: i for i, g in enumerate(sorted({g for _, g, _ in counts if not g.startswith("script:")}))}
    table = np.zeros((len(letters) + 1, len(names)))
    scripts: dict[str, list[int]] = {}
    for name, gram, n in counts:
        if gram.startswith("script:"):
            scripts.setdefault(gram[7:], [0] * len(names))[place[name]] += n
        else:
            table[letters[gram], place[name]] = n
    table += 0.5
    scores = np.log(table / table.sum(axis=0))
    total = np.maximum(1, np.sum(list(scripts.values()), axis=0)) if scripts else 1
    candidates = {s: tuple((np.array(n) >= SCRIPT_SHARE * total) & (np.array(n) > 0)) for s, n in scripts.items()}
    return LanguageModel(names, letters, scores, {s: c for s, c in candidates.items() if any(c)})


class Identifier:
    """Labels words with languages; kept by a task for all its texts."""

    def __init__(self, model: LanguageModel, switch: float = SWITCH):
        self.model = model
        self.switch = switch
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def _learn_words(self, words: set[str]) -> None:
        if len(self.rows) > REMEMBERED:
            self.rows, self.scores = {}, self.scores[:0]
        fresh = [w for w in words if w not in self.rows]
        if not fresh:
            return
        get, unknown = self.model.grams.get, len(self.model.grams)
        found, starts = [], []
        for word in fresh:
            starts.append(len(found))
            found += [get(g, unknown) for g in grams_of(word.lower())]
        scores = np.add.reduceat(self.model.scores[np.array(found)], np.array(starts), axis=0)
        # A word of one script can only be of the languages that use it; a script that nobody uses tells nothing.
        everyone = (True,) * len(self.model.languages)
        allowed = np.array([self.model.scripts.get(script_of(w[0]), everyone) for w in fresh])
        scores[~allowed] -= 1e4
        for word in fresh:
            self.rows[word] = len(self.rows)
        self.scores = np.concatenate([self.scores, scores])

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The language of each word of each text, as numbers."""
        self._learn_words({w for words in texts for w in words})
        row = self.rows
        out: list[np.ndarray] = [np.empty(0, np.int16)] * len(texts)
        order = sorted((i for i, words in enumerate(texts) if words), key=lambda i: -len(texts[i]))
        at = 0
        while at < len(order):  # texts of like length together, a bounded number of words at a time
            block, size = [], 0
            while at < len(order) and (not block or size < BLOCK // len(self.model.languages)):
                block.append(order[at])
                size += len(texts[order[at]])
                at += 1
            numbers = [np.array([row[w] for w in texts[i]], np.int64) for i in block]
            for i, labels in zip(block, self._viterbi(numbers), strict=True):
                out[i] = labels
        return out

    def _viterbi(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of texts sorted by falling length; step t handles the t-th word of all that have one."""
        sizes = np.array([len(t) for t in texts])
        longest = int(sizes[0])
        active = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t words
        starts = np.concatenate([[0], np.cumsum(active)])
        words = np.empty(int(starts[-1]), np.int64)
        for k, text in enumerate(texts):
            words[starts[: len(text)] + k] = text
        switched = np.zeros((len(words), self.scores.shape[1]), bool)
        source = np.zeros(len(words), np.int16)
        value = self.scores[words[: active[0]]]
        last = np.zeros(len(texts), np.int16)
        for t in range(1, longest + 1):
            n = active[t] if t < longest else 0
            best = value.argmax(axis=1)
            last[n : len(value)] = best[n:]
            if not n:
                break
            value, best = value[:n], best[:n]
            top = value[np.arange(n), best]
            part = slice(starts[t], starts[t] + n)
            other = (top - self.switch)[:, None]
            switched[part] = value < other
            source[part] = best
            value = np.maximum(value, other) + self.scores[words[part]]
        labels = np.empty(len(words), np.int16)
        state = np.zeros(len(texts), np.int16)
        n = 0
        for t in range(longest - 1, -1, -1):
            more = active[t]
            state[n:more] = last[n:more]
            if t + 1 < longest and n:
                part = slice(starts[t + 1], starts[t + 1] + n)
                moved = switched[part][np.arange(n), state[:n]]
                state[:n] = np.where(moved, source[part], state[:n])
            labels[starts[t] : starts[t] + more] = state[:more]
            n = more
        return [labels[starts[:size] + k] for k, size in enumerate(sizes)]


FOUND = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType().add("lang", "string").add("start", "integer").add("end", "integer")),
        ),
    ]
)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", switch: float = SWITCH, name: str = "language"
) -> DataFrame:
    """The rows of ``docs`` with a column ``name``, a struct ``(lang, score, spans)``; only the text is looked at.

    ``lang`` is the language with most letters (``und`` if the text is null or has no letter, or nothing was learned),
    ``score`` its share of the letters (0 for ``und``), and ``spans`` the stretches of one language as ``(lang, start,
    end)`` in code points, which together cover the text. Texts are read whole, in the task that has them. An existing
    column of that name is replaced.
    """
    docs = docs.drop(name)
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the limits of learn()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value, switch)
        kind = pa.struct(
            [("lang", pa.string()), ("score", pa.float64()),
             ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]
        )
        for batch in batches:
            found = pa.array(described(identifier, batch[place].to_pylist()), kind)
            yield pa.record_batch([*batch.columns, found], [*batch.schema.names, name])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, FOUND)]))


def described(identifier: Identifier, texts: list[str | None]) -> list[dict]:
    """What :func:`identify` finds in each text; words of texts of like length are held together, a bounded number."""
    out: list[dict] = [{}] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i] or ""))
    at = 0
    while at < len(order):
        upto, size = at, 0
        while upto < len(order) and (upto == at or size < TOGETHER):
            size += len(texts[order[upto]] or "")
            upto += 1
        some = order[at:upto]
        for i, found in zip(some, _described(identifier, [texts[i] for i in some]), strict=True):
            out[i] = found
        at = upto
    return out


def _described(identifier: Identifier, texts: list[str | None]) -> list[dict]:
    names = identifier.model.languages
    words = [LETTERS.findall(t) if t and names else [] for t in texts]
    out = []
    for text, own, labels in zip(texts, words, identifier.label(words) if names else words, strict=True):
        if not own:
            whole = [{"lang": "und", "start": 0, "end": len(text)}] if text else []
            out.append({"lang": "und", "score": 0.0, "spans": whole})
            continue
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        letters = np.bincount(labels, weights=sizes, minlength=len(names))
        best = int(letters.argmax())
        changes = np.flatnonzero(np.diff(labels)) + 1
        begins = [0]
        if len(changes):
            at = [m.start() for m in LETTERS.finditer(text)]
            begins += [at[i] for i in changes]
        of = [names[labels[i]] for i in (0, *changes)]
        spans = [{"lang": n, "start": a, "end": b} for n, a, b in zip(of, begins, [*begins[1:], len(text)], strict=True)]
        out.append({"lang": names[best], "score": float(letters[best] / sizes.sum()), "spans": spans})
    return out
