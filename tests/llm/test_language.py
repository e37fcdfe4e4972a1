import zlib

import numpy as np
import pytest

from termloom.llm import language, registered
from termloom.llm.language import Identifier, LanguageModel

SCHEMA = "doc_id long, text string, lang string"


def best_value(scores, switch):
    """The value of the best labelling, trying every pair of languages at every word."""
    value = scores[0]
    for row in scores[1:]:
        value = np.max(value[:, None] - switch * (1 - np.eye(len(row))), axis=0) + row
    return value.max()


def test_labels_are_optimal():
    rng = np.random.default_rng(1)
    identifier = Identifier(LanguageModel(("a", "b", "c"), {}, np.zeros((1, 3)), {}), switch=2.0)
    identifier.scores = rng.normal(size=(50, 3)) * 2
    texts = [rng.integers(0, 50, n) for n in sorted(rng.integers(1, 30, 40), reverse=True)]
    for text, labels in zip(texts, identifier._viterbi(texts), strict=True):
        own = identifier.scores[text]
        value = own[np.arange(len(text)), labels].sum() - 2.0 * (np.diff(labels) != 0).sum()
        assert value == pytest.approx(best_value(own, 2.0))


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = registered.op9_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    rows = [r for r in out.collect() if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_text_has_spans(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    mixed = docs["en"][:600] + "\n" + docs["de"][:900]
    row = language.identify(spark.createDataFrame([(1, mixed, None)], SCHEMA), model).first().language
    assert [s.lang for s in row.spans] == ["en", "de"]
    assert abs(row.spans[0].end - 600) < 40
    assert (row.spans[0].start, row.spans[-1].end) == (0, len(mixed))
    assert row.lang == "de" and 0.5 < row.score < 0.7


def test_edges(spark, model):
    texts = [None, "", "123 !?", "the", "漢字", "the " * 200_000]
    rows = [(i, t, "fr") for i, t in enumerate(texts)] + [(None, "the", None), (3, "the", "fr")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", language string")
    out = {(r.doc_id, r.text): r.language for r in language.identify(frame, model).collect()}
    assert [(out[i, texts[i]].lang, out[i, texts[i]].score) for i in range(3)] == [("und", 0.0)] * 3
    assert out[3, "the"].lang == out[5, texts[5]].lang == "en"
    assert out[4, "漢字"].lang in model.languages


def test_script_narrows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("abc abd", "la"), ("абв где", "ru"), ("αβγ", "el")] * 8)]
    found = language.learn(spark.createDataFrame(rows, SCHEMA))
    text = spark.createDataFrame([(100, "zzz", None), (101, "яяя", None), (102, "ω", None)], SCHEMA)
    assert [r.language.lang for r in language.identify(text, found).orderBy("doc_id").collect()] == ["la", "ru", "el"]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = language.learn(empty)
    assert language.identify(empty, found).collect() == []
    some = spark.createDataFrame([(2, "text", None)], SCHEMA)
    assert language.identify(some, language.learn(some)).first().language.lang == "und"


def test_more_languages_than_allowed_are_refused(spark):
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(20)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs, languages=3)
