import itertools
import random
import re

import pytest

from termloom import build_index
from termloom.operators import skew
from termloom.plans.phrases import PhraseIndex, documents_containing, phrase_index, phrase_search, save_phrase_index

ITEMS = "query_id int, text string"


def words(text):
    return [w.lower() for w in re.split(r"[\W\d_]+", text or "") if w]


def occurrences(texts, phrases):
    """All phrases against all places of all texts."""
    found = set()
    for (q, phrase), (i, text) in itertools.product(phrases, texts):
        wanted, there = words(phrase), words(text)
        n = sum(there[k : k + len(wanted)] == wanted for k in range(len(there) - len(wanted) + 1)) if wanted else 0
        if n:
            found.add((q, i, n))
    return found


def holding(texts, items):
    return {(q, i) for (q, item), (i, text) in itertools.product(items, texts) if item is not None and item in text}


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(5)
    some = ["a", "b", "ab", "aba", "ba", "the", "Theme", "c"]
    between = [" ", " ", " ", ", ", " - ", "1"]
    texts = []
    for i in range(120):
        text = "".join(w + rng.choice(between) for w in rng.choices(some, [8, 4, 2, 1, 1, 9, 1, 1], k=rng.randrange(0, 25)))
        texts.append((f"d{i:03}", rng.choice(["", " ", "«"]) + text))
    items = [(n, t[s : s + k]) for n in range(150) for t in [rng.choice(texts)[1]] for s in [rng.randrange(len(t) + 1)] for k in [rng.randrange(0, 14)]]
    return texts, items + [(900, "a a a"), (901, "nowhere"), (902, "a nowhere b"), (903, None), (904, "the the"), (905, " - ")]


def test_phrases_equal_brute_force(spark, make_corpus, random_texts):
    texts, phrases = random_texts
    found = phrase_search(phrase_index(make_corpus(*texts)), spark.createDataFrame(phrases, ITEMS)).collect()
    assert {tuple(r) for r in found} == occurrences(texts, phrases) and len(found) == len({(r[0], r[1]) for r in found})


def test_containing_equals_brute_force(spark, make_corpus, random_texts):
    texts, items = random_texts
    corpus = make_corpus(*texts)
    found = documents_containing(corpus, phrase_index(corpus), spark.createDataFrame(items, ITEMS)).collect()
    assert {tuple(r) for r in found} == holding(texts, items) and len(found) == len(set(found))


def test_containing_by_a_plain_index(spark, make_corpus, random_texts):
    texts, items = random_texts
    corpus = make_corpus(*texts)
    found = documents_containing(corpus, build_index(corpus).once(), spark.createDataFrame(items, ITEMS)).collect()
    assert {tuple(r) for r in found} == holding(texts, items) and len(found) == len(set(found))


def test_exchanged_joins_give_the_same(spark, make_corpus, random_texts, monkeypatch):
    texts, items = random_texts
    corpus, frame = make_corpus(*texts), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    index = phrase_index(corpus)
    assert {tuple(r) for r in phrase_search(index, frame).collect()} == occurrences(texts, items)
    assert {tuple(r) for r in documents_containing(corpus, index, frame).collect()} == holding(texts, items)


def test_saved(spark, make_corpus, random_texts, tmp_path):
    texts, phrases = random_texts
    path, corpus = str(tmp_path / "phrases"), make_corpus(*texts)
    save_phrase_index(corpus, path, parts=3)
    index, frame = PhraseIndex.load(spark, path), spark.createDataFrame(phrases, ITEMS)
    assert {tuple(r) for r in phrase_search(index, frame).collect()} == occurrences(texts, phrases)
    with pytest.raises(FileExistsError):
        save_phrase_index(corpus, path)
    with pytest.raises(FileNotFoundError):
        PhraseIndex.load(spark, f"{path}/vocab")


def test_empty_tables_and_letters_of_other_scripts(spark, make_corpus):
    corpus = make_corpus(("1", "ΟΔΟΣ ΑΣΑ x"), ("2", ""), ("3", "…"))
    items = spark.createDataFrame([(1, "ΟΣ"), (2, "Σ ΑΣ"), (3, "…"), (4, ""), (5, "ΑΣ")], ITEMS)
    found = {tuple(r) for r in documents_containing(corpus, phrase_index(corpus), items).collect()}
    assert found == {(1, "1"), (2, "1"), (3, "3"), (4, "1"), (4, "2"), (4, "3"), (5, "1")}
    nothing = corpus.where("id = 'none'")
    assert documents_containing(nothing, phrase_index(nothing), items).count() == 0
    assert documents_containing(corpus, phrase_index(corpus), items.where("query_id = 0")).count() == 0
    assert phrase_search(phrase_index(nothing), items).count() == 0
