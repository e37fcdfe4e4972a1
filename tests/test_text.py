import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from termloom.functions.text import analysis, entries, tokens


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("", [""]),
        ("123", []),
        (" .,", []),
        ("  a b", ["", "a", "b"]),
        ("a b.", ["a", "b"]),
        ("a  --  b", ["a", "b"]),
        ("Don't_stop2go", ["don", "t", "stop", "go"]),
        ("ÉCOLE Straße", ["école", "straße"]),
        ("line\none\ttab", ["line", "one", "tab"]),
        ("漢字 かな", ["漢字", "かな"]),
        ("éa", ["e", "a"]),
        ("\U00010400x 1", ["\U00010428x"]),
    ],
)
def test_tokens(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "text string")
    row = frame.select(tokens(F.col("text")).alias("t"), tokens(F.col("text"), drop_empty=True).alias("d")).first()
    assert row["t"] == expected
    assert row["d"] == [w for w in expected if w]


def test_lower_case_follows_the_split(spark):
    """The lower case of a dotted capital I ends in a combining dot, which would separate."""
    frame = spark.createDataFrame([("İx y",)], "text string")
    assert frame.select(tokens(F.col("text")).alias("t")).first()["t"] == ["i̇x", "y"]


def test_final_sigma_is_decided_within_the_word(spark):
    frame = spark.createDataFrame([("ΑΣ.ΑΣΑ",)], "text string")
    assert frame.select(tokens(F.col("text")).alias("t")).first()["t"] == ["ας", "ασα"]


def test_long_run_of_separators(spark):
    text = "a" + "1" * 300_000 + "b" + " " * 300_000
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(tokens(F.col("text")).alias("t")).first()["t"] == ["a", "b"]


def test_whole_corpus_against_python(spark, tables_corpus):
    rows = tables_corpus.select("text", tokens(F.col("text")).alias("t"), analysis(F.col("text")).alias("a")).collect()
    assert len(rows) == 200
    for row in rows:
        expected = re.split(r"[\W\d_]+", row["text"])
        while expected and expected[-1] == "":
            expected.pop()
        expected = [w.lower() for w in expected]
        assert row["t"] == expected
        assert row["a"]["doc_length"] == len(expected)
        assert {e["term"]: e["tf"] for e in row["a"]["terms"]} == {w: expected.count(w) for w in set(expected)}


def test_entries_are_sorted_and_may_be_narrowed(spark):
    frame = spark.createDataFrame([("b a b c",)], "text string")
    narrow = frame.select(analysis(F.col("text"), only=["b", "z"]).alias("a")).first()["a"]
    assert (narrow["doc_length"], [tuple(e) for e in narrow["terms"]]) == (4, [("b", 2)])
    full = frame.select(F.inline(entries(F.col("text"))))
    assert full.columns == ["term", "tf", "doc_length"]
    assert [tuple(r) for r in full.collect()] == [("a", 1, 4), ("b", 2, 4), ("c", 1, 4)]
    described = frame.select(analysis(F.col("text")).alias("a")).first()["a"]
    assert (described["doc_length"], [tuple(e) for e in described["terms"]]) == (4, [("a", 1), ("b", 2), ("c", 1)])


def test_term_counts_need_no_exchange(spark, micro):
    from termloom.operators.statistics import distinct_terms, term_frequency

    for frame in (term_frequency(micro), distinct_terms(micro)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert plan.count("regexp_replace") == 1  # the text is analysed once
        assert "Python" not in plan


# Letters of several scripts (with a dotted capital I and both sigmas), marks, digits, punctuation, blanks, symbols.
ALPHABET = list("aZéßİıΣσςΔжЯ漢かא") + ["\U00010400"] + list("́̇19٣_'-.,/ \t\n  €😀")


def test_random_texts_against_a_model(spark):
    random.seed(7)
    texts = ["".join(random.choices(ALPHABET, k=random.randrange(12))) for _ in range(4000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = frame.select("text", tokens(F.col("text")).alias("t"), analysis(F.col("text")).alias("a")).collect()
    for row in rows:
        words = regex.split(r"[^\p{L}]+", row["text"])
        if row["text"]:
            while words and not words[-1]:
                words.pop()
        words = [w.lower() for w in words]
        assert row["t"] == words, row["text"]
        counts = Counter(words)
        assert [tuple(e) for e in row["a"]["terms"]] == sorted(counts.items(), key=lambda e: e[0].encode())
        assert row["a"]["doc_length"] == len(words)
