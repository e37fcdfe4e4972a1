import math

import pytest
from pyspark.sql import functions as F

from termloom import build_index
from termloom.operators import skew


def pairs(frame, key, value):
    return {r[key]: r[value] for r in frame.collect()}


def test_statistics_of_the_micro_corpus(micro):
    index = build_index(micro)
    assert index.stats.first().asDict() == {"n_docs": 3, "total_tokens": 9, "avgdl": 3.0}
    assert pairs(index.docs, "id", "doc_length") == {"1": 3, "2": 2, "3": 4}
    assert {(r["id"], r["term"]): r["tf"] for r in index.postings.collect()} == {
        ("1", "cat"): 2,
        ("1", "dog"): 1,
        ("2", "dog"): 1,
        ("2", "bird"): 1,
        ("3", "fish"): 3,
        ("3", "bird"): 1,
    }
    assert pairs(index.vocab, "term", "df") == {"bird": 2, "cat": 1, "dog": 2, "fish": 1}
    assert pairs(index.vocab, "term", "idf") == pytest.approx(
        {"bird": math.log(1.5), "cat": math.log(3), "dog": math.log(1.5), "fish": math.log(3)}
    )
    assert pairs(index.vocabulary(), "term", "word_id") == {"bird": 0, "cat": 1, "dog": 2, "fish": 3}
    assert index.summary().first().asDict() == {
        "n_docs": 3,
        "total_tokens": 9,
        "avgdl": 3.0,
        "n_terms": 4,
        "n_postings": 6,
    }


def test_normal_idf(micro):
    index = build_index(micro, idf_type="normal")
    assert pairs(index.vocab, "term", "idf") == {"bird": 0.5, "cat": 1.0, "dog": 0.5, "fish": 1.0}


def test_average_length_is_rounded_down_unless_exact(make_corpus):
    corpus = make_corpus("a b c", "d e")
    assert build_index(corpus).stats.first()["avgdl"] == 2.0
    assert build_index(corpus, avgdl="exact").stats.first()["avgdl"] == 2.5


def test_empty_and_tokenless_documents(make_corpus):
    index = build_index(make_corpus("", "123", "  a b"))
    assert index.stats.first().asDict() == {"n_docs": 3, "total_tokens": 4, "avgdl": 1.0}
    assert pairs(index.vocab, "term", "df") == {"": 2, "a": 1, "b": 1}
    assert pairs(index.docs, "id", "doc_length") == {"1": 1, "2": 0, "3": 3}
    assert {r["id"] for r in index.vectors().collect()} == {"1", "3"}
    cleaned = build_index(make_corpus("", "123", "  a b"), drop_empty=True)
    assert cleaned.stats.first().asDict() == {"n_docs": 3, "total_tokens": 2, "avgdl": 0.0}
    assert set(pairs(cleaned.vocab, "term", "df")) == {"a", "b"}


def test_no_documents(spark, make_corpus):
    index = build_index(make_corpus("a").where("false"))
    assert index.stats.first().asDict() == {"n_docs": 0, "total_tokens": 0, "avgdl": 0.0}
    assert index.vocabulary().collect() == []


def test_vectors(micro):
    rows = {r["id"]: r for r in build_index(micro, idf_type="normal").vectors().collect()}
    assert [tuple(e) for e in rows["1"]["vector"]] == [(1, 2.0), (2, 0.5)]
    assert [tuple(e) for e in rows["3"]["vector"]] == [(0, 0.5), (3, 3.0)]
    assert (rows["3"]["title"], rows["3"]["url"], rows["3"]["doc_length"]) == ("C", "u/3", 4)


def test_large_vocabulary_is_joined_by_exchange(tables_corpus, monkeypatch):
    index = build_index(tables_corpus, validate=False)

    def found():
        weights = {(r["id"], r["term"]): r["tfidf"] for r in index.tfidf_postings().collect()}
        vectors = {r["id"]: [tuple(e) for e in r["vector"]] for r in index.vectors().collect()}
        return weights, vectors

    broadcast = found()
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 10)
    plan = index.tfidf_postings()._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert found() == broadcast
    assert len(broadcast[0]) == 50193 and len(broadcast[1]) == 200


def test_counts_add_up(tables_corpus):
    index = build_index(tables_corpus)
    stats = index.stats.first()
    totals = index.postings.agg(F.sum("tf").alias("tf"), F.count("*").alias("rows")).first()
    assert totals["tf"] == stats["total_tokens"]
    vocab = index.vocab.agg(F.max("df").alias("top"), F.min("df").alias("low"), F.sum("df").alias("rows")).first()
    assert 1 <= vocab["low"] and vocab["top"] <= stats["n_docs"]
    assert vocab["rows"] == totals["rows"]


def test_word_ids_do_not_depend_on_partitions(spark, tables_corpus):
    expected = None
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found = pairs(build_index(tables_corpus, validate=False).vocabulary(), "term", "word_id")
            expected = expected or {t: i for i, t in enumerate(sorted(found, key=lambda t: t.encode()))}
            assert found == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_vectors_of_kept_texts_group_by_number(make_corpus):
    index = build_index(make_corpus("the cat cat", "the dog", "123")).once()
    grouped = index.vectors()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [doc#" in grouped and "Aggregate [id#" not in grouped  # long numbers, not texts, are sorted
    assert {r["id"]: len(r["vector"]) for r in index.vectors(every=True).collect()} == {"1": 2, "2": 2, "3": 0}


def test_rows_are_told_by_a_set_before_single_equalities(spark):
    from termloom.plans.index import equals_any

    values = [f"w{n}" for n in range(100)]
    rows = spark.createDataFrame([("w7",), ("other",)], "term string").where(equals_any("term", values))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and plan.index("INSET") < plan.index(" = w99")
    assert [r["term"] for r in rows.collect()] == ["w7"]
    assert rows.where(equals_any("term", [])).collect() == []


def test_vocabulary_of_kept_texts_is_not_counted_again(make_corpus):
    index = build_index(make_corpus("the cat cat", "the dog", "123")).once()
    assert "Aggregate" not in index.vocab._jdf.queryExecution().optimizedPlan().toString()
    assert {r["term"]: r["df"] for r in index.vocab.collect()} == {"the": 2, "cat": 1, "dog": 1}
