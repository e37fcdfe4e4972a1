import pytest
from pyspark.sql import functions as F

from termloom import build_index, search_batch
from termloom.operators import bloom, querying


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_all_wanted_rows_pass_and_few_others(spark, n):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("term"), F.lit(1).alias("_x"))
    wanted = rows.where(F.col("term").cast("long") < n)
    found = bloom.passing(rows, bloom.filter_of(wanted, "term"))
    assert found.columns == rows.columns
    kept = {r["term"] for r in found.collect()}
    assert {str(i) for i in range(n)} <= kept
    assert len(kept) <= n + 0.08 * (20_000 - n) and found.count() == len(kept)


def test_a_full_filter_is_bounded_and_still_right(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_WORDS", 4)
    rows = spark.range(3000).select(F.col("id").cast("string").alias("term"))
    made = bloom.filter_of(rows, "term")
    assert made.words == 4 and made.bits.count() <= 4
    assert bloom.passing(rows, made).count() == 3000


def test_null_keys_are_not_matched(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "term string")
    kept = bloom.passing(rows, bloom.filter_of(rows.where("term = 'a'"), "term")).collect()
    assert ("a",) in kept and ("b",) not in kept


def test_only_matching_postings_are_exchanged(spark, make_corpus):
    texts = [f"only{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} common{chr(97 + i % 3)}" for i in range(600)]
    index = build_index(make_corpus(*texts), validate=False).once()
    queries = spark.createDataFrame([(1, "onlyaa commona"), (2, "onlybc")], "query_id int, text string")
    known = querying.known_terms(querying.query_terms(queries), index.vocab, small=False)
    exact = querying.matching_postings(index.postings, known, small=True).count()
    passed = bloom.passing(index.postings, bloom.filter_of(known, "term")).count()
    # Every matching posting, and a few in a hundred of the others.
    assert exact <= passed <= exact + 0.08 * (1200 - exact)
    found = [sorted(map(tuple, search_batch(index, queries, 5, broadcast=b).collect())) for b in (False, None)]
    assert found[0] == found[1]
