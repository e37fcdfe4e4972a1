import random

import pytest
from pyspark.sql import functions as F

from termloom import build_index, search, search_batch
from termloom.functions import scoring
from termloom.operators import querying
from termloom.plans import early
from termloom.plans.index import buckets_of
from termloom.session import durable


def random_corpus(make_corpus, seed, n=300, words=150):
    rng = random.Random(seed)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    texts = [" ".join(rng.choices(names, weights, k=rng.choice([3, 10, 40, 200]))) for _ in range(n)]
    # Repeated texts tie.
    return make_corpus(*texts, *texts[:60]), names, rng


@pytest.fixture(scope="module")
def stored(spark, make_corpus, tmp_path_factory):
    corpus, names, rng = random_corpus(make_corpus, 5)
    queries = [(i, " ".join(rng.choices(names, k=rng.randrange(1, 14)))) for i in range(25)] + [(99, "zzzz")]
    index = build_index(corpus).save(str(tmp_path_factory.mktemp("early") / "index"), buckets=16)
    return index, spark.createDataFrame(queries, "query_id int, text string")


def rows(frame):
    columns = [c for c in ("query_id", "rank", "id") if c in frame.columns]
    return sorted(map(tuple, frame.select(*columns, F.round("relevance", 9)).collect()))


@pytest.mark.parametrize("solver", ["BM25", "Basic"])
@pytest.mark.parametrize("n", [1, 5, 40, 500])
def test_equals_full_scoring_with_ties(stored, solver, n):
    index, queries = stored
    assert rows(search_batch(index, queries, n, solver, early=True)) == rows(search_batch(index, queries, n, solver, early=False))


@pytest.mark.parametrize("solver", ["BM25", "Basic"])
def test_single_query(stored, solver):
    index, queries = stored
    for text in [r["text"] for r in queries.where("query_id < 4").collect()] + ["zzzz"]:
        assert rows(search(index, text, 7, solver, early=True)) == rows(search(index, text, 7, solver, early=False))


@pytest.mark.parametrize("how", [{"idf_type": "normal"}, {"avgdl": "exact"}])
def test_other_indexes(spark, make_corpus, tmp_path, how):
    corpus, names, rng = random_corpus(make_corpus, 7, n=80)
    index = build_index(corpus, **how).save(str(tmp_path / "index"), buckets=4)
    queries = spark.createDataFrame([(i, " ".join(rng.choices(names, k=6))) for i in range(6)], "query_id int, text string")
    for solver in ("BM25", "Basic"):
        assert rows(search_batch(index, queries, 3, solver, early=True)) == rows(search_batch(index, queries, 3, solver, early=False))


def test_what_has_no_bounds_takes_the_full_route(stored, spark, tables_corpus):
    index, queries = stored
    assert not early.possible(index, scoring.bm25(1.2, 0.5), 5)
    assert not early.possible(build_index(tables_corpus, validate=False), "BM25", 5)
    assert not early.possible(index, "BM25", 0)
    custom = scoring.bm25(1.2, 0.5)
    assert rows(search_batch(index, queries, 3, custom, early=True)) == rows(search_batch(index, queries, 3, custom))


def test_few_pairs_are_scored_in_full(spark, tmp_path):
    """Under a tenth of the pairs of the benchmark's queries and the documents that have one of their words."""
    import __spark_entry__

    tables = "/root/testdata/sf0.1"
    index = build_index(__spark_entry__._corpus(spark, tables), validate=False).save(str(tmp_path / "index"), buckets=16)
    terms = durable(querying.query_terms(__spark_entry__._benchmark(spark, tables)))
    known = querying.known_terms(terms, index.vocab, small=True, more=("max_tf", "peak"))
    matched = querying.matching_postings(index.postings, known, small=True)
    pairs = matched.where("idf > 0").select("query_id", "id").distinct().count()
    for solver in ("BM25", "Basic"):
        found = early.best_candidates(index, known, solver, 10)
        assert found.pairs.count() < pairs / 10


def test_bounds_hold_for_every_posting(stored):
    index, _ = stored
    words = index.vocab.select("term", "idf", "max_tf", "peak", "df", "first_bucket", "last_bucket", "bucket_bits")
    rows = index.postings.join(words, "term").withColumn("qtf", F.lit(2))
    for solver in ("BM25", "Basic"):
        scored = querying.term_scores(rows, index.avgdl, {"score": solver})
        above = scored.where(F.col("score") > scoring.largest_score(solver) * (1 + 1e-12))
        assert above.count() == 0
    bucket = F.pmod(F.hash("id"), F.lit(index.buckets))
    wrong = rows.where(~bucket.between(F.col("first_bucket"), F.col("last_bucket")))
    assert wrong.count() == 0
    assert rows.groupBy("term").agg(F.count("*").alias("n"), F.first("df").alias("df")).where("n <> df").count() == 0


def files_read(frame):
    """Files that the scan of postings has opened, by Spark's own count."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_a_rare_word_opens_one_file(spark, make_corpus, tmp_path):
    texts = [f"common only{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    index = build_index(make_corpus(*texts), validate=False).save(str(tmp_path / "index"), buckets=16)
    narrow = index.restricted(["onlyaa"])
    assert files_read(narrow.postings.select("id", "tf")) == 1
    assert files_read(index.restricted(["onlyaa", "onlybb", "zzzz"]).postings.select("id")) <= 2
    assert files_read(index.restricted(["common"]).postings.select("id")) == 16
    assert narrow.postings.count() == 1
    assert [r["id"] for r in search(index, "onlyaa", 3).collect()] == ["1"]
    assert search(index, "zzzz", 3).collect() == []


def test_buckets_of_terms():
    def row(first, last, bits):
        return {"first_bucket": first, "last_bucket": last, "bucket_bits": bits}

    assert buckets_of([row(3, 3, 8)], 200) == [3]
    assert buckets_of([row(3, 140, 8 | 1 << 12)], 200) == [3, 12, 67, 76, 131, 140]
    assert buckets_of([row(63, 63, -(1 << 63))], 64) == [63]
    assert buckets_of([], 8) == []
    assert buckets_of([row(None, None, None)], 3) == [0, 1, 2]
