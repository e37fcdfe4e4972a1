import pytest
from pyspark.sql import functions as F

from termloom import build_index, result_listing, search, search_batch, write_results
from termloom.functions import scoring
from termloom.operators import querying, skew

COLUMNS = ["rank", "id", "title", "url", "relevance"]


def scores(frame):
    return {r["id"]: r["relevance"] for r in frame.collect()}


def test_both_solvers_by_hand(micro):
    index = build_index(micro)
    basic = search(index, "cat Cat dog", 10, "Basic")
    assert basic.columns == COLUMNS
    assert scores(basic) == pytest.approx({"1": 4.992198, "2": 0.164402}, abs=1e-6)
    assert scores(search(index, "cat Cat dog", 10)) == pytest.approx({"1": 2.053384, "2": 0.486558}, abs=1e-6)
    first = search(index, "cat Cat dog", 10).first()
    assert (first["rank"], first["title"], first["url"]) == (1, "A", "u/1")


def test_query_vectors(spark, micro):
    index = build_index(micro, idf_type="normal")
    terms = querying.query_terms(spark.createDataFrame([(7, "Dog dog cat zzz")], "query_id bigint, text string"))
    for solver, expected in {"Basic": {"dog": 1.0, "cat": 1.0}, "BM25": {"dog": 0.5, "cat": 1.0}}.items():
        rows = querying.query_vector(terms, index.vocab, solver).collect()
        assert {r["term"]: r["q_weight"] for r in rows} == expected
        assert {r["query_id"] for r in rows} == {7}
    with pytest.raises(ValueError):
        querying.query_vector(terms, index.vocab, "other")


def test_word_in_every_document_adds_nothing(make_corpus):
    index = build_index(make_corpus("the cat", "the dog", "the"))
    for solver in ("BM25", "Basic"):
        assert search(index, "the", 10, solver).collect() == []
        assert [r["id"] for r in search(index, "the dog", 10, solver).collect()] == ["2"]


def test_ties_are_kept_in_id_order(make_corpus):
    index = build_index(make_corpus(("b", "cat dog"), ("a", "cat dog"), ("c", "cat dog"), ("d", "bird")))
    assert [r["id"] for r in search(index, "dog", 10).collect()] == ["a", "b", "c"]
    assert [(r["rank"], r["id"]) for r in search(index, "dog", 2).collect()] == [(1, "a"), (2, "b")]


def test_many_copies_of_one_text(spark, make_corpus, tmp_path):
    """A third of the documents are copies: all are found, in id order."""
    copies = [(f"c{i:03d}", "dog cat dog") for i in range(150)]
    index = build_index(make_corpus(*copies, *((f"x{i:03d}", f"word{i} cat") for i in range(300))))
    for searched in (index, index.save(str(tmp_path / "index"))):
        found = [(r["rank"], r["id"]) for r in search(searched, "dog", 500).collect()]
        assert found == [(i + 1, f"c{i:03d}") for i in range(150)]
        batch = search_batch(searched, spark.createDataFrame([(1, "dog")], "query_id int, text string"), 3)
        assert sorted((r["rank"], r["id"]) for r in batch.collect()) == found[:3]


@pytest.mark.parametrize("text", ["zzz", "123", "zzz qqq"])
def test_no_known_word(micro, text):
    result = search(build_index(micro), text, 10)
    assert result.columns == COLUMNS
    assert result.collect() == []


def test_empty_text_finds_the_empty_word(make_corpus):
    index = build_index(make_corpus(" a b", "a", "b c"))
    assert [r["id"] for r in search(index, "", 10).collect()] == ["1"]


def test_n(micro):
    index = build_index(micro)
    assert search(index, "dog", 0).collect() == []
    assert len(search(index, "dog", 1).collect()) == 1
    assert len(search(index, "dog", 50).collect()) == 2
    for bad in (-1, 1.5, "3", True, None, 2**31):
        with pytest.raises(ValueError):
            search(index, "dog", bad)


def test_unknown_solver(micro, spark):
    with pytest.raises(ValueError):
        search(build_index(micro), "dog", 3, "TFIDF")
    with pytest.raises(ValueError):
        search_batch(build_index(micro), spark.createDataFrame([], "query_id int, text string"), 3, "bm25")
    with pytest.raises(ValueError):
        scoring.bm25(b=2)
    with pytest.raises(ValueError):
        search(build_index(micro), None, 3)


def test_own_solver(micro):
    index = build_index(micro)

    def count(tf, idf, qtf, doc_length, avgdl):
        return tf.cast("double")

    assert scores(search(index, "cat dog", 5, count)) == {"1": 3.0, "2": 1.0}


def test_average_length_of_zero_scores_nothing(make_corpus):
    index = build_index(make_corpus("a", "1", "2"))
    assert index.stats.first()["avgdl"] == 0.0
    assert search(index, "a", 5).collect() == []
    assert len(search(index, "a", 5, "Basic").collect()) == 1


QUERIES = "The thorreou of eauouon, and THE ouen", "Is and of the", "la le de eauou"


def test_batch_equals_single(spark, tables_corpus):
    index = build_index(tables_corpus, validate=False)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id bigint, text string")
    batch = search_batch(index, queries, 7).collect()
    for query_id, text in enumerate(QUERIES):
        single = [(r["rank"], r["id"], round(r["relevance"], 9)) for r in search(index, text, 7).collect()]
        rows = [r for r in batch if r["query_id"] == query_id]
        assert sorted((r["rank"], r["id"], round(r["relevance"], 9)) for r in rows) == single


def test_prefix_and_long_lists(spark, tables_corpus):
    """A list longer than a window keeps per task is numbered by a distributed sort, with the same result."""
    index = build_index(tables_corpus, validate=False)
    short = [r["id"] for r in search(index, QUERIES[0], 20).collect()]
    longer = [r["id"] for r in search(index, QUERIES[0], 21).collect()]
    assert longer[:20] == short
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    try:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
        assert [r["id"] for r in search(index, QUERIES[0], 20).collect()] == short
        queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id bigint, text string")
        by_sort = search_batch(index, queries, 6).collect()
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
    by_window = search_batch(index, queries, 6).collect()
    keys = [sorted((r["query_id"], r["rank"], r["id"]) for r in rows) for rows in (by_sort, by_window)]
    assert keys[0] == keys[1] and len(keys[0]) == 18


def test_large_query_side_is_joined_by_exchange(spark, tables_corpus, monkeypatch):
    index = build_index(tables_corpus, validate=False)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id bigint, text string")
    expected = sorted((r["query_id"], r["rank"], r["id"]) for r in search_batch(index, queries, 9).collect())
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 10)
    assert querying.measure(querying.query_terms(queries)) [0::2] == (3, False)
    exchanged = search_batch(index, queries, 9)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in exchanged.collect()) == expected


def test_results_do_not_depend_on_partitions(spark, tables_corpus):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            index = build_index(tables_corpus.repartition(int(partitions)), validate=False)
            found.append([(r["rank"], r["id"]) for r in search(index, QUERIES[0], 50).collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_long_query(spark, tables_corpus):
    """More words than are pushed into the scan."""
    index = build_index(tables_corpus, validate=False)
    row = tables_corpus.orderBy(F.length("text").desc()).first()
    assert search(index, row["text"], 1).first()["id"] == row["id"]


def test_listing(spark):
    rows = [(2, "b", "x" * 29, 1.23456), (1, "a", "y" * 28, 20.0)]
    results = spark.createDataFrame(rows, "rank int, id string, title string, relevance double")
    assert [tuple(r) for r in result_listing(results).collect()] == [
        (0, "y" * 28, "20.000"),
        (1, "x" * 28 + "..", "1.235"),
    ]


def test_write_results(spark, micro, tmp_path):
    path = str(tmp_path / "out")
    results = search(build_index(micro), "dog cat", 5)
    write_results(results, path)
    assert [r["id"] for r in spark.read.json(path).orderBy("rank").collect()] == ["1", "2"]
    with pytest.raises(FileExistsError):
        write_results(results, path)


def test_no_rank_is_lost_where_ids_repeat(make_corpus):
    index = build_index(make_corpus(("1", "cat cat"), ("1", "cat cat"), ("2", "cat dog dog"), ("3", "dog")), validate=False)
    for n in (2, 3, 100_001):
        assert {r["rank"] for r in search(index, "cat", n).collect()} == {1, 2}


def test_exchanged_batch_reads_the_texts_once(spark, make_corpus):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    corpus = make_corpus(*(" ".join(words[i : i + 40]) for i in range(0, 260, 20)))
    queries = spark.createDataFrame([(i, " ".join(words[i : i + 30])) for i in range(0, 290, 7)], "query_id int, text string")
    small, large = (
        sorted(map(tuple, search_batch(build_index(corpus), queries, 3, broadcast=b).collect())) for b in (None, False)
    )
    assert [r[:3] for r in small] == [r[:3] for r in large]
    plan = search_batch(build_index(corpus), queries, 3, broadcast=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # analysed texts and query words are kept


def test_exchanged_postings_carry_lists_of_queries(spark, make_corpus, monkeypatch):
    import re

    from pyspark.sql import functions as F
    from termloom import build_index, search_batch
    from termloom.operators import querying

    monkeypatch.setattr(querying, "LISTED", 3)
    index = build_index(make_corpus("the cat cat", "the dog", "a bird", "the the bird", "123"), validate=False)
    texts = ["the cat", "the the dog", "bird", "qqqq", "the bird bird", "a"] * 3
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")
    for solver in ("BM25", "Basic"):
        near, far = (
            sorted(map(tuple, search_batch(index, queries, 4, solver, broadcast=b).withColumn("relevance", F.round("relevance", 6)).collect()))
            for b in (None, False)
        )
        assert near == far and near
    terms = querying.query_terms(queries)
    known = querying.known_terms(terms, index.vocab, small=False)
    lists = querying._asker_lists(known)
    assert lists.agg(F.sum(F.size("query_id"))).first()[0] == known.count()
    met = querying.matching_postings(index.postings, known, small=False).groupBy("query_id", "id").count()
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan  # lists are unrolled beside their document
    # What is added up per query and document is not exchanged by both.
    assert not re.search(r"hashpartitioning\(query_id#\w+, id#", met._jdf.queryExecution().executedPlan().toString())


def test_few_documents_are_ranked_for_both_solvers(spark):
    """Bars leave all of the best of each query by any score, ties too, and far fewer documents than there are."""
    from termloom.plans import search as plans

    rows = spark.range(20_000).select(
        (F.col("id") % 3).alias("query_id"), F.col("id").cast("string").alias("id"),
        F.pmod(F.xxhash64("id"), F.lit(997)).cast("double").alias("BM25"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("double").alias("Basic"),
    ).where("query_id < 2 OR id < 20")
    left = plans.within_reach(rows, 5, ("BM25", "Basic"))
    bars = {row[0]: row[1:] for row in left.groupBy("query_id").agg(F.count("*"), F.count_if(F.col("Basic") == 4)).collect()}
    whole = {row[0]: row[1] for row in rows.groupBy("query_id").agg(F.count_if(F.col("Basic") == 4)).collect()}
    assert {query: found[1] for query, found in bars.items()} == whole  # all tie for the best
    assert bars[0][0] - bars[0][1] < 50 and bars[2][0] == rows.where("query_id = 2").count() == 6
    for score in ("BM25", "Basic"):
        best = [plans.top_n(f.withColumn("relevance", F.col(score)), 5).select("query_id", "rank", "id") for f in (rows, left)]
        assert sorted(map(tuple, best[0].collect())) == sorted(map(tuple, best[1].collect()))


def test_solvers_are_compared_with_bars_as_without(spark, tables_corpus, monkeypatch):
    from termloom.plans import search as plans

    index = build_index(tables_corpus, validate=False)
    queries = spark.createDataFrame([(1, "the of and"), (2, "la le"), (3, "zzzz")], "query_id int, text string")
    calls, within = [], plans.within_reach
    monkeypatch.setattr(plans, "within_reach", lambda *given: calls.append(given[1]) or within(*given))
    barred = plans.ranked_by_solver(index, queries, 4)
    monkeypatch.setattr(plans, "MOST_BARRED", 0)
    plain = plans.ranked_by_solver(index, queries, 4)
    assert calls == [4] and set(barred) == {"BM25", "Basic"}
    for solver, found in barred.items():
        columns = ["query_id", "rank", "id", F.round("relevance", 9)]
        rows = [sorted(map(tuple, f.select(*columns).collect())) for f in (found, plain[solver])]
        assert rows[0] == rows[1] and len(rows[0]) > 4
