import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from termloom import build_index, load_index, search, search_batch
from termloom.plans.index import default_buckets, largest_divisor


@pytest.fixture(scope="module")
def saved(tables_corpus, tmp_path_factory):
    lazy = build_index(tables_corpus, validate=False)
    path = str(tmp_path_factory.mktemp("index") / "it's here")
    return lazy, lazy.save(path, buckets=6), path


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_same_frames(saved):
    lazy, stored, _ = saved
    assert rows(stored.postings, "term", "id", "tf", "doc_length") == rows(
        lazy.postings, "term", "id", "tf", "doc_length"
    )
    assert rows(stored.docs, "id", "title", "url", "doc_length") == rows(lazy.docs, "id", "title", "url", "doc_length")
    assert rows(stored.vocabulary(), "term", "df", "idf", "word_id") == rows(
        lazy.vocabulary(), "term", "df", "idf", "word_id"
    )
    assert stored.stats.collect() == lazy.stats.collect()
    assert stored.summary().collect() == lazy.summary().collect()
    flat = ["id", "title", "doc_length", F.to_json("vector")]
    assert rows(stored.vectors(), *flat) == rows(lazy.vectors(), *flat)


def test_same_results(spark, saved):
    lazy, stored, path = saved
    for solver in ("BM25", "Basic"):
        for n in (5, 400):
            found = [
                [(r["rank"], r["id"], r["title"], r["url"], round(r["relevance"], 9)) for r in result.collect()]
                for result in (
                    search(index, "The thorreou of eauouon, and THE ouen", n, solver)
                    for index in (lazy, stored, load_index(spark, path))
                )
            ]
            assert found[0] == found[1] == found[2]
            assert len(found[0]) >= 5
    queries = spark.createDataFrame([(1, "the of"), (2, "la le"), (3, "zzzz")], "query_id int, text string")
    columns = ["query_id", "rank", "id", "title", F.round("relevance", 9)]
    assert rows(search_batch(stored, queries, 8), *columns) == rows(search_batch(lazy, queries, 8), *columns)


def test_no_matches(saved):
    assert search(saved[1], "zzzz", 5).collect() == []
    assert search(saved[1], "the", 0).collect() == []


def test_paths_are_checked(spark, saved, tmp_path):
    lazy, _, path = saved
    with pytest.raises(FileExistsError):
        lazy.save(path)
    with pytest.raises(FileNotFoundError, match="vocab, docs, postings, stats"):
        load_index(spark, str(tmp_path))
    with pytest.raises(NotImplementedError):
        load_index(spark, path).save(str(tmp_path / "copy"))


def test_relative_path(spark, make_corpus, tmp_path):
    path = os.path.relpath(tmp_path / "index")
    build_index(make_corpus("a b", "a")).save(path)
    assert [r["id"] for r in search(load_index(spark, path), "b", 5).collect()] == ["1"]
    assert (tmp_path / "index" / "postings" / "_SUCCESS").exists()


def test_options_are_kept(spark, make_corpus, tmp_path):
    path = str(tmp_path / "index")
    build_index(make_corpus(" a b c", "d e"), "normal", avgdl="exact", drop_empty=True).save(path)
    stored = load_index(spark, path)
    assert (stored.idf_type, stored.drop_empty) == ("normal", True)
    assert stored.stats.first()["avgdl"] == 2.5
    assert {r["term"]: r["idf"] for r in stored.vocab.collect()} == dict.fromkeys("abcde", 1.0)


def test_default_buckets():
    mb = 1024 * 1024
    assert default_buckets(0, 200) == 1
    assert default_buckets(3 * mb - 1, 200) == 3
    assert default_buckets(10_000 * mb, 200) == 200
    assert default_buckets(500 * 256 * mb, 200) == 500
    assert default_buckets(20_000 * 256 * mb, 200) == 20_480
    assert [largest_divisor(n, 1024) for n in (1, 200, 2048, 1030, 1031)] == [1, 200, 1024, 515, 1]


def test_layout_does_not_hang_on_the_id_check(spark, make_corpus, tmp_path):
    corpus = make_corpus(*(f"text {i} " * 5000 for i in range(40)))
    found = []
    for i, how in enumerate(({"validate": True}, {"validate": False}, {"dedupe": "first"})):
        stored = build_index(corpus, **how).save(str(tmp_path / str(i)))
        found.append((stored.buckets, stored.shards))
    assert found == [found[0]] * 3 and found[0][0] > 1


def test_many_can_load_at_once(spark, saved):
    path = saved[2]
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda _: search(load_index(spark, path), "the", 3).collect(), range(16)))
    assert found == [found[0]] * 16 and len(found[0]) == 3


def test_empty_corpus(make_corpus, tmp_path):
    stored = build_index(make_corpus("a").where("false")).save(str(tmp_path / "index"))
    assert stored.stats.first().asDict() == {"n_docs": 0, "total_tokens": 0, "avgdl": 0.0}
    assert search(stored, "a", 5).collect() == []
    assert stored.vectors().collect() == []


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scores_are_added_up_without_an_exchange(spark, saved):
    from termloom.operators import querying

    stored = saved[1].restricted(["the", "of"])
    queries = spark.createDataFrame([(1, "the of")], "query_id int, text string")
    known = querying.known_terms(querying.query_terms(queries), stored.vocab, small=True)
    matched = querying.matching_postings(stored.postings, known, small=True)
    total = querying.relevance(querying.term_scores(matched, stored.avgdl, {"score": "BM25"}))
    plan = plan_of(total)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "tf#" in line)
    assert "Bucketed: true" in scan
    assert "EqualTo(term,the)" in scan
    # The only exchanges belong to the one-row query side.
    above = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in above
    assert "Python" not in plan


def test_every_bucket_holds_whole_documents(spark, saved):
    located = saved[1].postings.select("id", F.input_file_name().alias("file"))
    bucket = F.regexp_extract("file", r"_(\d{5})\.c", 1)
    assert located.select("id", bucket.alias("b")).distinct().groupBy("id").count().where("count > 1").count() == 0
    assert located.select(bucket).distinct().count() == 6


def test_a_common_word_does_not_swell_a_bucket(spark, make_corpus, tmp_path):
    """One word in every document, a third of all postings: its postings are spread evenly over the buckets."""
    texts = [f"common word{i} only{i}" for i in range(400)]
    stored = build_index(make_corpus(*texts), validate=False).save(str(tmp_path / "index"), buckets=8)
    sizes = [r["count"] for r in stored.postings.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 2 * 1200 / 8


def test_postings_are_sorted_by_term_alone(spark, tables_corpus, tmp_path, monkeypatch):
    """Each bucket by its own writer, also where a task has many of them; a sort that began with the bucket would compare whole words."""
    from termloom.plans import index as plans

    held, before, setting = [], spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"), plans.setting
    monkeypatch.setattr(plans, "setting", lambda *given: held.append(given[1:]) or setting(*given))
    index = build_index(tables_corpus, validate=False).save(str(tmp_path / "index"), buckets=40)
    assert held == [("spark.sql.maxConcurrentOutputFileWriters", "40")]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    placed = index.postings.select("term", "id", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
    rows = placed.select("file_name", "at", "term", F.expr("pmod(hash(id), 40)").alias("bucket")).collect()
    files = {}
    for file, _, term, bucket in sorted(rows):
        files.setdefault(file, []).append((term.encode(), bucket))
    assert len(files) == len({bucket for found in files.values() for _, bucket in found})
    for file, found in files.items():
        assert {bucket for _, bucket in found} == {int(file.split("_")[1].split(".")[0])}
        assert [term for term, _ in found] == sorted(term for term, _ in found)


def test_common_postings_are_gathered_where_they_lie(spark, saved, monkeypatch):
    from termloom.operators import skew

    lazy, stored, _ = saved
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 200_000)
    flat = ["id", "title", "doc_length", F.to_json("vector")]
    vectors = stored.vectors()
    assert rows(vectors, *flat) == rows(lazy.vectors(), *flat)
    assert rows(stored.vectors(every=True), "id") == rows(stored.docs, "id")
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    # Of common words only documents are exchanged: neither a union of postings nor a second exchange by id.
    assert "Union" not in plan and plan.count("Bucketed: true") >= 1
    with_counts = stored.vectors(counts=True).select("id", F.to_json("vector"), F.size("tfs"), F.size("vector"))
    assert all(r[2] == r[3] for r in with_counts.collect())
