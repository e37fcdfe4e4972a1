import os
import threading

import pytest
from pyspark.sql import functions as F

from termloom import build_index, load_index, search
from termloom.plans.index import damaged_files, default_buckets
from termloom.plans.phrases import save_phrase_index
from termloom.session import published


def test_two_writers_one_wins(spark, make_corpus, tmp_path):
    path = str(tmp_path / "index")
    done, refused = [], []

    def write(text):
        try:
            build_index(make_corpus(text), validate=False).save(path)
            done.append(text)
        except FileExistsError:
            refused.append(text)

    threads = [threading.Thread(target=write, args=(t,)) for t in ("first words", "second words", "third words")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 1 and len(refused) == 2
    assert {r["term"] for r in load_index(spark, path, verify=True).vocab.collect()} == set(done[0].split())
    assert os.listdir(tmp_path) == ["index"]


def test_a_failed_write_leaves_the_path_free(spark, make_corpus, tmp_path):
    path = str(tmp_path / "index")
    bad = make_corpus("a b", "c").withColumn("text", F.when(F.col("id") == "2", F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no"):
        build_index(bad, validate=False).save(path, buckets=2)
    assert os.listdir(tmp_path) == []
    build_index(make_corpus("a b", "c")).save(path)
    assert len(search(load_index(spark, path), "c", 3).collect()) == 1


def test_a_path_that_appears_meanwhile_is_refused(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileExistsError), published(spark, path) as work:
        os.makedirs(work)
        os.makedirs(path)
    assert os.listdir(path) == [] and os.listdir(tmp_path) == ["out"]


def test_damaged_files_are_named(spark, make_corpus, tmp_path):
    path = str(tmp_path / "it's an index")
    build_index(make_corpus("a b", "c d", "e")).save(path, buckets=2)
    assert damaged_files(spark, path).count() == 0
    files = [f for f in os.listdir(f"{path}/postings") if f.endswith(".parquet")]
    os.remove(f"{path}/postings/{files[0]}")
    assert [r["file"] for r in damaged_files(spark, path).collect()] == [f"postings/{files[0]}"]
    load_index(spark, path)
    with pytest.raises(FileNotFoundError, match="postings/"):
        load_index(spark, path, verify=True)


def test_never_more_buckets_than_the_catalog_allows(spark, make_corpus, tmp_path):
    assert default_buckets(100 * 2**40, 200) == 99_328
    assert default_buckets(10**12, 10, most=700) == 700
    assert default_buckets(10**13, 10, most=2500) == 2048
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        corpus = make_corpus(*(f"text {i} " * 40_000 for i in range(20)))
        assert build_index(corpus, validate=False).save(str(tmp_path / "a")).buckets == 3
        with pytest.raises(ValueError, match="1 to 3 buckets"):
            build_index(corpus, validate=False).save(str(tmp_path / "b"), buckets=4)
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)


def test_an_existing_path_is_refused_before_a_text_is_read(spark, make_corpus, tmp_path):
    path = str(tmp_path / "out")
    os.makedirs(path)
    unread = make_corpus("a b").withColumn("text", F.raise_error(F.concat(F.lit("read "), "text")))
    with pytest.raises(FileExistsError):
        build_index(unread, validate=False).save(path)
    with pytest.raises(FileExistsError):
        save_phrase_index(unread, path)
    assert os.listdir(tmp_path) == ["out"] and os.listdir(path) == []
