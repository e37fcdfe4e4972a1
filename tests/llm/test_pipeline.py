"""Each stage against a plain version of it, on the smallest documents with some rows added."""

import collections

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from termloom.llm import language
from termloom.llm.tables import map_batches, staged
from test_mixing import filled
from test_secrets import plain
from test_simhash import plain_components, plain_fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(9001, None, "en", "src1", 0), (9002, "12 34", None, None, 5), (9003, "", "en", "src1", 0)]
    odd += [(9004, "token=abcdef1234 the and of in to is", None, None, 3)] * 2
    found = [staged(docs.unionByName(spark.createDataFrame(odd, docs.schema)), "start")]
    for _, stage in corpus_pipeline.STAGES:
        found.append(staged(stage(spark, found[-1], SMALL), "stage"))
    return found


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup"
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_language(stages):
    before, after = (s.collect() for s in stages[:2])
    model = language.learn(stages[0])
    identifier = language.Identifier(model)
    wanted = []
    for r in before:
        found = language.described(identifier, [r.text])[0]
        if found["lang"] != "und" and found["score"] >= corpus_pipeline.LEAST_SHARE:
            wanted.append((r.doc_id, r.text, found["lang"], r.source, r.n_chars))
    assert sorted(map(tuple, after), key=repr) == sorted(wanted, key=repr)
    assert stages[1].columns == stages[0].columns


def test_near_duplicates(stages):
    before, after = (s.collect() for s in stages[1:3])
    component = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(component))
    assert len(after) < len(before)
    assert set(after) <= set(before)


def test_secrets(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = stages[3].collect()
    assert len(after) == len(before)
    changed = 0
    for r in after:
        assert plain(r.text) == [] and r.n_chars == len(r.text)
        changed += r.text != before[r.doc_id].text
        assert (r.text == before[r.doc_id].text) == (plain(before[r.doc_id].text) == [])
    assert changed


def test_mixing(stages):
    before, after = (s.collect() for s in stages[3:5])
    size, taken, times = collections.Counter(), collections.Counter(), collections.Counter()
    for r in before:
        size[r.source] += len(r.text.split())
    for r in after:
        taken[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    wanted = filled(size)
    assert all(0 <= wanted[s] - taken[s] < 1 for s in size)
    assert max(times.values()) == 2
    texts = {r.doc_id: r.text for r in before}
    assert sum(r.text != texts[r.doc_id] for r in after) <= len(size)


def test_pieces(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [(r.doc_id, r.lang, r.source, r.text) for r in stages[4].collect()]
    wanted = [(d, lang, s, len(i), i) for (d, lang, s, _), i in zip(texts, library.encode([t[3] for t in texts]), strict=True)]
    assert sorted(map(tuple, stages[5].collect()), key=repr) == sorted(wanted, key=repr)


def test_columns_of_any_name_are_carried_along(spark):
    text = "the cat and the dog of the house are in the garden with token=abcdef1234 and more"
    rows = [(i, f"{text} {i * 'again '}", "en", "src", 1, *[f"{k}{i}" for k in range(8)]) for i in range(1, 9)]
    more = ["language", "mix", "secrets", "place", "_place", "ids", "mark", "fingerprint"]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *more])
    want = {r[0]: r[5:] for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.columns, staged(stage(spark, docs, SMALL), "stage")
        assert docs.columns == before
        found = docs.collect()
        assert found and all(tuple(r)[5:] == want[r.doc_id] for r in found), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(found)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), "stage")
        assert docs.count() == 0


def test_a_task_hands_few_megabytes_to_python_at_a_time(spark):
    """Texts of half a megabyte each: a batch, which the JVM and Python hold several times over, stays at 5 MB."""
    texts = spark.range(40, numPartitions=1).withColumn("text", F.repeat(F.lit("words "), 90_000))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([[batch.nbytes], [batch.num_rows]], ["bytes", "rows"])

    found = map_batches(texts, sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in found) == 40
    assert max(r["bytes"] for r in found) <= 5_000_000
