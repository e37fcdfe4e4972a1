import random

import pyarrow as pa
import pytest
import sentencepiece
import public_tokenizers
from pyspark.sql import functions as F

from termloom.llm import piece_codec, registered
from termloom.llm.piece_codec import MARK, PieceCodec

MODEL = piece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    pieces = [p.replace(MARK, " ") for p in PieceCodec(MODEL).ids if len(p) > 1]
    odd = [" ", "  ", "    ", "\n", "\t", "é", "漢", "\U0001f600", "\x00", "ß", "aaaa", "á", " ", "the", "ing", "1", "."]
    return ["".join(rng.choice(odd if rng.random() < 0.4 else pieces) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_same_ids_as_the_library():
    texts = ["", " ", "Hello  world", " a", "a ", "\n", "x" * 300, "ab" * 200, " " * 70, *random_texts(600)]
    assert PieceCodec(MODEL).encode(texts) == LIBRARY.encode(texts)


def test_library_agrees_on_the_tables(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert PieceCodec(MODEL).encode(texts) == LIBRARY.encode(texts)


def test_remembering_anew_changes_nothing(monkeypatch):
    texts = random_texts(100, 3)
    monkeypatch.setattr(piece_codec, "REMEMBERED", 10)
    codec = PieceCodec(MODEL)
    assert [codec.encode([t])[0] for t in texts] == LIBRARY.encode(texts)


def test_unigram_pass_is_optimal():
    codec = PieceCodec(MODEL)
    codec.ids = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aba", MARK, MARK + "a"])}
    codec.scores = {"a": -1.0, "b": -1.2, "ab": -1.5, "ba": -1.4, "aba": -2.6, MARK: -0.5, MARK + "a": -1.6}
    codec.pieces = list(codec.ids)
    codec.ends = {}
    for piece, i in codec.ids.items():
        node = codec.ends
        for letter in reversed(piece):
            node = node.setdefault(letter, {})
        node[""] = i
    codec.is_bpe = False
    codec.scores = dict(codec.scores)

    def best(word):
        if not word:
            return 0.0
        return max(best(word[: -len(p)]) + s for p, s in codec.scores.items() if word.endswith(p))

    words = [MARK + "".join(random.Random(i).choices("ab", k=i % 9)) for i in range(60)]
    found = codec.encode_words(set(words))
    back = {i: p for p, i in codec.ids.items()}
    for word in words:
        at = found[word]
        pieces = [back[i] for i in codec.flat[codec.starts[at] : codec.starts[at + 1]]]
        assert "".join(pieces) == word
        assert sum(codec.scores[p] for p in pieces) == pytest.approx(best(word))


def test_frames_round_trip(spark):
    texts = [None, "", "word " * 50_000, *random_texts(60, 9)]
    rows = [(i, t, "kept", [1]) for i, t in enumerate(texts)] + [(2, "", "kept", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    out = piece_codec.decode(piece_codec.encode(docs, MODEL), MODEL).collect()
    assert len(out) == len(rows)
    assert all(r.decoded == r.text for r in out)
    checked = piece_codec.encode(docs.unionByName(spark.createDataFrame([(0, f"a{MARK}b", "", [])], docs.schema)), MODEL, verified="ok")
    assert [r.ok for r in checked.collect()] == [True] * (len(rows) + 1)
    assert [r.ids for r in sorted(out, key=lambda r: r.doc_id) if r.text is None] == [None]
    empty = docs.limit(0)
    assert piece_codec.decode(piece_codec.encode(empty, MODEL), MODEL).collect() == []


def test_decoding_equals_the_library():
    for ids in LIBRARY.encode(random_texts(50, 4)) + [[0, 5], [1, 300, 2], []]:
        assert PieceCodec(MODEL).decode(ids) == LIBRARY.decode(ids)


def test_verified_words_are_those_that_decode(monkeypatch):
    texts = [*random_texts(200, 6), "", f"a{MARK}b", None]
    codec = PieceCodec(MODEL)
    ids, whole = codec.encode_batch(texts)
    for text, own, good in zip(texts, ids.to_pylist(), whole, strict=True):
        assert good == (text is None or codec.decode(own) == text.replace(MARK, " "))
    assert whole.all()
    # A codec that loses a piece says so, for the texts with that word only.
    codec = PieceCodec(MODEL)
    inner = codec._ids_of
    monkeypatch.setattr(codec, "_ids_of", lambda word, last: inner(word, last)[1:] if "lost" in word else inner(word, last))
    assert codec.encode_batch(["it is lost", "it is here", "", "lost"])[1].tolist() == [False, True, True, False]


def test_batches_decode_as_single_lists():
    lists = [*LIBRARY.encode(random_texts(60, 5)), [0, 5], [1, 300, 2], [], None, [1, 2], list(range(3, 259))]
    codec, column = PieceCodec(MODEL), pa.array(lists, pa.list_(pa.int32()))
    assert codec.decode_batch(column) == [codec.decode(ids) for ids in lists]
    assert codec.decode_batch(column.slice(3, 20)) == [codec.decode(ids) for ids in lists[3:23]]
    assert codec.decode_batch(column.slice(2, 0)) == []


def test_op2_decodes_the_ids_that_it_returns(spark, monkeypatch):
    small, encode = "/root/testdata/sf0.001", piece_codec.encode
    assert all(r.round_trip for r in registered.op2_pieces(spark, small).select("round_trip").collect())
    lost = (F.col("doc_id") % 2 == 0) & (F.size("ids") > 0)

    def losing(*args, **named):
        return encode(*args, **named).withColumn("ids", F.when(lost, F.expr("slice(ids, 1, size(ids) - 1)")).otherwise(F.col("ids")))

    monkeypatch.setattr(piece_codec, "encode", losing)
    rows = registered.op2_pieces(spark, small).select("doc_id", "n_ids", "round_trip").collect()
    assert {r.round_trip for r in rows if r.doc_id % 2 == 0 and r.n_ids > 0} == {False}
    assert all(r.round_trip for r in rows if r.doc_id % 2)
