import base64
import hashlib
import heapq
import random

import pytest

from termloom.llm import warc
from termloom.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def wanted(pages, least=0):
    """(page, bytes, digest, type, refers_to) by looking at all pages."""
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    out = []
    for page, payload in payloads:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = [p for p, other in payloads if other == payload and p is not None]
        first = max(same, default=None) if len(payload) >= least and sum(o == payload for _, o in payloads) > 1 else None
        revisit = first is not None and first != page
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, pages, **how):
    path = scratch_path(spark, "warc")
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], SCHEMA + ", digest string, url_key string")
    warc.write_archives(frame, path, **how)
    return warc.capture_histories(warc.read_captures(spark, path)).collect()


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "RECORDS", 7)
    rng = random.Random(1)
    bodies = [None, "", "a", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n", "é漢\U0001f600\x00", "ab", "x" * 200_000, "same"]
    urls = [None, "", "no scheme", "http://Ex.org/A?b=%41 c\r\nX: y#é", "https://a.b.c", "https://b.a.c/1", "http://hot.net/"]
    pages = [(i, rng.choice(urls), rng.choice(bodies)) for i in range(120)]
    pages += [(500 + i, "http://hot.net/", f"own {i}") for i in range(80)]
    pages += [(3, pages[3][1], pages[3][2]), (None, None, "same"), (None, "u", "only without id"), (None, "u", "only without id")]
    out = round_trip(spark, pages, least=least)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(found, key=repr) == wanted(pages, least)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in out]
    assert keys == sorted(keys)
    assert sorted(((r.page_id, r.url) for r in out), key=repr) == sorted(((p, u) for p, u, _ in pages), key=repr)
    assert len({r.archive for r in out}) > 20


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_offsets_find_the_record(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([(i, f"http://h/{i}", "p" * i) for i in range(20)], SCHEMA), path)
    data = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()}
    for r in warc.read_captures(spark, path).collect():
        (at, length, headers, _, payload), = warc.records(data[r.archive][r.offset : r.offset + r.length])
        assert (at, length, payload) == (0, r.length, b"p" * r.page_id)


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges(runs):
    rng = random.Random(runs)
    lists = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(runs)]
    assert list(warc.LoserTree(lists, key=lambda x: x)) == list(heapq.merge(*lists))


def test_cut_archives_are_refused():
    whole = warc.record(1, "u", b"body", "D", None) + b"\r\n\r\n"
    assert len(list(warc.records(whole * 2))) == 2
    with pytest.raises(ValueError):
        list(warc.records(whole[:-5]))


def test_url_keys():
    assert warc.url_key("https://A.b.Org/X?y") == "org,b,a)/x?y"
    assert warc.url_key("http://a.b") == "b,a)/"
    assert warc.url_key(None) == ")/"
