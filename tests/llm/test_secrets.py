import random
import re

import pytest

from termloom.llm import secret_scan, trigrams

RULES = secret_scan.RULES


def plain(text):
    found = []
    for number, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), number, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


HAND = [
    (None, []),
    ("", []),
    ("token:token: abcdefgh", []),
    ("PassWD = 'abc123'", [("assign", 0, 16)]),
    ("é api_key:\"x\" apikey: ABCDEF.", [("assign", 14, 29)]),
    ("AKIA" + "A" * 16, [("access", 0, 20)]),
    ("AKIAAKIA" + "B" * 11, []),
    ("x" + "ab" * 12 + "g" + "1" * 23, [("hex", 1, 25)]),
    ("secretſ=abcdefgh Key", []),
]


def test_hand_worked_and_random_texts(spark):
    rng = random.Random(2)
    pieces = ["password", "token", "=", ":", " ", "\"", "AKIA", "ABCDEFGHIJKLMNOPQ", "deadbeef01", "é", "\U0001f600", "\n",
              "ghp_", "eyJabcdefghijklmnop", ".", "-----BEGIN RSA PRIVATE KEY-----", "xoxb-", "API_KEY", "secret"]
    texts = [t for t, _ in HAND] + ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(300)]
    texts += ["word " * 400_000 + "token=abcdefg"]
    rows = [(i, t, "own") for i, t in enumerate(texts)]
    out = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, secrets string")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert [tuple(s) for s in r.secrets] == plain(r.text)
    for i, (_, spans) in enumerate(HAND):
        assert [tuple(s) for s in next(r for r in out if r.doc_id == i).secrets] == spans


def test_redaction(spark):
    rows = [(1, "a token=abcdef1234 b", "x"), (2, None, "y"), (3, "nothing", "z"), (3, "nothing", "z")]
    out = secret_scan.redact(spark.createDataFrame(rows, "doc_id long, text string, kind string"))
    assert sorted(map(tuple, out.select("doc_id", "text", "kind").collect()), key=repr) == [
        (1, "a [REDACTED] b", "x"), (2, None, "y"), (3, "nothing", "z"), (3, "nothing", "z"),
    ]
    assert out.where("doc_id is null").collect() == []
    assert secret_scan._masked("abcdefgh", [(1, 0, 4), (2, 1, 6)], "*") == "a*gh"


def test_empty_table(spark):
    assert secret_scan.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize(
    ("pattern", "query"),
    [
        ("abcd", ("and", (b"abc", b"bcd"))),
        ("a.bc", True),
        ("abc.*xyz", ("and", (b"abc", b"xyz"))),
        ("(abc|xyz)", ("or", (b"abc", b"xyz"))),
        ("(?i)ABC", b"abc"),
        ("ab?cd", ("or", (("and", (b"abc", b"bcd")), b"acd"))),
        ("[0-9a-f]{24,}", True),
        ("(abc)*", True),
        ("(abc|d)+", True),
        ("x[ab]yy+z", ("or", (b"xay", b"xby"))),
        ("x[ab]y+zzz", b"zzz"),
    ],
)
def test_queries(pattern, query):
    assert trigrams.trigram_query(pattern) == query


def test_every_match_is_a_candidate():
    rng = random.Random(4)
    patterns = [r.pattern for r in RULES] + ["(ab|cd)+ef", "a(b|c{2,3})d", "^abc$", "(?<=abc)d", "a[^b]cde", "abc?d(e|fgh)?"]
    for pattern in patterns:
        query = trigrams.trigram_query(pattern)
        index = trigrams.TrigramIndex(trigrams.trigrams_of(query))
        alphabet = ["a", "b", "c", "d", "e", "f", "abc", "password", "=", "AKIA", "A1", "é", "api", "_", "key"]
        texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(400)]
        rows = set(trigrams.candidates(query, index.postings([t.encode() for t in texts]), len(texts)).tolist())
        assert {i for i, t in enumerate(texts) if re.search(pattern, t, re.ASCII)} <= rows
