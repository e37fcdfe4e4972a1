import collections
import math
import random
import re

from termloom.llm import quality

SCHEMA = "doc_id long, text string, lang string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def histograms(text):
    text = text or ""
    common = list(dict.fromkeys(quality.COMMON))
    kinds = collections.Counter()
    for c in text:
        kind = (
            "lower" if c.islower() and c.isalpha() else "upper" if c.isupper() else "digit" if c in "0123456789"
            else "space" if c in " \t\n\v\f\r" else "symbol" if c in quality.SYMBOLS else "other"
        )
        kinds[kind] += 1
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0d]+", text)]
    found = collections.Counter(words)
    by_word = [found[w] for w in common]
    return [kinds[k] for k in quality.CLASSES], [*by_word, len(words) - sum(by_word)]


def js(a, b):
    if not sum(a) or not sum(b):
        return None
    p, q = ([n / sum(x) for n in x] for x in (a, b))
    total = sum(x * math.log2(2 * x / (x + y)) for s, t in ((p, q), (q, p)) for x, y in zip(s, t) if x > 0)
    return math.sqrt(max(0.0, total / 2))


def texts():
    rng = random.Random(1)
    common = list(dict.fromkeys(quality.COMMON))
    out = [None, "", " \n\t", "a b c a b c", "a\n\na\n \nb\r\na", "#*$ %&|<>", "ÄÖ éß 12 ٣", "x " * 400, "word, " * 30_000]
    for i in range(60):
        words = [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(300)}" for _ in range(rng.randrange(400))]
        text = " ".join(words)
        out.append(text.upper() if i % 9 == 0 else text.replace(" ", "\n", i))
    return out


def test_counts_distances_and_verdicts(spark):
    rows = [(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts())]
    rows += [(None, "the of", "en"), (3, rows[3][1], rows[3][2])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", words string, f string")
    found = quality.judge(frame, keep=("doc_id", "text", "lang", "f")).collect()
    assert len(found) == len(rows)
    total = {}
    for _, text, lang in rows:
        for old, new in zip(total.setdefault(lang, [[0] * 6, [0] * len(histograms("")[1])]), histograms(text), strict=True):
            old[:] = map(sum, zip(old, new))
    for r in found:
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == counts(r.text)
        failed = q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words
        by_class, by_word = (js(a, b) for a, b in zip(histograms(r.text), total[r.lang], strict=True))
        for own, wanted, size in ((q.class_distance, by_class, len(r.text or "") >= 200), (q.word_distance, by_word, q.n_words >= 150)):
            assert (own is not None) == size
            assert own is None or abs(own - wanted) < 1e-6
        unlike = (q.class_distance or 0) > 0.28 or (q.word_distance or 0) > 0.29
        assert (q.base_failed, q.kept) == (failed, not failed and not unlike)


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_labelled_documents(spark):
    path = "/root/testdata/sf0.1"
    judged = quality.judge(spark.read.parquet(f"{path}/documents.parquet").where("doc_id < 3000"))
    labels = spark.read.parquet(f"{path}/labels.parquet").withColumnRenamed("quality", "label")
    rows = judged.join(labels, "doc_id").where("NOT quality.base_failed").collect()
    good, bad = ([r.quality.kept for r in rows if r.label == k] for k in (1, 0))
    assert sum(good) >= 0.995 * len(good)
    assert sum(bad) <= 0.4 * len(bad)
