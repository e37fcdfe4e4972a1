"""Quality rules: how far a document's characters and common words are from those of its language, in DataFrame functions."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.tables import SPACE, staged

# Common words of the languages expected; all others are one further bin. A list of one's own can be given.
COMMON = tuple(
    "the of and to in is that for on are with as it was by be or an at this from "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le la de et les du en un une que est pour dans au par "
    "el y los se del las por con su al lo".split()
)
CLASSES = ("lower", "upper", "digit", "space", "symbol", "other")
SYMBOLS = "#*$%&|<>"

# Below these sizes a histogram is too coarse to be judged, and the document is kept.
LEAST_CHARS = 200
LEAST_WORDS = 150
# Jensen-Shannon distances (0 to 1) above which a document is not like its language. On the labelled documents of the test
# tables no good document is above either.
MOST_CLASS_DISTANCE = 0.28
MOST_WORD_DISTANCE = 0.29


def features(docs: DataFrame, text: str = "text", common: tuple[str, ...] = COMMON) -> DataFrame:
    """The rows of ``docs`` with ``f``, a struct: ``n_words``, ``n_chars``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``classes`` (characters by class) and ``words`` (words by common word, then all others).

    A null text is empty. Texts are taken whole; an existing column ``f`` is replaced.
    """
    rows = docs.drop("f").select(F.struct("*").alias("row"))
    whole = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    rows = rows.select("row", whole.alias("text"), F.regexp_replace(whole, r"\p{Ll}+", "").alias("rest"))
    words = F.array_remove(F.split("text", SPACE), "")
    solid = F.filter(F.split("text", "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    no_upper = F.regexp_replace("rest", r"\p{Lu}+", "")
    rows = rows.select(
        "row", words.alias("words"), solid.alias("lines"),
        (F.length("text") - F.length("rest")).alias("lower"), (F.length("rest") - F.length(no_upper)).alias("upper"),
        no_upper.alias("rest"),
    )
    code = {word: chr(0x100 + i) for i, word in enumerate(dict.fromkeys(common))}
    codes = F.create_map(*(F.lit(x) for pair in code.items() for x in pair))
    lowered = F.transform("words", F.lower)
    found = F.array_join(F.transform(F.filter(lowered, lambda w: w.isin(*code)), lambda w: F.element_at(codes, w)), "")
    spaces = F.length("rest") - F.length(F.regexp_replace("rest", SPACE, ""))
    digits = F.length("rest") - F.length(F.regexp_replace("rest", r"[0-9]+", ""))
    symbols = F.length("rest") - F.length(F.translate("rest", SYMBOLS, ""))
    rows = rows.select(
        "row", F.size("words").alias("n_words"), "lower", "upper", spaces.alias("space"), digits.alias("digit"),
        symbols.alias("symbol"), F.length("rest").alias("length"), found.alias("codes"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda i: F.struct(
        F.xxhash64(*(F.get("hashes", i + k) for k in range(3))).alias("key"), i.alias("at")
    )
    windows = F.when(F.col("n_words") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.col("n_words") - 3), window)))
    rows = rows.withColumn("windows", windows).drop("hashes")
    # Windows that occur again lie next to one another; each covers three words, some of them the same.
    again = F.filter(
        "windows",
        lambda x, i: F.coalesce(x["key"] == F.get("windows", i - 1)["key"], F.lit(False))
        | F.coalesce(x["key"] == F.get("windows", i + 1)["key"], F.lit(False)),
    )
    places = F.sort_array(F.transform(again, lambda x: x["at"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        places, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    )["n"]
    other = F.col("length") - F.col("space") - F.col("digit") - F.col("symbol")
    parts = ("lower", "upper", "digit", "space", "symbol")
    counts = [F.length("codes") - F.length(F.replace(F.col("codes"), F.lit(c), F.lit(""))) for c in code.values()]
    found = F.struct(
        F.col("n_words").cast("long").alias("n_words"),
        (F.col("lower") + F.col("upper") + F.col("length")).cast("long").alias("n_chars"),
        (F.col("lower") + F.col("upper") + F.col("length") - F.col("space")).cast("long").alias("word_chars"),
        F.col("symbol").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*(F.col(c).cast("long") for c in parts), other.cast("long")).alias("classes"),
        F.array(*(c.cast("long") for c in counts), (F.col("n_words") - F.length("codes")).cast("long")).alias("words"),
    )
    return rows.select("row.*", found.alias("f"))


def references(featured: DataFrame, bins: int, lang: str = "lang") -> DataFrame:
    """``(lang, classes, words)``: the histograms of each language, summed over all its documents; null is one of them."""
    sums = [F.sum(F.get("f.classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.get("f.words", F.lit(i))).alias(f"w{i}") for i in range(bins)]
    summed = featured.groupBy(F.col(lang).alias("lang")).agg(*sums)
    return summed.select(
        "lang",
        F.array(*(f"c{i}" for i in range(len(CLASSES)))).alias("classes"),
        F.array(*(f"w{i}" for i in range(bins))).alias("words"),
    )


def shares(counts: Column) -> Column:
    """A histogram as parts of 1; null if it is empty."""
    total = F.aggregate(counts, F.lit(0).cast("long"), operator.add)
    return F.when(total > 0, F.transform(counts, lambda n: n / F.nullif(total, F.lit(0))))


def distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of a histogram with its total from the shares of another; null if one is empty."""

    def against(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def both(p: Column, q: Column) -> Column:
        return against(p, q) + against(q, p)

    parts = F.zip_with(counts, reference, lambda n, q: both(F.try_divide(n, total), q))
    sum_ = F.aggregate(parts, F.lit(0.0), operator.add)
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum_ / 2))))


def judge(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    lang: str = "lang",
    common: tuple[str, ...] = COMMON,
    least_chars: int = LEAST_CHARS,
    least_words: int = LEAST_WORDS,
    most_class: float = MOST_CLASS_DISTANCE,
    most_word: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with ``quality``: the counts of :func:`features`, both distances
    (null where a text is too short to be judged by them), ``base_failed`` and ``kept``.

    A document fails the base rules with fewer than 50 words or with over half of its words in repeated three-word
    windows. Otherwise it is kept unless its characters or common words are further from those of its language than
    the limits. Documents without a language are a language of their own. Texts are read once and do not move; the
    counts are written, and the references are a row for each language in a written table, which Spark broadcasts if
    its files are small. Repeated rows stay; a null text has no words and fails.
    """
    featured = features(docs, text, common).select(
        F.struct(*keep).alias("kept_columns"), F.col(lang).alias("lang"), "f"
    )
    featured = staged(featured, "features")
    summed = references(featured, len(dict.fromkeys(common)) + 1)
    refs = F.struct(shares(F.col("classes")).alias("classes"), shares(F.col("words")).alias("words")).alias("ref")
    refs = staged(summed.select(F.col("lang").alias("ref_lang"), refs), "references")
    joined = featured.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    f = F.col("f")
    by_class = F.when(f["n_chars"] >= least_chars, distance(f["classes"], f["n_chars"], F.col("ref.classes")))
    by_word = F.when(f["n_words"] >= least_words, distance(f["words"], f["n_words"], F.col("ref.words")))
    failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
    measured = joined.select(
        "kept_columns", "f", by_class.alias("by_class"), by_word.alias("by_word"), failed.alias("failed")
    )
    unlike = F.coalesce(F.col("by_class") > most_class, F.lit(False)) | F.coalesce(F.col("by_word") > most_word, F.lit(False))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    quality = F.struct(
        *(f[n].alias(n) for n in names), F.col("by_class").alias("class_distance"),
        F.col("by_word").alias("word_distance"), F.col("failed").alias("base_failed"),
        (~F.col("failed") & ~unlike).alias("kept"),
    )
    return measured.select(*(F.col(f"kept_columns.{c}").alias(c) for c in keep if c != "quality"), quality.alias("quality"))
