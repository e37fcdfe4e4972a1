"""Phrases: where words follow one another, and which documents contain a whole text.

A phrase index has the places of every word of every document. Words are those of :func:`termloom.functions.text.tokens`
without empty ones, so a phrase is found whatever stands between its words and however they are capitalised.
"""

from __future__ import annotations

import functools


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import SEPARATOR, term_places, tokens
from termloom.operators import bloom, skew
from termloom.plans.index import PUSHED_VALUES, Index, bucket_limits, default_buckets, equals_any
from termloom.session import durable, path_exists, published, qualified, refuse_existing
from termloom.sources.corpus import text_bytes

PLACES_SCHEMA = "term STRING, id STRING, places ARRAY<INT>"
TERMS_SCHEMA = "term STRING, df BIGINT, n_places BIGINT"


class PhraseIndex:
    """``postings(term, id, places)`` and ``vocab(term, df, n_places)``."""

    def __init__(self, postings: DataFrame, vocab: DataFrame):
        self.postings = postings
        self.vocab = vocab

    def once(self) -> PhraseIndex:
        """The same index, worked out now and kept, to be used again and again."""
        kept = durable(self.postings)
        return PhraseIndex(kept, _term_sizes(kept))

    @staticmethod
    def load(spark: SparkSession, path: str) -> PhraseIndex:
        path = qualified(spark, path)
        missing = [name for name in ("postings", "vocab") if not path_exists(spark, f"{path}/{name}")]
        if missing:
            raise FileNotFoundError(f"{path} is not a complete phrase index: no {', '.join(missing)}")
        return PhraseIndex(
            spark.read.schema(PLACES_SCHEMA).parquet(f"{path}/postings"),
            spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/vocab"),
        )


def phrase_index(corpus: DataFrame) -> PhraseIndex:
    """An index over ``(id, text)`` that is worked out when used, without an exchange of the places."""
    entries = corpus.select("id", F.inline(term_places(tokens(F.col("text"), drop_empty=True))))
    return PhraseIndex(entries.select("term", "id", "places"), _term_sizes(entries))


def save_phrase_index(corpus: DataFrame, path: str, parts: int | None = None) -> PhraseIndex:
    """Write the index to a path that must not exist; it becomes visible by one rename.

    Documents are exchanged once, by id, so parts are even however common a word is; within a part the rows are sorted
    by term, so a lookup skips the row groups of other words.
    """
    spark = corpus.sparkSession
    refuse_existing(spark, path)
    if parts is None:
        parts = default_buckets(text_bytes(corpus), *bucket_limits(spark))
    dealt = corpus.select("id", "text").repartition(parts, "id")
    places = phrase_index(dealt).postings
    with published(spark, path) as work:
        # The texts are exchanged and analysed after it, once; the vocabulary is counted from what was written.
        places.sortWithinPartitions("term", "id").write.parquet(f"{work}/postings")
        stored = spark.read.schema(PLACES_SCHEMA).parquet(f"{work}/postings")
        _term_sizes(stored).repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{work}/vocab")
    return PhraseIndex.load(spark, path)


def _term_sizes(entries: DataFrame) -> DataFrame:
    return entries.groupBy("term").agg(
        F.count("*").alias("df"), F.sum(F.size("places").cast("long")).alias("n_places")
    )


def phrase_search(index: PhraseIndex, phrases: DataFrame) -> DataFrame:
    """``(query_id, id, occurrences)``: the documents that have the words of a phrase one after another, and how often.

    ``phrases`` is ``(query_id, text)``, each id once. Whole words are compared, from the index alone. Occurrences may
    overlap. A phrase without a word, or that is null, is in no document.
    """
    words = _phrase_words(phrases).select("query_id", F.col("n").alias("need"), "offset", "term")
    return _places_of(index, words).groupBy("query_id", "id").agg(F.count("*").alias("occurrences"))


def documents_containing(corpus: DataFrame, index: PhraseIndex | Index, items: DataFrame) -> DataFrame:
    """``(query_id, id)``: the documents whose text has an item's text in it, character for character.

    ``items`` is ``(query_id, text)``, each id once; ``index`` is one of the corpus, of words or of their places.
    The words of an item but its first and last, which may be parts of longer words, must all be known and follow one
    another in a document; without their places the rarest of them must be there. Only texts of such documents are
    compared. Items of one or two words go by the words of the vocabulary that hold, end with or begin with theirs.
    Items without a letter are looked up among what stands between words; the empty text is in every document, and a
    null in none.
    """
    split = tokens(F.col("text"), drop_empty=True)
    items = durable(items.where(F.col("text").isNotNull()).select("query_id", "text", F.size(split).alias("n")))
    # Which kinds of items there are decides which routes are taken: at most four rows.
    kinds = {row[0] for row in items.select(F.least("n", F.lit(3))).distinct().collect()}
    words = _phrase_words(items)
    inner = words.where("offset > 0 AND offset < n - 1")
    inner = inner.select("query_id", (F.col("n") - 2).alias("need"), (F.col("offset") - 1).alias("offset"), "term")
    edges = words.where("n <= 2").select(
        "query_id", "offset", F.translate("term", "ς", "σ").alias("key"),
        F.when(F.col("n") == 1, "holds").when(F.col("offset") == 0, "ends").otherwise("begins").alias("kind"),
    )
    found = []
    if not isinstance(index, PhraseIndex):
        index = PhraseIndex(index.postings, index.vocab.select("term", "df", F.col("df").alias("n_places")))
        if 3 in kinds:
            found.append(_with_rarest(index, durable(_anchors(_known(index.vocab, inner)))))
    elif 3 in kinds:
        found.append(_places_of(index, inner))
    found = [rows.select("query_id", "id").distinct() for rows in found]
    if kinds & {1, 2}:
        found.append(_edge_documents(index, edges))
    result = _with_text(corpus, items.drop("n"), functools.reduce(DataFrame.unionByName, found)) if found else None
    if 0 in kinds:
        wordless = items.where("n = 0")
        between = _between_words(corpus, wordless, _lengths(wordless, "text"))
        result = between if result is None else result.unionByName(between)
    if result is None:
        result = items.select("query_id", F.lit(None).cast(corpus.schema["id"].dataType).alias("id")).where(F.lit(False))
    return result


def _with_text(corpus: DataFrame, items: DataFrame, candidates: DataFrame) -> DataFrame:
    """Those of the candidates ``(query_id, id)`` whose text has the item's text in it."""
    candidates = durable(candidates)
    small = items.agg(skew.byte_size(items)).first()[0] <= skew.BROADCAST_BYTES
    asked = candidates.groupBy("query_id").agg(F.count("*").alias("asked"))
    texts = items.withColumnRenamed("text", "item")
    if small:
        pairs = candidates.join(F.broadcast(texts), "query_id")
    else:
        pairs = skew.salted_join(candidates, texts, skew.hot_keys(asked, "query_id", "asked"), "query_id", "id")
    if pairs.agg(skew.byte_size(pairs)).first()[0] <= skew.BROADCAST_BYTES:
        met = corpus.select("id", "text").join(F.broadcast(pairs), "id")
    else:
        wanted = bloom.passing(corpus.select("id", "text"), bloom.filter_of(candidates, "id"))
        met = wanted.join(pairs, "id")
    return met.where(F.contains("text", "item")).select("query_id", "id")


def _phrase_words(phrases: DataFrame) -> DataFrame:
    """``(query_id, n, offset, term)``: the words of each phrase in order, and how many it has."""
    words = phrases.select("query_id", tokens(F.col("text"), drop_empty=True).alias("words"))
    return words.select("query_id", F.size("words").alias("n"), F.posexplode("words").alias("offset", "term"))


def _places_of(index: PhraseIndex, words: DataFrame) -> DataFrame:
    """``(query_id, id, start)`` for ``(query_id, need, offset, term)``, the ``need`` words of each phrase.

    The rarest word of a phrase says where the phrase may start; the others are looked up there only, by document and
    term, so common words cost no more than the rarest one has places.
    """
    words = durable(words)
    known = durable(_known(index.vocab, words))
    anchors = durable(_anchors(known))
    met = _with_rarest(index, anchors)
    starts = met.select("query_id", "id", "need", "offset", F.explode("places").alias("place"))
    starts = durable(starts.select("query_id", "id", "need", (F.col("place") - F.col("offset")).alias("start")).where("start >= 0"))
    alone = starts.where("need = 1").select("query_id", "id", "start")

    # The other words of each phrase, one row for each phrase; a group holds the words of one phrase.
    others = known.join(anchors.select("query_id", "offset"), ["query_id", "offset"], "left_anti")
    asked = starts.groupBy("query_id").agg(F.count("*").alias("asked"))
    rest = others.groupBy("query_id").agg(F.collect_list(F.struct("offset", "term")).alias("rest")).join(asked, "query_id")
    flat = rest.select("query_id", F.to_json("rest").alias("rest"), "asked")  # a plain column, to be measured
    looked = skew.lookup_join(starts.where("need > 1"), durable(flat), "query_id", weight="asked", spread="id")
    parsed = F.from_json("rest", "array<struct<offset: int, term: string>>")
    looked = looked.select("query_id", "id", "need", "start", F.inline(parsed))
    looked = durable(looked.select("query_id", "id", "need", "start", "term", (F.col("start") + F.col("offset")).alias("at")))
    postings = _restricted(index.postings, others)
    if looked.agg(skew.byte_size(looked)).first()[0] <= skew.BROADCAST_BYTES:
        together = postings.join(F.broadcast(looked), ["id", "term"])
    else:
        together = bloom.passing(postings, bloom.filter_of(looked, "id")).join(looked, ["id", "term"])
    right = together.where(F.array_contains("places", F.col("at"))).groupBy("query_id", "id", "start", "need")
    joint = right.agg(F.count("*").alias("right")).where("right = need - 1").select("query_id", "id", "start")
    return alone.unionByName(joint)


def _anchors(known: DataFrame) -> DataFrame:
    """``(query_id, need, offset, term, df)``: the rarest word of each phrase all of whose words are known."""
    rarest = known.groupBy("query_id").agg(
        F.count("*").alias("found"), F.first("need").alias("need"),
        F.min(F.struct("n_places", "offset", "term", "df")).alias("word"),
    ).where("found = need")
    return rarest.select("query_id", "need", "word.offset", "word.term", "word.df")


def _with_rarest(index: PhraseIndex, anchors: DataFrame) -> DataFrame:
    sizes = anchors.groupBy("term").agg(F.first("df").alias("df"))
    return _meet(_restricted(index.postings, anchors), anchors.drop("df"), sizes)


def _known(vocab: DataFrame, words: DataFrame) -> DataFrame:
    """Words with ``df`` and ``n_places`` of the vocabulary, which is never broadcast."""
    if words.agg(skew.byte_size(words)).first()[0] <= skew.BROADCAST_BYTES:
        return vocab.join(F.broadcast(words), "term")
    vocab = bloom.passing(vocab, bloom.filter_of(words, "term"))
    askers = words.groupBy("term").agg(F.count("*").alias("askers"))
    return skew.salted_join(words, vocab, skew.hot_keys(askers, "term", "askers"), "term", "query_id")


def _meet(postings: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Postings with the phrases that hold their term; hot terms are divided on both sides of an exchange."""
    if words.agg(skew.byte_size(words)).first()[0] <= skew.BROADCAST_BYTES:
        return postings.join(F.broadcast(words), "term")
    askers = words.groupBy("term").agg(F.count("*").alias("askers"))
    copies = skew.hot_keys(askers, "term", "askers").withColumnRenamed("splits", "copies")
    hot = skew.hot_keys(sizes, "term", "df").join(copies, "term", "full")
    wanted = bloom.passing(postings, bloom.filter_of(words, "term"))
    return skew.salted_join(wanted, words, hot, "term", "id", "query_id")


def _restricted(postings: DataFrame, words: DataFrame) -> DataFrame:
    """The postings with the terms pushed into the scan, if they are few."""
    terms = [row["term"] for row in words.select("term").distinct().limit(PUSHED_VALUES + 1).collect()]
    return postings if len(terms) > PUSHED_VALUES else postings.where(equals_any("term", terms))


def _lengths(rows: DataFrame, column: str) -> list[int]:
    """The distinct lengths of some strings: at most as many as the longest has characters."""
    return sorted(row[0] for row in rows.select(F.length(column)).distinct().collect())


def _windows(text: Column, lengths: list[int]) -> Column:
    """``array<struct<key, begins, ends>>``: every part of a text that has one of the lengths."""

    def parts(n: Column) -> Column:
        last = F.length(text) - n + 1
        places = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places,
            lambda at: F.struct(F.substring(text, at, n).alias("key"), (at == 1).alias("begins"), (at == last).alias("ends")),
        )

    return F.flatten(F.transform(F.array(*(F.lit(n) for n in lengths)), parts))


def _edge_documents(index: PhraseIndex, edges: DataFrame) -> DataFrame:
    """``(query_id, id)``: documents with a word that holds, ends with or begins with a word of a short item.

    Of an item of two words the rarer end is followed. Words of the vocabulary meet the items by their parts of the same
    length, one equality join. The last letter of a Greek word is written differently and counts as the same.
    """
    edges = durable(edges)
    lengths = _lengths(edges, "key")
    spelled = F.translate("term", "ς", "σ")
    parts = index.vocab.select("term", "df", "n_places", F.inline(_windows(spelled, lengths)))
    small = edges.agg(skew.byte_size(edges)).first()[0] <= skew.BROADCAST_BYTES
    met = parts.join(F.broadcast(edges) if small else edges, "key")
    fits = (F.col("kind") == "holds") | ((F.col("kind") == "ends") & F.col("ends")) | ((F.col("kind") == "begins") & F.col("begins"))
    words = durable(met.where(fits).select("query_id", "offset", "term", "df", "n_places").distinct())
    # An end that no word of the vocabulary has is as rare as can be: such an item is nowhere.
    ends = edges.select("query_id", "offset").join(
        words.groupBy("query_id", "offset").agg(F.sum("n_places").alias("n_places")), ["query_id", "offset"], "left"
    )
    rarest = ends.groupBy("query_id").agg(F.min(F.struct(F.coalesce("n_places", F.lit(0)), "offset"))["offset"].alias("offset"))
    anchors = durable(words.join(rarest, ["query_id", "offset"]).select("query_id", "term", "df"))
    return _with_rarest(index, anchors).select("query_id", "id").distinct()


def _between_words(corpus: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """``(query_id, id)`` for texts without a letter: each is a part of what stands between two words, or empty."""
    gaps = F.array_distinct(F.regexp_extract_all("text", F.lit(f"({SEPARATOR})"), F.lit(1)))
    longer = [n for n in lengths if n]
    keys = F.array(F.lit("")) if 0 in lengths else F.array().cast("array<string>")
    if longer:
        within = F.flatten(F.transform(gaps, lambda gap: F.transform(_windows(gap, longer), lambda w: w["key"])))
        keys = F.array_union(keys, within)
    there = corpus.where(F.col("text").isNotNull()).select("id", F.explode(keys).alias("key"))
    wanted = durable(items.select("query_id", F.col("text").alias("key")))
    small = wanted.agg(skew.byte_size(wanted)).first()[0] <= skew.BROADCAST_BYTES
    return there.join(F.broadcast(wanted) if small else wanted, "key").select("query_id", "id")
