"""The tab-separated text form of an index: ``temp``, ``doc_info``, ``words`` and ``vectorized``.

* ``temp``: ``word TAB count``, one line per document and word
* ``doc_info``: ``documents TAB average length``
* ``words``: ``word TAB idf TAB word id``
* ``vectorized``: ``d TAB {"id", "title", "url", "docLength", "vectorized": "id:weight;..."}``
* ``counts``: ``document id TAB length TAB word id,... TAB count,...``, the document id as in a URL, beside the four others, so that no count has to be worked back

The three datasets with a line or more for each document are compressed (gzip), which is undone wherever Hadoop or Spark
reads text; ``doc_info`` and ``words`` are plain, as they are also opened as files.

Search results have one too: ``{"title", "url", "relevance"} TAB relevance``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from termloom.functions import vectors
from termloom.operators.skew import lookup_join
from termloom.plans.index import Index, StoredIndex, bucket_limits, default_buckets, save_analysed
from termloom.session import deleted, durable, moved, path_exists, published, setting


def term_count_lines(index: Index) -> DataFrame:
    return index.postings.select(F.concat_ws("\t", "term", F.col("tf").cast("string")).alias("value"))


def stats_lines(index: Index) -> DataFrame:
    return index.stats.select(
        F.concat_ws("\t", F.col("n_docs").cast("string"), F.col("avgdl").cast("string")).alias("value")
    )


def word_lines(index: Index) -> DataFrame:
    numbers = [F.col(name).cast("string") for name in ("idf", "word_id")]
    return index.vocabulary().select(F.concat_ws("\t", "term", *numbers).alias("value"))


def count_lines(index: Index) -> DataFrame:
    """One line for every document."""
    return index.vectors(every=True, counts=True).select(_count_line().alias("value"))


def _count_line() -> Column:
    # Any id, one with a tab or a line end too, is one field of one line. An unknown count is written as 0.
    fields = (
        F.url_encode("id"), F.col("doc_length").cast("string"),
        vectors.encode_list(F.col("vector.word_id")), vectors.encode_list(F.col("tfs")),
    )
    return F.concat_ws("\t", *fields)


def vector_lines(index: Index) -> DataFrame:
    """One line for every document; one without tokens has an empty vector."""
    return index.vectors(every=True).select(_vector_line().alias("value"))


def _vector_line() -> Column:
    json = vectors.document_json(*(F.col(c) for c in ("id", "title", "url", "doc_length", "vector")))
    return F.concat_ws("\t", F.lit("d"), json)


def result_lines(results: DataFrame) -> DataFrame:
    """``{"title", "url", "relevance"} TAB relevance``, best first."""
    json = F.to_json(F.struct("title", "url", "relevance"))
    order = [c for c in ("query_id", "rank") if c in results.columns]
    line = F.concat_ws("\t", json, F.col("relevance").cast("string"))
    return results.orderBy(*order).select(line.alias("value"))


def export_results(results: DataFrame, path: str) -> None:
    """Write result lines to a path that must not exist."""
    with published(results.sparkSession, path) as work:
        result_lines(results).write.text(work)


def export_text_index(index: Index, path: str) -> None:
    """Write the text datasets under a path that must not exist; texts are analysed once, words numbered and joined once.

    Both lines of a document are written by the task that puts its vector together: nothing of it is kept in between.
    """
    with published(index.spark, path) as work:
        index = index.once().numbered()
        _compressed(term_count_lines(index)).text(f"{work}/temp")
        stats_lines(index).write.text(f"{work}/doc_info")
        word_lines(index).write.text(f"{work}/words")
        docs = index.vectors(every=True, counts=True)
        each = {"counts": _count_line(), "vectorized": _vector_line()}
        lines = F.array(*(F.struct(F.lit(name).alias("dataset"), line.alias("value")) for name, line in each.items()))
        # A writer for each of the two datasets, or the lines would be sorted by their dataset first.
        with setting(index.spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(each))):
            _compressed(docs.select(F.inline(lines))).partitionBy("dataset").text(f"{work}/lines")
        for name in each:
            if path_exists(index.spark, part := f"{work}/lines/dataset={name}"):
                moved(index.spark, part, f"{work}/{name}")
            else:  # there is no document
                index.spark.createDataFrame([], "value string").write.text(f"{work}/{name}")
        deleted(index.spark, f"{work}/lines")


def _compressed(lines: DataFrame) -> DataFrameWriter:
    return lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")


def parse_vector_lines(lines: DataFrame) -> DataFrame:
    """``(id, title, url, doc_length, vectorized)`` from ``d TAB json`` lines; the vector is still text."""
    parsed = vectors.parse_document_json(F.split_part("value", F.lit("\t"), F.lit(2)))
    # By a generator, below which no filter is moved: a line is parsed once.
    return lines.select(F.inline(F.array(parsed))).withColumnRenamed("docLength", "doc_length")


def read_text_index(spark: SparkSession, path: str, idf_type: str = "log") -> Index:
    """An index from its text form, to search, to read or to save.

    Counts are read from ``counts``. A text form without it keeps weights only: tf is then worked back from weight and
    idf, and a word with idf 0, which has no count to recover, has a null tf. Weights are the stored ones.
    The token total is the sum of the document lengths.
    """

    def part(name: str, *fields: tuple[str, str]) -> DataFrame:
        lines = spark.read.option("pathGlobFilter", "part*").text(f"{path}/{name}")
        return lines.select(
            *(F.split_part("value", F.lit("\t"), F.lit(i)).cast(t).alias(f) for i, (f, t) in enumerate(fields, 1))
        )

    missing = [name for name in ("doc_info", "words", "vectorized") if not path_exists(spark, f"{path}/{name}")]
    if missing:
        raise FileNotFoundError(f"{path} is not a complete index: no {', '.join(missing)}")
    info = spark.read.text(f"{path}/doc_info")
    stats = info.select(
        F.split_part("value", F.lit("\t"), F.lit(1)).cast("long").alias("n_docs"),
        F.split_part("value", F.lit("\t"), F.lit(2)).cast("double").alias("avgdl"),
    )
    words = part("words", ("term", "string"), ("idf", "double"), ("word_id", "long"))
    n_docs = stats.select("n_docs").scalar().cast("double")
    df = F.lit(1.0) / F.col("idf") if idf_type == "normal" else n_docs * F.exp(-F.col("idf"))
    vocab = durable(words.withColumn("df", F.round(df).cast("long")))

    lines_of = spark.read.option("pathGlobFilter", "part*")
    parsed = parse_vector_lines(lines_of.text(f"{path}/vectorized"))
    docs = parsed.drop("vectorized")
    total = docs.agg(F.coalesce(F.sum("doc_length"), F.lit(0)).alias("total_tokens")).select("total_tokens").scalar()
    stats = stats.select("n_docs", total.alias("total_tokens"), "avgdl")
    counts = None
    if path_exists(spark, f"{path}/counts"):
        lists = (vectors.decode_list(F.col(name)).alias(name) for name in ("word_id", "tf"))
        lines = part("counts", ("id", "string"), ("doc_length", "long"), ("word_id", "string"), ("tf", "string"))
        # The lists are given as an expression: see text.entries().
        counts = lines.select(F.url_decode("id").alias("id"), "doc_length", F.inline(F.arrays_zip(*lists)))
        counts = counts.withColumn("tf", F.nullif("tf", F.lit(0)))
    return TextIndex(docs, stats, vocab, parsed, counts, idf_type)


class TextIndex(Index):
    """An index read from text: the word ids and the weights are the file's own."""

    def __init__(self, docs, stats, vocab, parsed: DataFrame, counts: DataFrame | None, idf_type: str):
        self.parsed = parsed
        self.counts = counts
        super().__init__(docs, stats, vocab, None, idf_type, drop_empty=False)

    @property
    def postings(self) -> DataFrame:
        """A line of ``counts`` has the postings of a document; only words are looked up. Without it weights are worked back."""
        if self._postings is None:
            if self.counts is None:
                self._postings = self.weighted.drop("tfidf")
            else:
                words = self.vocab.select("word_id", "term", "df")
                rows = lookup_join(self.counts, words, "word_id", weight="df", spread="id")
                self._postings = rows.select("term", "id", "tf", "doc_length")
        return self._postings

    @postings.setter
    def postings(self, frame: DataFrame | None) -> None:
        self._postings = frame

    @functools.cached_property
    def weighted(self) -> DataFrame:
        """``(term, id, tf, doc_length, tfidf)``, from the entries of the vectors and, where there are any, their counts."""
        entries = self.parsed.select("id", "doc_length", F.inline(vectors.decode(F.col("vectorized"))))
        if self.counts is None:
            entries = entries.withColumn("tf", F.lit(None).cast("long"))
        else:
            entries = entries.join(self.counts.drop("doc_length"), ["id", "word_id"], "left")
        worked_back = F.round(F.try_divide("weight", "idf")).cast("long")
        return lookup_join(entries, self.vocab, "word_id", weight="df", spread="id").select(
            "term", "id", F.coalesce("tf", worked_back).alias("tf"), "doc_length", F.col("weight").alias("tfidf")
        )

    def vocabulary(self) -> DataFrame:
        return self.vocab.select("term", "df", "idf", "word_id")

    def vectors(self, every: bool = False, counts: bool = False) -> DataFrame:
        """As for any index; the file has them, so nothing is joined, unless their counts are wanted."""
        if counts:
            return super().vectors(every, counts)
        entries = vectors.decode(F.col("vectorized"))
        found = self.parsed if every else self.parsed.where("vectorized <> ''")
        return found.select("id", "title", "url", "doc_length", F.sort_array(entries).alias("vector"))

    def _weighted(self, vocab: DataFrame, postings: DataFrame | None = None) -> DataFrame:
        words = vocab.select("term", "df", *(["word_id"] if "word_id" in vocab.columns else []))
        return lookup_join(self.weighted, words, "term", weight="df", spread="id")

    def save(self, path: str, buckets: int | None = None) -> StoredIndex:
        """Write the fast layout, as for a corpus; the terms of a document are put together first."""
        entry = F.struct("term", "tf")
        terms = self.postings.groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("terms"))
        none = F.array().cast("array<struct<term:string,tf:bigint>>")
        rows = self.docs.join(terms, "id", "left").withColumn("terms", F.coalesce("terms", none))
        size = rows.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, e: n + F.octet_length(e["term"]) * e["tf"])))
        if buckets is None:
            buckets = default_buckets(size.first()[0] or 0, *bucket_limits(self.spark))
        analysed = rows.select("id", "title", "url", "doc_length", "terms").repartition(buckets, "id")
        return save_analysed(analysed, path, buckets, self.idf_type, self.drop_empty, self.stats, self.vocab)
