"""The index: documents, corpus statistics, vocabulary and postings.

An index built from a corpus is lazy: each of its frames is a plan over the corpus. :meth:`CorpusIndex.save` writes
it with one exchange and one analysis of the documents; a saved index is laid out for queries.
"""

from __future__ import annotations

import copy
import functools
import hashlib
import math
import operator
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from termloom.functions import scoring, vectors
from termloom.operators import statistics
from termloom.operators.ranking import number_rows
from termloom.operators.skew import BROADCAST_BYTES, byte_size, lookup_join, lookup_parts
from termloom.session import durable, path_exists, published, qualified, refuse_existing, setting, stored, written
from termloom.sources.corpus import count_unique, first_of_each_id, text_bytes

STATS_SCHEMA = (
    "n_docs BIGINT, total_tokens BIGINT, avgdl DOUBLE, idf_type STRING, drop_empty BOOLEAN, buckets INT, shards INT, "
    "build STRING"
)
DOCS_SCHEMA = "id STRING, title STRING, url STRING, doc_length BIGINT, shard INT"
# Besides df and idf a term has bounds of what it can add to a score, and where its postings are: the first and the last
# bucket, and one bit for each remainder of a bucket by 64.
VOCAB_SCHEMA = (
    "term STRING, df BIGINT, idf DOUBLE, word_id BIGINT, max_tf BIGINT, peak DOUBLE, "
    "first_bucket INT, last_bucket INT, bucket_bits BIGINT"
)
FILES_SCHEMA = "file STRING, bytes BIGINT"
POSTINGS_SCHEMA = "term STRING, id STRING, tf BIGINT, doc_length BIGINT"

# Up to this many values are compared one by one in the scan; longer lists are filtered by their join alone.
PUSHED_VALUES = 256

# UTF-8 bytes of text per bucket of a saved index.
LEAST_PER_BUCKET = 1024 * 1024
MOST_PER_BUCKET = 256 * 1024 * 1024

# A list of terms that is in at most this share of the buckets has the others' files left out.
PRUNED_SHARE = 0.5

# Most directories the stored documents are divided into.
DOCUMENT_SHARDS = 1024


class Index:
    """What search needs: frames, the statistics as columns, and ways to read only some terms.

    ``docs(id, title, url, doc_length)``, ``stats(n_docs, total_tokens, avgdl)``, ``vocab(term, df, idf)`` and
    ``postings(term, id, tf, doc_length)``.
    """

    def __init__(
        self, docs: DataFrame, stats: DataFrame, vocab: DataFrame, postings: DataFrame, idf_type: str, drop_empty: bool
    ):
        self.docs = docs
        self.stats = stats
        self.vocab = vocab
        self.postings = postings
        self.idf_type = idf_type
        self.drop_empty = drop_empty
        self.words = None

    @property
    def spark(self) -> SparkSession:
        return self.docs.sparkSession

    @property
    def avgdl(self) -> Column:
        return self.stats.select("avgdl").scalar()

    def restricted(self, terms: list[str]) -> Index:
        """The same index with the vocabulary and postings of these terms only."""
        if len(terms) > PUSHED_VALUES:
            return self
        wanted = equals_any("term", terms)
        narrow = copy.copy(self)
        narrow.vocab = self.vocab.where(wanted)
        narrow.postings = self.postings.where(wanted)
        return narrow

    def with_documents(self, ranked: DataFrame, at_most: int) -> DataFrame:
        """Title and url for at most so many ranked rows; few bytes are broadcast, so documents are not exchanged."""
        return self.docs.select("id", "title", "url").join(broadcast_small(durable(ranked)), "id")

    def once(self) -> Index:
        """The same index with frames that can be used again and again without reading the texts again."""
        return self

    def numbered(self) -> Index:
        """The same index with its vocabulary, numbered once, kept."""
        index = copy.copy(self)
        index.words = durable(self.vocabulary())
        return index

    def vocabulary(self) -> DataFrame:
        """``(term, df, idf, word_id)``; word ids count from 0 in byte order of the terms."""
        return number_rows(self.vocab, "term", name="word_id") if self.words is None else self.words

    def tfidf_postings(self) -> DataFrame:
        """``(term, id, tf, doc_length, tfidf)``."""
        return self._weighted(durable(self.vocab)).select("term", "id", "tf", "doc_length", "tfidf")

    def vectors(self, every: bool = False, counts: bool = False) -> DataFrame:
        """``(id, title, url, doc_length, vector)``, the vector in word-id order; documents with a token, or ``every`` one.

        With ``counts`` there is a ``tfs`` too, the count of the word of each entry, 0 if unknown.
        """
        weighted = self._weighted(self.vocabulary(), self.postings.select("term", "id", "tf"))
        return _with_vectors(self.docs.select("id", "title", "url", "doc_length"), [weighted], "id", every, counts)

    def _weighted(self, vocab: DataFrame, postings: DataFrame | None = None) -> DataFrame:
        joined = lookup_join(self.postings if postings is None else postings, vocab, "term", weight="df", spread="id")
        return joined.withColumn("tfidf", scoring.tfidf(F.col("tf"), F.col("idf")))

    def summary(self) -> DataFrame:
        """One row: documents, tokens, average length, distinct terms, postings."""
        sizes = self.vocab.agg(F.count("*").alias("n_terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("n_postings"))
        both = self.stats.withColumn("sizes", sizes.select(F.struct("n_terms", "n_postings")).scalar())
        return both.select("n_docs", "total_tokens", "avgdl", "sizes.*")

    def save(self, path: str, buckets: int | None = None) -> StoredIndex:
        raise NotImplementedError("this index has no corpus to write")

    @staticmethod
    def load(spark: SparkSession, path: str, verify: bool = False) -> StoredIndex:
        """A saved index; every part of it must be there. ``verify`` compares all its files with their list."""
        return load_index(spark, path, verify)


class CorpusIndex(Index):
    """An index over a corpus frame, computed when used."""

    def __init__(self, corpus: DataFrame, idf_type: str, avgdl: str, drop_empty: bool):
        docs = statistics.documents(corpus, drop_empty)
        stats = statistics.corpus_stats(docs, avgdl)
        pairs = statistics.distinct_terms(corpus, drop_empty)
        idf = scoring.idf(F.col("df"), stats.select("n_docs").scalar(), idf_type)
        vocab = statistics.document_frequency(pairs).withColumn("idf", idf)
        postings = statistics.term_frequency(corpus, drop_empty).select("term", "id", "tf", "doc_length")
        super().__init__(docs, stats, vocab, postings, idf_type, drop_empty)
        self.corpus = corpus
        self.avgdl_mode = avgdl

    def once(self) -> Index:
        """Reads and analyses the texts once, now, and keeps all terms."""
        numbered = statistics.analysed(self.corpus, self.drop_empty).withColumn("doc", F.monotonically_increasing_id())
        kept = stored(numbered, "analysed")
        index = self._over(kept, kept.select("id", "title", "url", "doc_length"))
        vocab = stored(index.vocab, "vocab")
        return KeptIndex(index.docs, index.stats, vocab, index.postings, self.idf_type, self.drop_empty, kept)

    def vectors(self, every: bool = False, counts: bool = False) -> DataFrame:
        """As for any index; the texts are analysed once."""
        return self.once().vectors(every, counts)

    def _over(self, kept: DataFrame, docs: DataFrame) -> Index:
        stats = statistics.corpus_stats(kept, self.avgdl_mode)
        df = statistics.document_frequency(kept.select(F.explode("terms.term").alias("term")))
        vocab = df.withColumn("idf", scoring.idf(F.col("df"), stats.select("n_docs").scalar(), self.idf_type))
        postings = kept.select("id", "doc_length", F.inline("terms")).select("term", "id", "tf", "doc_length")
        return Index(docs, stats, vocab, postings, self.idf_type, self.drop_empty)

    def restricted(self, terms: list[str]) -> Index:
        """Reads the texts once, now: the documents' lengths and counts of these terms are kept."""
        narrow = statistics.analysed(self.corpus, self.drop_empty, only=terms).drop("title", "url")
        return self._over(durable(narrow), self.docs)

    def save(self, path: str, buckets: int | None = None) -> StoredIndex:
        """Write the index to a path that must not exist.

        The documents are exchanged once, by id, into ``buckets`` parts (default: see ``default_buckets``), and
        analysed once, after it: their text is smaller than their postings. Ids are unique, so the parts are
        even however common a word is. Postings are sorted by term within each part and bucketed by id: a search
        prunes to its terms and adds up each document where it lies.
        """
        refuse_existing(self.spark, path)
        if buckets is None:
            buckets = default_buckets(text_bytes(self.corpus), *bucket_limits(self.spark))
        analysed = statistics.analysed(self.corpus.repartition(buckets, "id"), self.drop_empty)
        return save_analysed(analysed, path, buckets, self.idf_type, self.drop_empty, self.avgdl_mode)


class KeptIndex(Index):
    """An index over documents that were analysed and kept, each with a number of its own."""

    def __init__(self, docs, stats, vocab, postings, idf_type, drop_empty, kept: DataFrame):
        super().__init__(docs, stats, vocab, postings, idf_type, drop_empty)
        self.kept = kept

    def vectors(self, every: bool = False, counts: bool = False) -> DataFrame:
        """As for any index; a posting is exchanged with the number of its document only."""
        rows = self.kept.select("doc", F.inline("terms"))
        weighted = lookup_join(rows, self.vocabulary(), "term", weight="df", spread="doc")
        weighted = weighted.withColumn("tfidf", scoring.tfidf(F.col("tf"), F.col("idf")))
        docs = self.kept.select("doc", "id", "title", "url", "doc_length")
        return _with_vectors(docs, [weighted], "doc", every, counts).drop("doc")


def _with_vectors(docs: DataFrame, weighted: list[DataFrame], key: str, every: bool, counts: bool) -> DataFrame:
    """``docs`` with the ``vector``, and the ``tfs`` if wanted, of the postings in all frames; each posting is in one.

    Each frame is gathered by itself, so one whose postings lie by document already stays where it is. A group holds the
    distinct words of one document.
    """
    entry = F.struct("word_id", F.col("tfidf").alias("weight"), *([F.coalesce("tf", F.lit(0)).alias("tf")] if counts else []))
    none = F.array().cast("array<struct<word_id: bigint, weight: double" + (", tf: bigint>>" if counts else ">>"))
    names = [f"entries_{i}" for i in range(len(weighted))]
    joined = docs
    for name, rows in zip(names, weighted):
        found = rows.groupBy(key).agg(F.collect_list(entry).alias(name))
        joined = joined.join(found, key, "left" if every or len(weighted) > 1 else "inner")
    if not every and len(weighted) > 1:
        joined = joined.where(F.coalesce(*names).isNotNull())
    joined = joined.withColumn("entries", F.sort_array(F.concat(*(F.coalesce(name, none) for name in names)))).drop(*names)
    if not counts:
        return joined.withColumnRenamed("entries", "vector")
    pairs = F.arrays_zip("entries.word_id", "entries.weight").cast(vectors.VECTOR_TYPE).alias("vector")
    return joined.select(*docs.columns, pairs, F.col("entries.tf").alias("tfs"))


def save_analysed(
    analysed: DataFrame, path: str, buckets: int, idf_type: str, drop_empty: bool, stats: str | DataFrame,
    vocab: DataFrame | None = None,
) -> StoredIndex:
    """Write an index from rows of :func:`statistics.analysed` that are dealt by id into ``buckets`` parts.

    ``stats`` is how to average lengths, or the statistics themselves; a vocabulary with word ids is kept as it is.
    All is written beside ``path`` and becomes it by one rename: an index that can be seen is whole.
    """
    spark = analysed.sparkSession
    most = bucket_limits(spark)[1]
    if not 1 <= buckets <= most:
        raise ValueError(f"an index has 1 to {most} buckets, not {buckets}")
    shards = largest_divisor(buckets, DOCUMENT_SHARDS)
    build = uuid.uuid4().hex
    with published(spark, path) as work, written(analysed, "analysed") as staged:
        totals = (statistics.corpus_stats(staged, stats) if isinstance(stats, str) else stats).first()
        facts = _term_facts(staged, buckets, totals["avgdl"])
        if vocab is None:
            weighed = facts.withColumn("idf", scoring.idf(F.col("df"), F.lit(totals["n_docs"]), idf_type))
            vocab = number_rows(weighed, "term", name="word_id")
        else:
            kept = vocab.select("term", "df", "idf", "word_id")
            vocab = kept.join(facts.drop("df"), "term", "left").repartitionByRange("term")
        columns = [column.split()[0] for column in VOCAB_SCHEMA.split(", ")]
        vocab.select(columns).sortWithinPartitions("term").write.parquet(f"{work}/vocab")

        # A staged part lies wholly in one shard and one bucket, so these two need no exchange.
        (
            staged.select("id", "title", "url", "doc_length", document_shard(shards))
            .sortWithinPartitions("shard", "id")
            .write.partitionBy("shard")
            .parquet(f"{work}/docs")
        )
        table = _table_name(work, build)
        postings = staged.select("id", "doc_length", F.inline("terms")).select("term", "id", "tf", "doc_length")
        try:
            # Sorted by term alone, which tells most rows by its first bytes; a sort by bucket and term compares them whole.
            # A task reads few staged parts, each of one bucket: it has a writer for each of these and keeps the order.
            with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(buckets)):
                (
                    postings.sortWithinPartitions("term")
                    .write.format("parquet")
                    .bucketBy(buckets, "id")
                    .option("path", f"{work}/postings")
                    .saveAsTable(table)
                )
        finally:
            # The entry of the path written to; that of the index is made when it is loaded. The files stay.
            spark.sql(f"DROP TABLE IF EXISTS {table}")

        settings = {"idf_type": idf_type, "drop_empty": drop_empty, "buckets": buckets, "shards": shards, "build": build}
        row = spark.range(1).select(*(F.lit(totals[name]).alias(name) for name in ("n_docs", "total_tokens", "avgdl")))
        row.withColumns({name: F.lit(v) for name, v in settings.items()}).write.parquet(f"{work}/stats")
        stored_files(spark, work).write.parquet(f"{work}/files")
    return StoredIndex(spark, path)


def _term_facts(staged: DataFrame, buckets: int, avgdl: float) -> DataFrame:
    """For each term its ``df``, the bounds of its scores, and the buckets that hold it; one exchange of partial rows."""
    bucket = F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")
    rows = staged.select("doc_length", bucket, F.inline("terms"))
    return rows.groupBy("term").agg(
        F.count("*").alias("df"),
        F.max("tf").alias("max_tf"),
        scoring.peak(F.col("tf"), F.col("doc_length"), F.lit(avgdl)).alias("peak"),
        F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket") % 64)).alias("bucket_bits"),
    )


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes)`` of the data files below a path, listed by Spark without reading them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Listed names are encoded as in a URI; only the part below the path is kept, which has no such characters.
    name = F.regexp_extract("path", "((vocab|docs|postings|stats)/.*)$", 1)
    return found.select(name.alias("file"), F.col("length").alias("bytes")).where("file <> ''")


def damaged_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes, found)`` of the files in an index's list that are missing, or have another size."""
    listed = spark.read.schema(FILES_SCHEMA).parquet(f"{qualified(spark, path)}/files")
    there = stored_files(spark, path).withColumnRenamed("bytes", "found")
    return listed.join(there, "file", "left").where("found IS DISTINCT FROM bytes")


class StoredIndex(Index):
    """A saved index, read from its path."""

    def __init__(self, spark: SparkSession, path: str):
        path = qualified(spark, path)
        missing = [name for name in ("vocab", "docs", "postings", "stats", "files") if not path_exists(spark, f"{path}/{name}")]
        if missing:
            raise FileNotFoundError(f"{path} is not a complete index: no {', '.join(missing)}")
        stats = spark.read.schema(STATS_SCHEMA).parquet(f"{path}/stats")
        row = stats.first()
        if row is None:
            raise FileNotFoundError(f"{path} is not a complete index: stats has no row")
        self.path = path
        self.buckets = row["buckets"]
        self.shards = row["shards"]
        self._avgdl = row["avgdl"]
        super().__init__(
            docs=spark.read.schema(DOCS_SCHEMA).parquet(f"{path}/docs"),
            stats=stats.select("n_docs", "total_tokens", "avgdl"),
            vocab=spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
            postings=self._bucketed_postings(spark, row["build"]),
            idf_type=row["idf_type"],
            drop_empty=row["drop_empty"],
        )

    def _bucketed_postings(self, spark: SparkSession, build: str) -> DataFrame:
        # The catalog entry tells Spark that the files are bucketed. Its name belongs to this build of the index, so it is
        # never wrong and never has to go: many can load at once.
        table = _table_name(self.path, build)
        location = f"{self.path}/postings".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({POSTINGS_SCHEMA}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (term) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        return spark.table(table)

    @property
    def avgdl(self) -> Column:
        return F.lit(self._avgdl)

    def restricted(self, terms: list[str]) -> Index:
        """The same index for these terms: their rows of the vocabulary are read now, at most ``PUSHED_VALUES``.

        Files of postings in buckets that have none of the terms are not opened, if these are half of them or more.
        """
        if len(terms) > PUSHED_VALUES:
            return self
        known = self.vocab.where(equals_any("term", terms)).collect()
        narrow = copy.copy(self)
        narrow.vocab = self.spark.createDataFrame(known, VOCAB_SCHEMA)
        narrow.postings = self.postings.where(equals_any("term", [row["term"] for row in known]))
        buckets = buckets_of(known, self.buckets)
        if len(buckets) <= PRUNED_SHARE * self.buckets:
            narrow.postings = narrow.postings.where(in_buckets(buckets))
        return narrow

    def some_buckets(self, buckets: list[int]) -> Index:
        """The same index with the postings of some buckets only: all those of some documents."""
        part = copy.copy(self)
        part.postings = self.postings.where(in_buckets(buckets))
        return part

    def vocabulary(self) -> DataFrame:
        return self.vocab.select("term", "df", "idf", "word_id")

    def vectors(self, every: bool = False, counts: bool = False) -> DataFrame:
        """As for any index; postings of common words are gathered where they lie, and only those of rare ones exchanged."""
        rows = self.postings.select("term", "id", "tf")
        parts = lookup_parts(rows, self.vocabulary(), "term", weight="df", spread="id")
        weighted = [part.withColumn("tfidf", scoring.tfidf(F.col("tf"), F.col("idf"))) for part in parts]
        docs = self.docs.select("id", "title", "url", "doc_length").repartition(self.buckets, "id")
        return _with_vectors(docs, weighted, "id", every, counts)

    def tfidf_postings(self) -> DataFrame:
        return self._weighted(self.vocab.select("term", "df", "idf")).select("term", "id", "tf", "doc_length", "tfidf")

    def with_documents(self, ranked: DataFrame, at_most: int) -> DataFrame:
        """As for any index; for a short list only the shards and row groups of its documents are read."""
        if at_most > PUSHED_VALUES:
            return super().with_documents(ranked, at_most)
        # At most PUSHED_VALUES rows come back to the driver, to name their documents in the scan.
        located = ranked.withColumn("shard", document_shard(self.shards))
        rows = located.collect()
        listed = self.spark.createDataFrame(rows, located.schema).drop("shard")
        shards = sorted({row["shard"] for row in rows})
        docs = self.docs.where(F.col("shard").isin(shards)).where(equals_any("id", [row["id"] for row in rows]))
        return docs.select("id", "title", "url").join(F.broadcast(listed), "id")


def equals_any(column: str, values: list[str]) -> Column:
    """One equality per value: a scan pushes each of them down, where a long ``IN`` would become a range.

    A row that no row group or page was left out for is told by the ``IN``, one look into a set, before the equalities.
    """
    each = functools.reduce(operator.or_, [F.col(column) == value for value in values], F.lit(False))
    return F.col(column).isin(values) & each if values else each


def in_buckets(buckets: list[int]) -> Column:
    """Whether a row's file belongs to one of the buckets; files are told by their names and others not opened."""
    name = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\..*)?$", 1)
    return name.cast("int").isin(buckets) if buckets else F.lit(False)


def buckets_of(terms: list[Row], buckets: int) -> list[int]:
    """The buckets that may have postings of these rows of the vocabulary; all, if one does not say where it is."""
    if any(row["bucket_bits"] is None for row in terms):
        return list(range(buckets))
    held = [(row["first_bucket"], row["last_bucket"], row["bucket_bits"]) for row in terms]
    return [b for b in range(buckets) if any(first <= b <= last and bits >> b % 64 & 1 for first, last, bits in held)]


def broadcast_small(rows: DataFrame) -> DataFrame:
    """The rows, marked for broadcast if they are measured to be small."""
    return F.broadcast(rows) if rows.agg(byte_size(rows)).first()[0] <= BROADCAST_BYTES else rows


def bucket_limits(spark: SparkSession) -> tuple[int, int]:
    """The shuffle partitions, and the most buckets that the catalog allows."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return int(spark.conf.get("spark.sql.shuffle.partitions")), most


def default_buckets(text_bytes: int, partitions: int, most: int = 100_000) -> int:
    """Parts of a saved index: the shuffle partitions, but parts neither tiny nor huge, and at most ``most``."""
    wanted = max(math.ceil(text_bytes / MOST_PER_BUCKET), min(partitions, math.ceil(text_bytes / LEAST_PER_BUCKET)), 1)
    # Large numbers become multiples of the shards, so that each bucket lies in one shard.
    if wanted > DOCUMENT_SHARDS:
        wanted = math.ceil(wanted / DOCUMENT_SHARDS) * DOCUMENT_SHARDS
    return wanted if wanted <= most else most if most <= DOCUMENT_SHARDS else most // DOCUMENT_SHARDS * DOCUMENT_SHARDS


def largest_divisor(number: int, most: int) -> int:
    return next(d for d in range(min(number, most), 0, -1) if number % d == 0)


def document_shard(shards: int) -> Column:
    """The directory of a document, from the hash that also chooses its bucket."""
    return F.pmod(F.hash("id"), F.lit(shards)).alias("shard")


def build_index(
    corpus: DataFrame,
    idf_type: str = "log",
    avgdl: str = "floor",
    drop_empty: bool = False,
    validate: bool = True,
    dedupe: str | None = None,
) -> CorpusIndex:
    """An index over ``(id, title, url, text)``.

    Ids must be unique: ``validate`` looks for repeated ones with a job of its own and raises; ``dedupe="first"``
    keeps one document of each id instead.
    """
    if idf_type not in scoring.IDF_TYPES:
        raise ValueError(f"idf_type must be one of {scoring.IDF_TYPES}, not {idf_type!r}")
    if avgdl not in statistics.AVGDL_MODES:
        raise ValueError(f"avgdl must be one of {statistics.AVGDL_MODES}, not {avgdl!r}")
    if dedupe not in (None, "first"):
        raise ValueError(f"dedupe must be None or 'first', not {dedupe!r}")
    if dedupe == "first":
        corpus = first_of_each_id(corpus)
    if validate and dedupe is None:
        count_unique(corpus)
    return CorpusIndex(corpus, idf_type, avgdl, drop_empty)


def load_index(spark: SparkSession, path: str, verify: bool = False) -> StoredIndex:
    """The same as ``Index.load``."""
    index = StoredIndex(spark, path)
    if verify and (damaged := damaged_files(spark, path).limit(5).collect()):
        raise FileNotFoundError(f"{path} is not a complete index: {', '.join(row['file'] for row in damaged)}")
    return index


def _table_name(path: str, build: str) -> str:
    return f"termloom_{hashlib.sha256(f'{path} {build}'.encode()).hexdigest()[:24]}"
