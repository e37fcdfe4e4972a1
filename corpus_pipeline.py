"""From raw documents to token ids: language, near-duplicates, secrets, mixture, pieces.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over the columns of ``documents`` and works on all that the one before
has kept. :func:`run` writes each result as Parquet into the shared scratch folder and reads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import language, mixing, piece_codec, secret_scan, simhash
from termloom.llm.registered import MODEL_PATH
from termloom.llm.tables import staged, table, unused

# A document stays if one language has this share of its letters: those with passages in two other languages do.
LEAST_SHARE = 0.4

# Near-duplicates: fingerprints of three-word shingles that differ in at most two bits.
NEAR = {"words": 3, "budget": 2}


# Distinct words that a worker remembers while it encodes: it has other stages behind it, whose memory it keeps.
REMEMBERED = 150_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which becomes their ``lang``; those without letters or without a main language go."""
    name = unused(docs, "language")
    found = language.identify(docs, language.learn(docs), name=name)
    of = F.col(name)
    kept = found.where((of["lang"] != "und") & (of["score"] >= LEAST_SHARE))
    return kept.withColumn("lang", of["lang"]).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs, **NEAR)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    cleaned = secret_scan.redact(docs, name=unused(docs, "secrets"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mixture takes it."""
    name = unused(docs, "mix")
    taken = mixing.taken_rows(mixing.mix(docs, ordered=False, name=name), name=name)
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text."""
    rows = docs.select("doc_id", "lang", "source", "text")
    encoded = piece_codec.encode(rows, piece_codec.read_model(MODEL_PATH), remembered=REMEMBERED)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

# Neither learning a language model nor fingerprints nor a piece vocabulary can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
