"""Corpora: frames of ``(id, title, url, text)``, all strings, all required, one row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.skew import BROADCAST_BYTES, byte_size
from termloom.session import durable

FIELDS = ("id", "title", "url", "text")

SCHEMA = T.StructType([T.StructField(name, T.StringType(), False) for name in FIELDS])


def read_corpus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines, one document per line, from a directory, a glob or a list of paths.

    A line that is not JSON, and a document without one of the fields, fail the job that reads them.
    """
    return as_corpus(spread(spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path)))


def spread(scan: DataFrame) -> DataFrame:
    """A freshly read frame, over all cores if its files give fewer splits than there are cores.

    Analysing a text costs far more than moving it. An input with splits enough, which any large one made of
    splittable files has, is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def as_corpus(
    frame: DataFrame,
    id: str | Column = "id",
    title: str | Column = "title",
    url: str | Column = "url",
    text: str | Column = "text",
) -> DataFrame:
    """Any frame as a corpus: the four columns, cast to string, with a null raising when it is read.

    The check belongs to its column, so a query that does not use ``url`` neither reads nor checks it.
    """

    def required(column: str | Column, name: str) -> Column:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        missing = F.raise_error(F.lit(f"corpus: a document has no {name}")).cast("string")
        return F.coalesce(value, missing).alias(name)

    return frame.select(*(required(c, n) for c, n in zip((id, title, url, text), FIELDS)))


def repeated_ids(corpus: DataFrame) -> DataFrame:
    """Ids that more than one document has, with their counts."""
    return corpus.groupBy("id").agg(F.count("*").alias("copies")).where("copies > 1")


def count_unique(corpus: DataFrame) -> int:
    """The number of documents; raises if two have the same id."""
    copies = corpus.groupBy("id").agg(F.count("*").alias("copies"))
    row = copies.agg(F.sum("copies").alias("documents"), F.max(F.struct("copies", "id")).alias("most")).first()
    if row["documents"] is None:
        return 0
    if row["most"]["copies"] > 1:
        raise ValueError(f"document id {row['most']['id']!r} occurs {row['most']['copies']} times")
    return row["documents"]


def first_of_each_id(corpus: DataFrame) -> DataFrame:
    """One document per id: the smallest by title, url, text, so the choice does not hang on file order.

    Only ids are counted for all documents. Those of one document pass through; the minimum, which combines on the
    map side, is taken for the repeated ones. Their ids are kept in the checkpoint folder: Spark broadcasts them if
    they are few, or joins by exchange and splits ids with very many copies.
    """
    again = durable(repeated_ids(corpus).select("id"))
    if again.isEmpty():
        return corpus
    few = again.agg(byte_size(again)).first()[0] <= BROADCAST_BYTES
    again = F.broadcast(again) if few else again
    of_many = corpus.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("title", "url", "text")).alias("kept"))
    return corpus.join(again, "id", "left_anti").unionByName(of_many.select("id", "kept.*"))


def text_bytes(corpus: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
