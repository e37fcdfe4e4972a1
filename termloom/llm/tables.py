"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import termloom
from termloom.session import scratch_path

# White space between words: space and the five control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of one Arrow batch that is handed to Python, so that very long texts come a few at a time. The JVM holds a batch as
# vectors and as a message, and Python as a message, as objects and as results, for each running task.
BATCH_BYTES = 4 * 1024 * 1024


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder: computed once, and it outlives executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def map_batches(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes as well as in rows."""
    limit_batches(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def limit_batches(spark: SparkSession) -> None:
    """Bounds what is handed to Python, and lets Python workers find this package where the driver has found it."""
    environment = spark.sparkContext.environment
    home = str(Path(termloom.__file__).resolve().parent.parent)
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, known)])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def word_count(text: str = "text"):
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def unused(frame: DataFrame, name: str) -> str:
    """The name, with as many underscores as it takes to be no column of the frame."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
