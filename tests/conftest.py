import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CORPUS = "id string, title string, url string, text string"


@pytest.fixture(scope="session")
def make_corpus(spark):
    """A corpus from texts (ids "1", "2", ...) or from (id, text) pairs."""

    def make(*texts):
        pairs = [t if isinstance(t, tuple) else (str(i), t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame([(i, f"title {i}", f"u/{i}", t) for i, t in pairs], CORPUS)

    return make


@pytest.fixture(scope="session")
def micro(spark):
    """Three documents whose numbers are worked out by hand in FIXTURES.md."""
    rows = [
        ("1", "A", "u/1", "Cat dog cat."),
        ("2", "B", "u/2", "Dog, bird!"),
        ("3", "C", "u/3", "Fish fish fish bird"),
    ]
    return spark.createDataFrame(rows, CORPUS)


@pytest.fixture(scope="session")
def tables_corpus(spark):
    import __spark_entry__

    return __spark_entry__._corpus(spark, SMALL_TABLES)
