"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local session without one uses its warehouse."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(f"{warehouse.rstrip('/')}/termloom-scratch")
        current = context.getCheckpointDir()
    return current


def durable(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the checkpoint folder, where it outlives the executors."""
    scratch_root(frame.sparkSession)
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, computed once and kept as a Parquet table in the checkpoint folder.

    For large frames of which a use reads some columns only: a checkpoint is a row at a time and not compressed.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the checkpoint folder that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/termloom/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def written(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame as a Parquet table in the checkpoint folder, dropped when the block ends."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    try:
        frame.write.parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        deleted(spark, path)


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextlib.contextmanager
def published(spark: SparkSession, path: str) -> Iterator[str]:
    """A path beside ``path`` to write to, which becomes ``path`` by one rename when the block ends.

    ``path`` must not exist, before and after; of two writers one succeeds. What a block that fails has written is
    deleted, so that the path stays free.
    """
    path = qualified(spark, path)
    refuse_existing(spark, path)
    work = f"{path}.writing-{uuid.uuid4().hex}"
    files, source = _file_system(spark, work)
    try:
        yield work
        _rename(spark, files, source, path)
    finally:
        files.delete(source, True)  # nothing is there after the rename


def _rename(spark: SparkSession, files, source, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(how, 1)
    none[0] = how.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
    try:
        context.rename(source, target, none)  # unlike the file system's own, it never moves into a folder that is there
    except Py4JJavaError:
        if files.exists(target):
            raise FileExistsError(f"{path} already exists") from None
        raise


def moved(spark: SparkSession, path: str, to: str) -> None:
    """Renames a path to one that must not exist."""
    files, source = _file_system(spark, qualified(spark, path))
    _rename(spark, files, source, qualified(spark, to))


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a path with all below it."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def refuse_existing(spark: SparkSession, path: str) -> None:
    """Raises ``FileExistsError`` if something is at the path; for what is worked out before it is written there."""
    if path_exists(spark, path):
        raise FileExistsError(f"{qualified(spark, path)} already exists")


def qualified(spark: SparkSession, path: str) -> str:
    """The full form of a path, which means the same to a reader and to the catalog."""
    files, target = _file_system(spark, path)
    return files.makeQualified(target).toString()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target
