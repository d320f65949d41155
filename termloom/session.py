"""The shared folder for data a job writes for itself."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="termloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/termloom/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, for any store Spark can reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any file system Spark can reach."""
    system, found = hadoop_path(spark, path)
    return system.exists(found)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, the same from wherever it is used."""
    system, found = hadoop_path(spark, path)
    return system.makeQualified(found).toString()


@dataclass(frozen=True)
class Listed:
    """A name in a folder and when it was last changed, in milliseconds."""

    name: str
    modified: int


def list_folder(spark: SparkSession, path: str) -> list[Listed]:
    """What lies in a folder; nothing where there is none."""
    system, folder = hadoop_path(spark, path)
    if not system.exists(folder):
        return []
    found = system.listStatus(folder)
    return [Listed(f.getPath().getName(), f.getModificationTime()) for f in found]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it; it may be gone already."""
    system, found = hadoop_path(spark, path)
    system.delete(found, True)


def move_to_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file its final name unless that is taken; whether it was free.

    One step on file systems whose rename is one, such as HDFS.
    """
    from py4j.protocol import Py4JJavaError

    _, old = hadoop_path(spark, source)
    _, new = hadoop_path(spark, target)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        old.toUri(), spark._jsc.hadoopConfiguration()
    )
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        files.rename(old, new, spark.sparkContext._gateway.new_array(kind, 0))
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


#: Rows of one Arrow batch on its way to a Python worker: the JVM and the worker each hold a
#: batch whole, beside the heap, and whole texts are long.
ARROW_ROWS = 1024
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``ARROW_ROWS`` rows for the jobs inside; the rows are the same."""
    had = spark.conf.get(_ARROW_KEY, None)
    if had is not None and 0 < int(had) <= ARROW_ROWS:
        yield
        return
    spark.conf.set(_ARROW_KEY, str(ARROW_ROWS))
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(_ARROW_KEY)
        else:
            spark.conf.set(_ARROW_KEY, had)


@contextmanager
def _held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session inside; what it was is put back."""
    had = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, had)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query inside go when it ends, not when the driver collects garbage.

    For tables that are staged inside; a DataFrame made inside should not be run twice.
    """
    with _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


#: Tables staged and not yet deleted, by the scope they were staged in.
_scopes: list[list[str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends at a table that outlives executors."""
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The same, and the path of the table, for who deletes it before the end."""
    path = new_path(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: Row groups of a table in parts, of which a task writes all at once.
PART_GROUP_BYTES = 16 << 20


def stage_parts(df: DataFrame, label: str, part: Column, parts: int) -> list[tuple[DataFrame, str]]:
    """``stage_at`` of the rows whose ``part``, an integer, is 0, 1 and so on, each a table of its own.

    Rows are not sorted for that: a task has a file of each part open.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    with small_batches(spark), _held(spark, "spark.sql.maxConcurrentOutputFileWriters", str(parts + 1)):
        dealt = df.withColumn("_part", part).write.partitionBy("_part")
        dealt.option("parquet.block.size", PART_GROUP_BYTES).parquet(path)
    folders = [f"{path}/_part={i}" for i in range(parts)]
    return [
        (spark.read.schema(df.schema).parquet(f) if path_exists(spark, f) else df.limit(0), f) for f in folders
    ]


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside at the end; what is read from them is written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


def stage_outside(df: DataFrame, label: str) -> DataFrame:
    """``stage`` for what outlives the innermost ``staging``."""
    scope = _scopes.pop()
    try:
        return stage(df, label)
    finally:
        _scopes.append(scope)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input too small to be split over them.

    Only a plain scan should be passed in.  A scan with fewer splits than cores
    holds at most one split size per core, so the shuffle is bounded; anything
    larger is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
