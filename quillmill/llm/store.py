"""Where intermediate tables go: the shared folder that spark.checkpoint.dir names.

A table is deleted as soon as what reads it has been written, and the shuffle files of each write go when it ends, so
that a run holds the tables of one step and not of all. What is left after an operator is the table that its result reads;
it goes when the application ends. What a failed write has left goes at once.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary folder; a cluster without one is an error."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    have = spark.sparkContext.getCheckpointDir()
    if have:
        return have.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="quillmill-")
    spark.sparkContext.setCheckpointDir(own)
    return own


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when each action ends."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, *done: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: later passes see the same rows, and lineage is cut.

    done: tables written before that nothing reads after this one; they are deleted.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        with tidy(spark):
            df.write.option("compression", "zstd").parquet(path)
    except BaseException:
        delete_path(spark, path)
        raise
    delete_at_end(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    delete(*done)
    return out


def renamed(table: DataFrame, *names: str) -> DataFrame:
    """A written table under other column names; it takes the table's place."""
    out = table.toDF(*names)
    _paths[out] = _paths.pop(table)
    return out


def delete(*tables: DataFrame) -> None:
    """Delete tables that written() returned."""
    for table in tables:
        path = _paths.pop(table, None)
        if path:
            delete_path(table.sparkSession, path)


def _located(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """A file or folder of any file system that Spark knows; nothing happens if it is not there."""
    root, files = _located(spark, path)
    files.delete(root, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """What is still there when the application ends goes then."""
    root, files = _located(spark, path)
    files.deleteOnExit(root)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    root, files = _located(spark, path)
    return [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []


def make_folder(spark: SparkSession, path: str) -> None:
    root, files = _located(spark, path)
    files.mkdirs(root)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
