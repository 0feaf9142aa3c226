"""Files of any store that Spark knows, from the driver: folders, small marks that appear whole, and what goes at the end."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The path and its file system, as the JVM knows them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    root, files = located(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(root)) if files.exists(root) else []


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder; nothing happens if it is not there."""
    root, files = located(spark, path)
    files.delete(root, True)


def delete_at_end(spark: SparkSession, folder: str) -> str:
    """Make a folder that goes when the application ends; returns it."""
    root, files = located(spark, folder)
    files.mkdirs(root)
    files.deleteOnExit(root)
    return folder


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; an error if another writer was first."""
    root, files = located(spark, path)
    aside = root.suffix(f".{uuid.uuid4().hex}.tmp")
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(root) or not files.rename(aside, root):
        files.delete(aside, False)
        raise FileExistsError(f"{path} was written by another run")


def get(spark: SparkSession, path: str) -> str:
    root, files = located(spark, path)
    source = files.open(root)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
