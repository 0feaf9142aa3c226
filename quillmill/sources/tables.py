"""Readers and writers: catalogs as CSV, caches as JSON lines, ledgers and corpora as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_catalog(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All-string CSV with a header, plain or gzipped: a BOM goes, "NA" stays text, empty cells are empty strings.

    With columns given, the scan parses those only. The header is read once for the names; a gzipped file is one split.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "enforceSchema": False}
    names = [c.removeprefix("﻿") for c in spark.read.options(**options).csv(path).columns]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.options(**(options | {"enforceSchema": True})).schema(schema).csv(path)
    return (rows.select(*(f"`{c}`" for c in columns)) if columns else rows).na.fill("")


def write_catalog(rows: DataFrame, path: str, compressed: bool = False, mode: str = "error", bom: bool = False) -> None:
    """CSV with a header and minimal quoting; a folder of part files, each with a byte order mark if asked for."""
    if bom:
        rows = rows.toDF(*("\ufeff" * (i == 0) + c for i, c in enumerate(rows.columns)))
    writer = rows.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
    (writer.option("compression", "gzip") if compressed else writer).csv(path)


def append_catalog(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Append with the given columns only; each part file has its own header, so readers agree on it."""
    write_catalog(rows.select(*(f"`{c}`" for c in columns)), path, mode="append")


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, of any file system that Spark knows; none if it is not there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def read_cache(spark: SparkSession, path: str, meta: str) -> DataFrame:
    """JSON lines {"isbn", "meta"}: the last line of a key wins; a null meta is a known miss.

    Lines are ordered by the number of the append that wrote them, then by file name and place within the file. Files
    that lie in the folder itself come before all appends.
    """
    schema = f"isbn string, meta struct<{meta}>, batch long"
    lines = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/[^/]*$", 1).try_cast("long")
    placed = lines.select("isbn", "meta", F.coalesce(number, F.lit(-1)).alias("__batch"), F.col("_metadata.file_name").alias("__name"), F.monotonically_increasing_id().alias("__start"))
    return placed.groupBy("isbn").agg(F.max_by(F.struct("meta"), F.struct("__batch", "__name", "__start")).alias("m")).select("isbn", F.col("m.meta").alias("meta"))


def append_cache(rows: DataFrame, path: str) -> None:
    """One numbered folder for each append; of two at once, one fails instead of mixing with the other."""
    numbers = [int(n.removeprefix("batch=")) for n in _versions(rows.sparkSession, path) if n.startswith("batch=")]
    rows.select("isbn", "meta").write.mode("error").option("ignoreNullFields", False).json(f"{path.rstrip('/')}/batch={max(numbers, default=-1) + 1:08d}")


def write_snapshot(rows: DataFrame, folder: str) -> str:
    """Atomic replacement: a new version beside the old ones; readers go by its _SUCCESS mark. Returns its path."""
    spark = rows.sparkSession
    version = spark.sql("select unix_millis(current_timestamp()) as t").first().t
    path = f"{folder.rstrip('/')}/v{version:015d}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(path)
    return path


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete version in a folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    done = sorted(str(s.getPath()) for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    if not done:
        raise FileNotFoundError(f"no complete version in {folder}")
    return spark.read.parquet(done[-1])


def write_records(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """Records with their path as a column, in a folder for each hash bucket of it, instead of a file for each text."""
    rows.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(buckets))).write.partitionBy("bucket").parquet(path)
