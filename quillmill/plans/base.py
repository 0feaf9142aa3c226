"""Registration of queries with their SQL, and the inputs that several of them derive from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows of a scan in as many partitions as there are cores: for work that costs far more than a shuffle of its input, over
    tables that lie in fewer pieces than that. Larger tables are left as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with DuckDB SQL for the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


CHECK_SQL = (
    "CAST((10 - list_sum(list_transform(range(1, 13), lambda i: CAST(substr({x}, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10 AS INT)"
)

#: Catalog rows from part: valid and wrong ISBNs, duplicates, empty titles, in a known input order.
CATALOG_SQL = f"""
base AS (SELECT p_partkey, p_name, p_brand, p_size, p_type, '978' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS first12 FROM part),
digit AS (SELECT *, {CHECK_SQL.format(x="first12")} AS d FROM base),
catalog AS (
  SELECT p_partkey * 4 AS input_pos, first12 || CAST(CASE WHEN p_partkey % 17 = 0 THEN (d + 3) % 10 ELSE d END AS VARCHAR) AS isbn13, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS title, p_partkey FROM digit
  UNION ALL SELECT p_partkey * 4 + 1, first12 || CAST((d + 1) % 10 AS VARCHAR), p_name, p_partkey FROM digit WHERE p_partkey % 7 = 0
  UNION ALL SELECT p_partkey * 4 + 2, first12 || CAST(d AS VARCHAR), p_name, p_partkey FROM digit WHERE p_partkey % 11 = 0)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of CATALOG_SQL."""
    from quillmill.functions.ids import check_digit13

    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat(F.lit("978"), F.lpad(key.cast("string"), 9, "0")).alias("first12"))
    part = part.withColumn("d", check_digit13(F.col("first12")).cast("int"))
    code = lambda d: F.concat("first12", d.cast("string"))
    kinds = F.array(
        F.struct((key * 4).alias("input_pos"), code(F.when(key % 17 == 0, (F.col("d") + 3) % 10).otherwise(F.col("d"))).alias("isbn13"), F.when(key % 13 == 0, "").otherwise(F.col("p_name")).alias("title")),
        F.when(key % 7 == 0, F.struct((key * 4 + 1).alias("input_pos"), code((F.col("d") + 1) % 10).alias("isbn13"), F.col("p_name").alias("title"))),
        F.when(key % 11 == 0, F.struct((key * 4 + 2).alias("input_pos"), code(F.col("d")).alias("isbn13"), F.col("p_name").alias("title"))),
    )
    return part.select("p_partkey", F.inline(F.array_compact(kinds)))
