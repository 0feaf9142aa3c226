"""The index of a paged search, kept up as pages come in: every page once, also across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators import enrich
from quillmill.sources.pages import PagedSearch


def collect_pages(spark: SparkSession, pages: str, out: str, checkpoint: str) -> StreamingQuery:
    """Items of the pages that are there and were not read before, into out; a batch that is run again counts once."""
    spark.dataSource.register(PagedSearch)
    rows = spark.readStream.format("paged_search").load(pages)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collected_index(spark: SparkSession, out: str) -> DataFrame:
    """(isbn, ids) of all items collected so far."""
    return enrich.bulk_index(spark.read.parquet(out))
