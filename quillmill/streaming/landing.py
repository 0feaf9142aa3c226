"""Incremental cleaning: files that land in a folder go through the same clean chain, once each.

Spark's checkpoint keeps what was read; a batch that is run again overwrites its own version, so a restart repeats
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators import lines


def clean_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Parquet files of (doc_id, text) in landing, cleaned into out/batch=N."""

    def write(batch: DataFrame, number: int) -> None:
        lines.clean(batch.select("doc_id", "text")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    rows = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
