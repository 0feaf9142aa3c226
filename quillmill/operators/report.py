"""Summaries of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_category(classified: DataFrame) -> DataFrame:
    """Rows of each category and confidence, most first."""
    return classified.where("elim_category is not null").groupBy("elim_category", "confidence").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "elim_category", "confidence")


def counts(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of each combination of values."""
    return rows.groupBy(*columns).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *columns)
