"""The corpus pipeline: from raw documents to packed bins, in stages that are each written and read again.

Each stage sees all that the one before it kept, and a stage's table is deleted once the next is written.

Edge cases: a document with a null or empty text is no one's copy, leak or toxic text; it passes all stages and ends as one
piece of 0 words without a bin. Rows that repeat an id are further documents (see jaccard_join.drop_near_duplicates for
those that repeat their text too). Further columns, whatever their names, are carried to the last stage. An empty table
gives an empty table of bins; without labels of both classes nothing is toxic, without benchmark items nothing leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, jaccard_join, packing, pii, toxicity
from quillmill.llm.store import read_table, written

PII_KEY = "quillmill-demonstration-key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects (score of 0.7 or more) go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of Jaccard similarity 0.75 or more join, the document with the least id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 75 in 100 or more of a benchmark item's shingles go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms; n_chars follows the text."""
    out = pii.pseudonymise(docs, PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words without two documents of one source or duplicate cluster."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: SQL cannot train the first stage's classifier; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
