"""A screening run as a whole: normalise, deduplicate, fill, screen what is left, resolve, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import textnorm as X
from quillmill.operators import dedup, enrich, rules
from quillmill.session import checkpointed


def untitled(rows: DataFrame, title_col: str = "title") -> DataFrame:
    """Rows that no stage has eliminated and that have no title: those worth a lookup."""
    return rows.where(F.col("elim_category").isNull() & (F.coalesce(F.col(title_col), F.lit("")) == ""))


def fill(rows: DataFrame, cache: DataFrame, isbn_col: str = "isbn13") -> DataFrame:
    """rows with the empty fields of untitled ones filled from the first source that knows their ISBN.

    cache: (isbn, source_rank, meta), meta with some of enrich.FIELDS and a source.
    """
    found = enrich.resolve(cache.join(untitled(rows).select(F.col(isbn_col).alias("isbn")).distinct(), "isbn", "left_semi"))
    meta = cache.schema["meta"].dataType.names
    joined = rows.join(found.select(F.col("isbn").alias("__isbn"), F.col("meta").alias("__meta")), F.col(isbn_col) == F.col("__isbn"), "left")
    here = F.col("__meta").isNotNull() & F.col("elim_category").isNull() & (F.coalesce(F.col("title"), F.lit("")) == "")
    own = lambda c: F.coalesce(F.col(c), F.lit(""))
    filled = {c: F.when(here & (own(c) == ""), X.squash(F.col(f"__meta.{c}"))).otherwise(F.col(c)) for c in enrich.FIELDS if c in rows.columns and c in meta}
    if "metadata_sources" in rows.columns and "source" in meta:
        filled["metadata_sources"] = F.when(here, X.join_nonempty(own("metadata_sources"), F.col("__meta.source"))).otherwise(F.col("metadata_sources"))
    return joined.withColumns(filled).drop("__isbn", "__meta")


def screen_catalog(catalog: DataFrame, rule_set: rules.RuleSet, cache: DataFrame | None = None, isbn_col: str = "isbn13", title_col: str = "title", order_col: str = "input_pos") -> DataFrame:
    """catalog with hits, elim_category (null: cleaned), confidence, elim_reason and matched_terms; every row once.

    A row has the verdict of the first stage that eliminates it: duplicates and wrong check digits are not screened.
    """
    rows = dedup.mark_duplicates(dedup.normalise(catalog, isbn_col), isbn_col, title_col, order_col)
    set_ = F.col("elim_category").isNotNull()
    rows = rows.withColumns({"confidence": F.when(set_, "n/a"), "matched_terms": F.when(set_, "")})
    if cache is not None:
        rows = fill(rows, cache, isbn_col)
    return rules.resolve(rules.screen(rows, rule_set), rule_set, title_col)


def classified_once(catalog: DataFrame, rule_set: rules.RuleSet, **options) -> DataFrame:
    """screen_catalog, settled in the session's checkpoint folder: the outputs and every report read what was classified."""
    return checkpointed(screen_catalog(catalog, rule_set, **options))


def outputs(classified: DataFrame, isbn_col: str = "isbn13") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned, eliminated and bare rows, sorted by ISBN, by (category, confidence, ISBN), and by ISBN.

    Three reads of classified: hand in a table, such as that of classified_once.
    """
    cleaned, eliminated, bare = dedup.split_outputs(classified)
    return cleaned.orderBy(isbn_col), eliminated.orderBy("elim_category", "confidence", isbn_col), bare.orderBy(isbn_col)
