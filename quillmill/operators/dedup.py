"""Catalog normalisation, keyed deduplication with a preference, and the split into disjoint outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X


def normalise(catalog: DataFrame, isbn_col: str = "isbn13") -> DataFrame:
    """Every string column squashed (nulls become empty), the ISBN down to digits and X."""
    strings = {c: X.squash(F.col(f"`{c}`")) for c, t in catalog.dtypes if t == "string" and c != isbn_col}
    return catalog.withColumns(strings | {isbn_col: I.isbn_clean(F.col(isbn_col))})


#: Rows from which a key's keeper is broadcast; of n rows at most n / HOT_ROWS keys have as many, some 60 bytes each.
HOT_ROWS = 1 << 20


def mark_duplicates(catalog: DataFrame, isbn_col: str = "isbn13", title_col: str = "title", order_col: str = "input_pos", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds elim_category and elim_reason: duplicates of the first twelve characters, then invalid check digits.

    The keeper of a key is valid rather than not, titled rather than not, then first in input order. Empty ISBNs share one
    key, as the semantics have it, which can hold most rows; a placeholder can too. Keepers of keys with hot_rows rows are
    broadcast to them, and their rows are dealt out evenly in the join with all other keepers.
    """
    isbn, title = F.col(isbn_col), F.col(title_col)
    rows = catalog.withColumns({"__valid": I.valid13(isbn), "__key": F.substring(isbn, 1, 12)})
    rank = F.struct((~F.col("__valid")).cast("int").alias("a"), (title == "").cast("int").alias("b"), F.col(order_col).alias("c"))
    # min_by combines before the shuffle, where a window would sort every row of a hot key in one task
    keeper = rows.groupBy("__key").agg(F.min_by(F.struct(isbn.alias("isbn"), F.col(order_col).alias("pos")), rank).alias("__keeper"), F.count("*").alias("__n"))
    hot = F.broadcast(keeper.where(F.col("__n") >= hot_rows).select("__key", F.col("__keeper").alias("__hot")))
    rows = rows.join(hot, "__key", "left")
    spread = F.concat(F.lit("hot "), F.pmod(F.xxhash64(order_col), F.lit(1 << 14)).cast("string"))  # no key: keys are digits and X
    rows = rows.withColumn("__key", F.when(F.col("__hot").isNull(), F.col("__key")).otherwise(spread)).join(keeper.where(F.col("__n") < hot_rows).drop("__n"), "__key", "left")
    rows = rows.withColumn("__keeper", F.coalesce("__hot", "__keeper"))
    kept = F.col("__keeper.isbn")
    extra = F.col(order_col) != F.col("__keeper.pos")
    why = F.when(kept == isbn, "Duplicate ISBN").otherwise(F.concat(F.lit("Duplicate of ISBN "), kept, F.lit(": same first 12 digits, this copy has a wrong check digit")))
    category = F.when(extra, "duplicate").when(~F.col("__valid"), "invalid_isbn")
    reason = F.when(extra, why).when(~F.col("__valid"), I.invalid_reason(isbn))
    return rows.withColumns({"elim_category": category, "elim_reason": reason}).drop("__key", "__valid", "__keeper", "__hot")


def publisher_fallback(publisher: Column, inferred: Column) -> tuple[Column, Column]:
    """Publisher, else the one inferred from the prefix without its book counts; and where it is from."""
    bare = F.regexp_replace(F.coalesce(inferred, F.lit("")), r"\s*\(\d+ of \d+ known books?\)$", "")
    has = F.coalesce(publisher, F.lit("")) != ""
    return F.when(has, publisher).otherwise(bare), F.when(has, "record").when(bare != "", "isbn_prefix").otherwise("")


#: Output column of the tidy table and its source column; three are computed.
TIDY = {
    "ISBN": "isbn13", "ISBN10": "isbn10", "Title": "title", "Subtitle": "subtitle", "Author": "authors", "Contributors": "contributors", "Genre": None, "Category": "broad_category",
    "Subjects": "subjects", "Publisher": None, "Publisher_Source": None, "Publish_Year": "publish_year", "Publish_Place": "publish_place", "Language": "language", "Pages": "pages",
    "Format": "format", "Series": "series", "Edition": "edition", "Translated_From": "translated_from", "Description": "description", "Dewey": "dewey", "LCC": "lcc",
    "OCLC": "oclc_numbers", "OpenLibrary_Work": "openlibrary_work", "Goodreads_ID": "goodreads_ids", "Wikidata": "wikidata", "Metadata_Source": "metadata_sources",
}


def tidy(catalog: DataFrame, *carry: str) -> DataFrame:
    """The 27 output columns, and any columns to carry along."""
    publisher, source = publisher_fallback(F.col("publisher"), F.col("publisher_inferred_from_prefix"))
    made = {"Genre": X.join_nonempty(F.col("genres"), F.col("fiction_or_type")), "Publisher": publisher, "Publisher_Source": source}
    return catalog.select(*((made[name] if name in made else F.col(old)).alias(name) for name, old in TIDY.items()), *carry)


def split_outputs(classified: DataFrame, bare: str = "no_metadata") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned, eliminated and bare rows: disjoint, together all rows. classified carries elim_category."""
    category = F.col("elim_category")
    return classified.where(category.isNull()), classified.where(category.isNotNull() & (category != bare)), classified.where(category == bare)


def drop_empty_columns(rows: DataFrame) -> DataFrame:
    """Without the columns that are empty in every row: one pass for all columns."""
    filled = rows.agg(*(F.max((F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`").cast("string") != "")).cast("int")).alias(c) for c in rows.columns)).first()
    return rows.select(*(f"`{c}`" for c in rows.columns if filled[c]))


def insert_columns(rows: DataFrame, at: int, columns: dict[str, Column]) -> DataFrame:
    """New columns before the column at the given place."""
    names = rows.columns
    return rows.select(*(f"`{c}`" for c in names[:at]), *(v.alias(k) for k, v in columns.items()), *(f"`{c}`" for c in names[at:]))


def lookup(rows: DataFrame, pairs: DataFrame, key: str, value: str, order: str | None = None, default: Column | None = None, name: str | None = None) -> DataFrame:
    """rows with the value that pairs (key, value) have for their key, under name: of several the last by order, or without an
    order the greatest; the default, or an empty text, where there is none. Rows without a key find nothing."""
    last = pairs.groupBy(F.col(key).alias("__key")).agg((F.max_by(value, order) if order else F.max(value)).alias("__value"), F.lit(True).alias("__there"))
    found = F.when(F.col("__there"), F.col("__value")).otherwise(F.lit("") if default is None else default)
    return rows.join(last, F.col(key) == F.col("__key"), "left").withColumn(name or value, found).drop("__key", "__value", "__there")
