"""Audits of texts: metadata by layered fallback, the language gate, the length gate, one copy, and the ledger's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X
from quillmill.operators import langid, lid, lines, records
from quillmill.session import checkpointed

MIN_CHARS = 500


def long_enough(text: Column, least: int = MIN_CHARS) -> Column:
    """At least so many characters between white space at the ends."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+\z", "")) >= least


def with_metadata(files: DataFrame, catalog: DataFrame, order_col: str | None = None) -> DataFrame:
    """files (path, raw) with isbn, title, author, source, license, body, wrapped and known.

    The catalog's row (ISBN, Title, Author) goes first, as it is; then the text's own header; then the file's name, and
    its folder's for the author. Of several catalog rows with one ISBN the last by order_col counts; without one, that with
    the greatest title and author.
    """
    r, meta = F.col("__r"), lambda name: F.try_element_at(F.col("__r.meta"), F.lit(name))
    parsed = files.withColumn("__r", records.split_record(F.coalesce("raw", F.lit(""))))
    parts = F.split(F.col("path"), "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    folder = F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise("")
    parsed = parsed.select(
        "path", F.coalesce(I.to13(F.coalesce(meta("isbn"), F.lit(""))), F.lit("")).alias("isbn"), F.coalesce(meta("title"), stem).alias("__title"), F.coalesce(meta("author"), folder).alias("__author"),
        meta("source").alias("source"), meta("license").alias("license"), r.body.alias("body"), records.is_wrapped(F.coalesce("raw", F.lit(""))).alias("wrapped"),
    )
    entry = F.struct("Title", "Author")
    own = catalog.groupBy(F.col("ISBN").alias("isbn")).agg((F.max_by(entry, F.struct(F.col(order_col), entry)) if order_col else F.max(entry)).alias("__c"))
    rows = parsed.join(own, "isbn", "left").withColumn("known", F.col("__c").isNotNull())
    pick = lambda c, other: F.when(F.col("known"), F.coalesce(F.col(f"__c.{c}"), F.lit(""))).otherwise(F.col(other))
    return rows.withColumns({"title": pick("Title", "__title"), "author": pick("Author", "__author")}).drop("__c", "__title", "__author")


def language_shares(texts: DataFrame, model: langid.Model, id_col: str = "path", text_col: str = "raw") -> DataFrame:
    """(doc_id, lang, share) of texts, headers left out: markup first, then characters, then a vote of the model's labels."""
    body = records.split_record(F.coalesce(F.col(text_col), F.lit("")))["body"]
    docs = checkpointed(texts.select(F.col(id_col).alias("doc_id"), body.alias("body")))  # Spark can't bind headers and markup in one expression
    docs = docs.select("doc_id", X.fix_chars(X.strip_markup(F.col("body"))).alias("text"))
    return lid.vote(langid.label(lid.chunks(docs), model))


def audit_files(files: DataFrame, catalog: DataFrame, ledger: DataFrame, shares: DataFrame, target: str, threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records kept (path, isbn, record), rows culled (path, isbn, title, author, reason, detected) and ledger rows.

    files: (path, raw); shares: (doc_id, lang, share) of each file's text by its path. Files that are wrapped and whose
    ISBN is completed in the ledger were cleaned before and are left out. Nothing is deleted: a culled file is a row.
    """
    done = ledger.where("status = 'completed'").select(F.col("key").alias("isbn"), F.lit(True).alias("__done")).distinct()
    rows = with_metadata(files, catalog).join(done, "isbn", "left").where(~(F.col("wrapped") & F.coalesce("__done", F.lit(False)))).drop("__done")  # cleaning them twice would eat paragraphs
    verdict = lid.audit(rows.select(F.col("path").alias("doc_id")), shares, target, threshold).withColumnRenamed("doc_id", "path")
    rows = checkpointed(rows.join(verdict, "path"))  # the verdicts are read by all three results
    culled = rows.where("decision = 'cull'").select("path", "isbn", "title", "author", F.lit("Existing file in another language").alias("reason"), F.col("summary").alias("detected"))
    kept = rows.where("decision = 'keep'")
    bodies = lines.clean(kept.select(F.col("path").alias("doc_id"), F.col("body").alias("text"))).withColumnRenamed("doc_id", "path")
    extra = {"source": F.col("source"), "license": F.col("license")}
    wrapped = kept.drop("body").join(bodies, "path").select("path", "isbn", records.wrap_record(F.col("body"), F.col("title"), F.col("author"), F.col("isbn"), target, extra).alias("record"))
    note = lambda rows, status, detail: rows.where("isbn <> ''").select(F.col("isbn").alias("key"), F.lit(status).alias("status"), detail.alias("detail"), "path")
    entries = note(culled, "culled", F.concat("reason", F.lit(" ("), "detected", F.lit(")"))).unionByName(note(kept, "completed", F.concat(F.lit("existing file ("), "summary", F.lit(")"))))
    return wrapped, culled, entries


def save_downloads(found: DataFrame, shares: DataFrame, target: str, threshold: float = 0.5, earlier: DataFrame | None = None) -> DataFrame:
    """found (key, path, source, raw) with status and detail: the language gate, then the length of the cleaned text, then
    one copy for a path, then completed. body is the cleaned text of what is to be written, else null.

    A path belongs to the key of the file that is there (earlier: path, isbn, as of text_tree.saved), or else to the least
    key; others are completed with one copy kept. With title and author in found, record is the text to write, with source
    and, if there is one, license.
    """
    rows = found.join(lid.audit(found.select(F.col("key").alias("doc_id")), shares, target, threshold).withColumnRenamed("doc_id", "key"), "key")
    bodies = lines.clean(rows.where("decision = 'keep'").select(F.col("key").alias("doc_id"), F.col("raw").alias("text"))).withColumnRenamed("doc_id", "key")
    rows = rows.drop("raw").join(bodies, "key", "left").withColumn("usable", F.coalesce(F.length("body") >= MIN_CHARS, F.lit(False)))
    owner = rows.where("usable").groupBy("path").agg(F.min("key").cast("string").alias("__owner"))
    if earlier is not None:
        there = earlier.where("isbn <> ''").groupBy("path").agg(F.min("isbn").alias("__there"))
        owner = owner.join(there, "path", "left").select("path", F.coalesce("__there", "__owner").alias("__owner"))
    rows = rows.join(owner, "path", "left")
    copy = F.col("__owner") != F.col("key").cast("string")
    status = F.when(F.col("decision") == "cull", "culled").when(~F.col("usable"), "no usable text").otherwise("completed")
    why = F.concat(F.lit(" ("), F.col("summary"), F.lit(")"))
    detail = (
        F.when(F.col("decision") == "cull", F.concat(F.lit("Downloaded text in another language"), why)).when(~F.col("usable"), F.concat(F.col("source"), F.lit(": no usable text")))
        .when(copy, F.concat(F.lit("same title and author as ISBN "), F.col("__owner"), F.lit("; one copy kept"))).otherwise(F.concat(F.lit("downloaded"), why))
    )
    write = (status == "completed") & ~copy
    made = [status.alias("status"), detail.alias("detail"), F.when(write, F.col("body")).alias("body")]
    if {"title", "author"} <= set(found.columns):
        extra = {c: F.col(c) for c in ("source", "license") if c in found.columns}
        made.append(F.when(write, records.wrap_record(F.col("body"), F.col("title"), F.col("author"), F.col("key").cast("string"), target, extra)).alias("record"))
    return rows.select("key", "path", *made)
