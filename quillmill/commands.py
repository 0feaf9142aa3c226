"""Whole runs over files, as functions and as commands: python -m quillmill screen | match | wanted ... --help.

Each reads its inputs, settles what it works out once, writes its outputs and returns the summary's tables.
"""

from __future__ import annotations

import argparse
import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.operators import dedup, enrich, ledger, membership, report, rules, screening
from quillmill.session import checkpointed
from quillmill.sources import tables
from quillmill.sources.bencode import BitmapSource
from quillmill.sources.ledger_store import LedgerStore

# Names of the outputs, the columns that an audit adds, and what a lookup's cache holds.
CLEANED, ELIMINATED, BARE = "cleaned_books", "eliminated_books", "no_isbns"
AUDIT = {"Elimination_Category": "elim_category", "Confidence": "confidence", "Elimination_Reason": "elim_reason", "Matched_Terms": "matched_terms"}
META = "title string, subtitle string, authors string, subjects string, publisher string, language string, genres string, description string, source string"
#: What a screening reads; columns that a catalog lacks count as empty.
COLUMNS = sorted({c for c in dedup.TIDY.values() if c} | {"genres", "fiction_or_type", "publisher", "publisher_inferred_from_prefix", "subject_places_people_times"})


def load_rules(path: str) -> rules.RuleSet:
    """A RuleSet of a JSON file with its fields; unknown fields, categories and confidences and bad patterns are errors."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    unknown = set(given) - set(rules.RuleSet.__dataclass_fields__)
    if unknown or "categories" not in given:
        raise ValueError(f"{path}: unknown or missing fields: {sorted(unknown) or ['categories']}")
    out = rules.RuleSet(**(given | {"author_high": set(given.get("author_high", ())), "exempt_categories": tuple(given.get("exempt_categories", ()))}))
    for rule in [*out.text, *out.subject, *out.author, *out.ranges, *out.prefixes]:
        if rule["category"] not in out.categories or rule.get("confidence", "review") not in ("high", "review"):
            raise ValueError(f"{path}: rule {rule.get('label')!r} has an unknown category or confidence")
        for pattern in (rule.get("pattern"), rule.get("exempt"), rule.get("require")):
            re.compile(pattern or "")
    return out


def screen(spark: SparkSession, source: str, outdir: str, rule_set: rules.RuleSet, caches: Sequence[str] = (), names: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """A catalog to three CSV folders (cleaned, eliminated, bare); summary tables of outputs, categories, rules and lookups.

    caches: folders of JSON lines in the order in which they are asked for untitled rows. names: categories as they are
    written. The catalog is classified once, with its input order, and every output reads that.
    """
    catalog = tables.read_catalog(spark, source)
    catalog = catalog.withColumns({c: F.lit("") for c in COLUMNS if c not in catalog.columns}).withColumn("input_pos", F.monotonically_increasing_id())
    cache = None
    for rank, folder in enumerate(caches):
        one = tables.read_cache(spark, folder, META).select("isbn", F.lit(rank).alias("source_rank"), "meta")
        cache = one if cache is None else cache.unionByName(one)
    rows = screening.classified_once(catalog, rule_set, cache=cache)
    shown = F.col("elim_category")
    for category, name in (names or {}).items():
        shown = F.when(F.col("elim_category") == category, name).otherwise(shown)
    cleaned, eliminated, bare = (dedup.tidy(x, *AUDIT.values()) for x in dedup.split_outputs(rows))
    plain = lambda x: x.drop(*AUDIT.values()).orderBy("ISBN")
    held = {v: f"__{v}" for v in AUDIT.values()}  # names are told apart without their case
    culled = eliminated.withColumn("elim_category", shown).withColumnsRenamed(held)
    culled = dedup.insert_columns(culled, 1, {k: F.col(held[v]) for k, v in AUDIT.items()}).drop(*held.values())
    tables.write_catalog(plain(cleaned), f"{outdir}/{CLEANED}", bom=True)
    tables.write_catalog(culled.orderBy("Elimination_Category", "Confidence", "ISBN"), f"{outdir}/{ELIMINATED}", bom=True)
    tables.write_catalog(dedup.drop_empty_columns(plain(bare)), f"{outdir}/{BARE}", bom=True)
    output = F.when(F.col("elim_category").isNull(), CLEANED).when(F.col("elim_category") == "no_metadata", BARE).otherwise(ELIMINATED)
    out = {"outputs": report.counts(rows.withColumn("output", output), "output"), "categories": report.by_category(rows), "rules": rules.histogram(rows)}
    if cache is not None:
        asked = screening.untitled(dedup.mark_duplicates(dedup.normalise(catalog))).select(F.col("isbn13").alias("isbn")).distinct()
        out["lookups"] = enrich.source_stats(cache.join(asked, "isbn", "left_semi"))
    return out


def match(spark: SparkSession, books: str, bitmaps: str, out: str, specific: str = "md5") -> dict[str, DataFrame]:
    """Which catalogs' bitmaps hold each book of a CSV (isbn13, title, authors), as a gzipped CSV; rates and coverage."""
    spark.dataSource.register(BitmapSource)
    runs = spark.read.format("bencoded_bitmaps").load(bitmaps)
    places = F.broadcast(runs.where("pos = 0").select("catalog", "catalog_pos"))  # a row for each catalog
    rows = tables.read_catalog(spark, books)
    rows = rows.withColumns({c: F.lit("") for c in ("title", "authors") if c not in rows.columns})
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("row_id"), F.btrim("isbn13").alias("isbn13"), "title", "authors", I.isbn12(F.col("isbn13")).alias("isbn12")))
    keys = rows.select("row_id", "isbn12")
    hits = checkpointed(membership.members(keys, membership.runs_to_intervals(runs)).join(places, "catalog"))
    found = membership.matched_list(rows.where("isbn12 is not null"), hits, "row_id")
    own = hits.where(F.col("catalog") == specific).select("row_id", F.lit("yes").alias("own"))
    columns = ["isbn13", "title", "authors", F.coalesce("own", F.lit("no")).alias(f"in_{specific}"), F.col("num_catalogs").cast("string").alias("num_catalogs"), "matched_catalogs"]
    tables.write_catalog(found.join(own, "row_id", "left").orderBy("row_id").select(*columns), out, compressed=True)
    return {"catalogs": membership.catalog_rates(keys, hits).orderBy(F.desc("hits"), "catalog"), "coverage": membership.coverage(keys, hits, specific)}


def wanted(spark: SparkSession, books: str, ledger_dir: str, lookups_dir: str, out: str, notes: str | None = None, missing: str | None = None, bare: str | None = None) -> dict[str, DataFrame]:
    """What is still to be had of a cleaned catalog (ISBN first), as a gzipped CSV; counts by Screened and Status.

    ledger_dir, lookups_dir: ledger stores of (key, status, detail, ..) and (key, source, result, seq, ..). notes: an
    earlier wanted list; missing: a CSV of (ISBN, Reason); bare: a CSV of ISBNs without metadata.
    """
    book, looked = LedgerStore(spark, ledger_dir, ["key"]).read(), LedgerStore(spark, lookups_dir, ["key", "source"]).read()
    status = ledger.status_of(book.select(F.col("key").alias("ISBN"), "status", "detail"), looked.select(F.col("key").alias("ISBN"), "source", "result", "seq"), "ISBN")
    empty = lambda columns: spark.createDataFrame([], columns)
    old = tables.read_catalog(spark, notes).select("ISBN", F.col("Status").alias("status"), F.col("Detail").alias("detail")) if notes else empty("ISBN string, status string, detail string")
    miss = tables.read_catalog(spark, missing).select("ISBN", F.col("Reason").alias("reason")) if missing else empty("ISBN string, reason string")
    extra = tables.read_catalog(spark, bare) if bare else empty("ISBN string")
    rows = checkpointed(ledger.wanted(tables.read_catalog(spark, books), old, miss, status, extra))
    tables.write_catalog(rows, out, compressed=True)
    return {"counts": report.counts(rows, "Screened", "Status")}


def main(argv: Sequence[str] | None = None) -> dict[str, DataFrame]:
    parser = argparse.ArgumentParser(prog="quillmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("screen", help="a catalog to cleaned, eliminated and bare rows")
    one.add_argument("--input", required=True)
    one.add_argument("--outdir", required=True)
    one.add_argument("--rules", required=True, help="JSON file with the fields of RuleSet")
    one.add_argument("--cache", action="append", default=[], help="folder of JSON lines; several are asked in order")
    two = commands.add_parser("match", help="books against run-length bitmaps")
    two.add_argument("books")
    two.add_argument("bitmaps")
    two.add_argument("--out", required=True)
    two.add_argument("--specific", default="md5")
    three = commands.add_parser("wanted", help="what is still to be had")
    for name in ("books", "ledger", "lookups"):
        three.add_argument(name)
    three.add_argument("--out", required=True)
    for name in ("notes", "missing", "bare"):
        three.add_argument(f"--{name}")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"quillmill {a.command}").getOrCreate()
    if a.command == "screen":
        done = screen(spark, a.input, a.outdir, load_rules(a.rules), a.cache)
    elif a.command == "match":
        done = match(spark, a.books, a.bitmaps, a.out, a.specific)
    else:
        done = wanted(spark, a.books, a.ledger, a.lookups, a.out, a.notes, a.missing, a.bare)
    for name, table in done.items():
        print(name)
        table.show(100, truncate=False)
    return done
