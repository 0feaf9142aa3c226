"""Waterfall enrichment: sources in a fixed order fill what is still empty; payload parsing for the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X

FIELDS = ("title", "subtitle", "authors", "subjects", "publisher", "language", "genres", "description")
AUTHORS, SUBJECTS = 10, 40


def resolve(cache: DataFrame, key: str = "isbn") -> DataFrame:
    """Of each key's cached answers (key, source_rank, meta) the first by rank whose title is not empty.

    A null meta is a known miss and resolves nothing.
    """
    hits = cache.where(F.coalesce(F.col("meta.title"), F.lit("")) != "")
    return hits.groupBy(key).agg(F.min_by("meta", "source_rank").alias("meta"), F.min("source_rank").alias("source_rank"))


def source_stats(cache: DataFrame, key: str = "isbn") -> DataFrame:
    """Per source: keys queried (still unresolved by earlier sources, misses included) and keys resolved."""
    won = resolve(cache, key).select(key, F.col("source_rank").alias("won"))
    seen = cache.join(won, key, "left").where(F.col("won").isNull() | (F.col("source_rank") <= F.col("won")))
    return seen.groupBy("source_rank").agg(F.countDistinct(key).alias("queried"), F.count_if(F.col("source_rank") == F.col("won")).alias("resolved"))


def fill_empty(rows: DataFrame, resolved: DataFrame, key: str = "isbn", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Fields that are empty get the resolved value, squashed; the source's name is appended to metadata_sources."""
    joined = rows.join(resolved.select(key, "meta"), key, "left")
    have = set(resolved.schema["meta"].dataType.fieldNames())
    filled = {f: F.when(F.coalesce(F.col(f), F.lit("")) != "", F.col(f)).otherwise(X.squash(F.col(f"meta.{f}"))) for f in fields if f in rows.columns and f in have}
    source = X.join_nonempty(F.col("metadata_sources"), F.col("meta.source")) if "metadata_sources" in rows.columns and "source" in have else None
    return joined.withColumns(filled | ({"metadata_sources": source} if source is not None else {})).drop("meta")


SEARCH = "docs array<struct<title string, subtitle string, author_name array<string>, subject array<string>, publisher array<string>, language array<string>, isbn array<string>>>"
VOLUME = "items array<struct<volumeInfo struct<title string, subtitle string, authors array<string>, publisher string, language string, categories array<string>, description string>, accessInfo struct<accessViewStatus string, epub struct<downloadLink string>, pdf struct<downloadLink string>>>>"


def parse_search(payloads: DataFrame) -> DataFrame:
    """(payload_id, payload) to (isbn, meta): of each wanted code the first document that carries it."""
    docs = payloads.select("payload_id", F.posexplode(F.from_json("payload", SEARCH)["docs"]).alias("pos", "d"))
    joined = lambda c, n: F.array_join(F.slice(F.coalesce(c, F.array().cast("array<string>")), 1, n), "; ")
    text = lambda c: F.coalesce(c, F.lit(""))
    meta = F.struct(
        text(F.col("d.title")).alias("title"), text(F.col("d.subtitle")).alias("subtitle"), joined(F.col("d.author_name"), AUTHORS).alias("authors"), joined(F.col("d.subject"), SUBJECTS).alias("subjects"),
        text(F.get("d.publisher", F.lit(0))).alias("publisher"), joined(F.col("d.language"), 1 << 20).alias("language"),
    )
    codes = docs.select("payload_id", "pos", meta.alias("meta"), F.explode("d.isbn").alias("code")).withColumn("isbn", I.to13(F.col("code"))).where("isbn != ''")
    return codes.groupBy("isbn").agg(F.min_by("meta", F.struct("payload_id", "pos")).alias("meta"))


def parse_volume(payload: Column) -> Column:
    """Meta struct of a volume search's first item; null when there are no items (a known miss)."""
    v = F.get(F.from_json(payload, VOLUME)["items"], F.lit(0))["volumeInfo"]
    text = lambda c: F.coalesce(c, F.lit(""))
    many = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "; ")
    meta = F.struct(
        text(v.title).alias("title"), text(v.subtitle).alias("subtitle"), many(v.authors).alias("authors"), text(v.publisher).alias("publisher"),
        text(v.language).alias("language"), many(v.categories).alias("genres"), text(v.description).alias("description"),
    )
    return F.when(v.isNotNull(), meta)


def public_domain_link(payload: Column) -> Column:
    """Download link of the first public-domain item that has one, the epub before the pdf; null if none."""
    items = F.filter(F.from_json(payload, VOLUME)["items"], lambda i: i.accessInfo.accessViewStatus == "FULL_PUBLIC_DOMAIN")
    links = F.transform(items, lambda i: F.coalesce(F.nullif(i.accessInfo.epub.downloadLink, F.lit("")), F.nullif(i.accessInfo.pdf.downloadLink, F.lit(""))))
    return F.get(F.filter(links, lambda x: x.isNotNull()), F.lit(0))


def full_view_id(preview: Column, url: Column) -> Column:
    """Archive identifier of a book shown in full; null otherwise."""
    return F.when((preview == "full") & F.contains(url, F.lit("archive.org/details/")), F.regexp_extract(url, r".*/details/([^/]*)", 1))


def bulk_index(items: DataFrame) -> DataFrame:
    """(identifier, isbns) to (isbn, ids): each code of a delimited list, canonical, with all identifiers that carry it."""
    codes = items.select("identifier", F.explode(F.split("isbns", r"[;,\s]+")).alias("code"))
    return codes.withColumn("isbn", I.to13(F.col("code"))).where("isbn != ''").groupBy("isbn").agg(F.array_sort(F.collect_set("identifier")).alias("ids"))


def is_blocked(status: Column, body: Column, markers: tuple[str, ...] = ("DDoS-Guard", "<title>Loading")) -> Column:
    """A refusal by status, or by a marker near the start of the page."""
    head = F.substring(F.coalesce(body, F.lit("")), 1, 3000)
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(head, F.lit(m))
    return F.coalesce(status.isin(403, 429, 503), F.lit(False)) | found


def result_title(page: Column, link: str) -> Column:
    """Title of the first result: the first h3 within 6,000 characters after the first link that matches; "" if none."""
    plain = F.replace(F.replace(F.coalesce(page, F.lit("")), F.lit("<!--"), F.lit("")), F.lit("-->"), F.lit(""))
    first = F.regexp_extract(plain, f"(?s)^(.*?{link})", 1)
    after = F.substr(plain, F.length(first) + 1, F.lit(6000))
    title = F.regexp_extract(after, r"(?s)<h3[^>]*>(.*?)</h3>", 1)
    return F.when(first == "", "").otherwise(X.squash(X.unescape_common(F.regexp_replace(title, "<[^>]+>", " "))))


# What marks a licence as open, and the answers in words below.
LICENCE_OPEN = ("creativecommons.org", "publicdomain")


def licence_gate(metadata: Column) -> Column:
    """Struct (open, why) of an item's JSON metadata: lending-only, then open licence, then public domain, else closed."""
    get = lambda name: F.get_json_object(metadata, f"$['{name}']")
    raw = F.coalesce(get("licenseurl"), F.lit(""))
    url = F.when(raw.startswith("["), F.array_join(F.from_json(raw, "array<string>"), " ")).otherwise(raw)
    named = F.lit(False)
    for n in LICENCE_OPEN:
        named = named | F.contains(url, F.lit(n))
    answer = lambda ok, why: F.struct(F.lit(ok).alias("open"), why.alias("why"))
    return (
        F.when(F.lower(F.coalesce(get("access-restricted-item"), F.lit(""))) == "true", answer(False, F.lit("archive.org copy is lending-only")))
        .when(named, answer(True, url))
        .when(get("possible-copyright-status") == "NOT_IN_COPYRIGHT", answer(True, F.lit("public domain (archive.org: NOT_IN_COPYRIGHT)")))
        .otherwise(answer(False, F.lit("archive.org copy has no open licence")))
    )


def preferred_file(names: Column, suffixes: tuple[str, ...] = ("_djvu.txt", ".epub", ".pdf")) -> Column:
    """First file with the first suffix, else with the next; all but the first suffix in any case."""

    def first(suffix: str, exact: bool) -> Column:
        return F.get(F.filter(names, lambda n: F.endswith(n if exact else F.lower(n), F.lit(suffix))), F.lit(0))

    return F.coalesce(*(first(s, i == 0) for i, s in enumerate(suffixes)))
