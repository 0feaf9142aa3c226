"""Queries over identifiers, catalogs, enrichment and membership."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X
from quillmill.operators import dedup, enrich, membership
from quillmill.plans.base import CATALOG_SQL, CHECK_SQL, catalog, query, table
from quillmill.session import checkpointed, shared_dir
from quillmill.sources.shared import delete_at_end
from quillmill.sources.text_tree import write_tree
from quillmill.streaming import index

_VALID = f"(regexp_full_match(isbn13, '[0-9]{{13}}') AND {CHECK_SQL.format(x='isbn13')} = CAST(substr(isbn13, 13, 1) AS INT))"


@query(f"""WITH {CATALOG_SQL} SELECT p_partkey, first12, CAST(d AS VARCHAR) AS check_digit, first12 || d AS isbn13 FROM digit""")
def isbn_check_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return table(spark, sf_dir, "part").select("p_partkey", first.alias("first12")).withColumn("check_digit", I.check_digit13(F.col("first12"))).withColumn("isbn13", F.concat("first12", "check_digit"))


@query(f"""WITH {CATALOG_SQL} SELECT input_pos, isbn13, {_VALID} AS valid,
  CASE WHEN NOT {_VALID} THEN 'Invalid ISBN-13 check digit (expected ' || {CHECK_SQL.format(x="isbn13")} || ')' END AS reason FROM catalog""")
def isbn_validity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog(spark, sf_dir).withColumn("valid", I.valid13(F.col("isbn13")))
    return rows.select("input_pos", "isbn13", "valid", F.when(~F.col("valid"), I.invalid_reason(F.col("isbn13"))).alias("reason"))


_RAW10 = """raw AS (SELECT p_partkey, CASE p_partkey % 5
  WHEN 0 THEN substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 1, 1) || '-' || substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 2, 4) || '-' || substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 6) || '-x'
  WHEN 1 THEN lpad(CAST(p_partkey AS VARCHAR), 10, '0')
  WHEN 2 THEN '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0')
  WHEN 3 THEN lpad(CAST(p_partkey AS VARCHAR), 12, '0')
  ELSE 'ISBN: ' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '7 (' || ')' END AS code FROM part)"""


@query(f"""WITH {_RAW10}, k AS (SELECT p_partkey, code, upper(regexp_replace(code, '[^0-9Xx]', '', 'g')) AS t FROM raw)
  SELECT p_partkey, code, CASE WHEN length(t) = 13 THEN t WHEN length(t) = 10 THEN '978' || substr(t, 1, 9) || {CHECK_SQL.format(x="('978' || substr(t, 1, 9))")} ELSE '' END AS isbn13 FROM k""")
def isbn10_to_13(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    nine, k = F.lpad(key, 9, "0"), F.col("p_partkey") % 5
    code = (
        F.when(k == 0, F.concat(F.substring(nine, 1, 1), F.lit("-"), F.substring(nine, 2, 4), F.lit("-"), F.substring(nine, 6, 4), F.lit("-x")))
        .when(k == 1, F.lpad(key, 10, "0"))
        .when(k == 2, F.concat(F.lit("978"), F.lpad(key, 10, "0")))
        .when(k == 3, F.lpad(key, 12, "0"))
        .otherwise(F.concat(F.lit("ISBN: "), nine, F.lit("7 ()")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("code")).withColumn("isbn13", I.to13(F.col("code")))


@query(f"""WITH {CATALOG_SQL} SELECT input_pos, CAST(substr(isbn13, 1, 12) AS BIGINT) AS isbn12 FROM catalog WHERE regexp_full_match(isbn13, '[0-9]{{13}}')""")
def isbn12_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).select("input_pos", I.isbn12(F.col("isbn13")).alias("isbn12")).where("isbn12 is not null")


_RANKED = f"""{CATALOG_SQL}, ranked AS (SELECT *, {_VALID} AS valid, substr(isbn13, 1, 12) AS k,
  row_number() OVER w AS rn, first_value(isbn13) OVER w AS keeper FROM catalog
  WINDOW w AS (PARTITION BY substr(isbn13, 1, 12) ORDER BY {_VALID} DESC, (title <> '') DESC, input_pos))"""
_ELIM = f"""{_RANKED}, elim AS (SELECT *, CASE WHEN rn > 1 THEN 'duplicate' WHEN NOT valid THEN 'invalid_isbn' END AS elim_category,
  CASE WHEN rn > 1 AND keeper = isbn13 THEN 'Duplicate ISBN' WHEN rn > 1 THEN 'Duplicate of ISBN ' || keeper || ': same first 12 digits, this copy has a wrong check digit'
       WHEN NOT valid THEN 'Invalid ISBN-13 check digit (expected ' || {CHECK_SQL.format(x="isbn13")} || ')' END AS elim_reason FROM ranked)"""


@query(f"WITH {_ELIM} SELECT input_pos, isbn13, title FROM elim WHERE rn = 1")
def dedup_keeper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark_duplicates(catalog(spark, sf_dir)).where("elim_category is null or elim_category <> 'duplicate'").select("input_pos", "isbn13", "title")


@query(f"WITH {_ELIM} SELECT input_pos, isbn13, elim_category, elim_reason FROM elim WHERE elim_category IS NOT NULL")
def dedup_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark_duplicates(catalog(spark, sf_dir)).where("elim_category is not null").select("input_pos", "isbn13", "elim_category", "elim_reason")


@query(f"""WITH {_ELIM}, c AS (SELECT CASE WHEN elim_category IS NULL AND title = '' THEN 'no_metadata' ELSE elim_category END AS e FROM elim)
  SELECT CASE WHEN e IS NULL THEN 'cleaned' WHEN e = 'no_metadata' THEN 'bare' ELSE 'eliminated' END AS output, count(*) AS n FROM c GROUP BY ALL""")
def row_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.mark_duplicates(catalog(spark, sf_dir))
    rows = rows.withColumn("elim_category", F.when(F.col("elim_category").isNull() & (F.col("title") == ""), "no_metadata").otherwise(F.col("elim_category")))
    parts = [p.select(F.lit(name).alias("output")) for name, p in zip(("cleaned", "eliminated", "bare"), dedup.split_outputs(rows), strict=True)]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("output").agg(F.count("*").alias("n"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS squashed FROM documents")
def field_squash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.squash(F.col("text")).alias("squashed"))


_SUPPLIER = """s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE '' END AS publisher,
  CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 4 = 1 THEN s_name || ' (2 of 9 known books)' ELSE s_name || ' (1 of 1 known book)' END AS inferred FROM supplier)"""


@query(rf"""WITH {_SUPPLIER}, b AS (SELECT *, regexp_replace(inferred, '\s*\(\d+ of \d+ known books?\)$', '') AS bare FROM s)
  SELECT s_suppkey, CASE WHEN publisher <> '' THEN publisher ELSE bare END AS publisher,
  CASE WHEN publisher <> '' THEN 'record' WHEN bare <> '' THEN 'isbn_prefix' ELSE '' END AS source FROM b""")
def publisher_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("s_suppkey"), F.col("s_name")
    inferred = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(name, F.lit(" (2 of 9 known books)"))).otherwise(F.concat(name, F.lit(" (1 of 1 known book)")))
    publisher, source = dedup.publisher_fallback(F.when(k % 3 == 0, name).otherwise(""), inferred)
    return table(spark, sf_dir, "supplier").select("s_suppkey", publisher.alias("publisher"), source.alias("source"))


@query(r"""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 6 = 0 THEN '??' ELSE url END AS t FROM pages),
  n AS (SELECT page_id, regexp_replace(t, '[\\/:*?"<>|\x00-\x1f]', '', 'g') AS t, regexp_replace(split_part(url || ';x', ';', 1), '[\\/:*?"<>|\x00-\x1f]', '', 'g') AS a FROM p)
  SELECT page_id, coalesce(nullif(substr(trim(a, ' .'), 1, 120), ''), 'Unknown author') || '/' || coalesce(nullif(substr(trim(t, ' .'), 1, 120), ''), 'page' || page_id) || '.txt' AS path FROM n""")
def safe_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("page_id") % 6 == 0, "??").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", I.text_path(F.concat("url", F.lit(";x")), title, F.concat(F.lit("page"), F.col("page_id").cast("string"))).alias("path"))


@query(f"""WITH {CATALOG_SQL} SELECT isbn13 AS ISBN, 'yes' AS Screened, p.p_name AS Title,
  CASE WHEN p_size % 3 = 0 THEN p_type WHEN p_size % 3 = 1 THEN p_brand ELSE p_type || '; ' || p_brand END AS Genre,
  CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS Publisher, CASE WHEN p_size % 2 = 0 THEN 'record' ELSE 'isbn_prefix' END AS Publisher_Source, CAST(p_size AS VARCHAR) AS Pages
  FROM catalog JOIN part p USING (p_partkey) WHERE {_VALID} QUALIFY row_number() OVER (PARTITION BY substr(isbn13, 1, 12) ORDER BY title = '', input_pos) = 1""")
def tidy_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that deduplication keeps."""
    return _tidied(spark, sf_dir, dedup.mark_duplicates(catalog(spark, sf_dir)).where("elim_category is null"))


def _tidied(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    size = F.col("p_size")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type", "p_brand")
    rows = rows.select("p_partkey", "isbn13").join(part, "p_partkey")
    source = {
        "title": F.col("p_name"), "genres": F.when(size % 3 != 1, F.col("p_type")).otherwise(""), "fiction_or_type": F.when(size % 3 != 0, F.col("p_brand")).otherwise(""),
        "publisher": F.when(size % 2 == 0, F.col("p_brand")).otherwise(""), "publisher_inferred_from_prefix": F.concat("p_type", F.lit(" (3 of 8 known books)")), "pages": size.cast("string"),
    }
    rows = rows.withColumns(source | {c: F.lit("") for c in dedup.TIDY.values() if c and c not in source and c != "isbn13"})
    return dedup.insert_columns(dedup.tidy(rows), 1, {"Screened": F.lit("yes")}).select("ISBN", "Screened", "Title", "Genre", "Publisher", "Publisher_Source", "Pages")


@query("""WITH r AS (SELECT n_regionkey AS k, arg_max(n_name, n_nationkey) AS last_name FROM nation WHERE n_regionkey <> 2 GROUP BY n_regionkey)
  SELECT n_nationkey, coalesce(last_name, '') AS last_name, coalesce(last_name, 'not known') AS with_default FROM nation LEFT JOIN r ON n_regionkey = k""")
def lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    known = nation.where("n_regionkey <> 2")
    rows = dedup.lookup(nation.select("n_nationkey", "n_regionkey"), known, "n_regionkey", "n_name", "n_nationkey", name="last_name")
    rows = dedup.lookup(rows, known, "n_regionkey", "n_name", "n_nationkey", F.lit("not known"), "with_default")
    return rows.select("n_nationkey", "last_name", "with_default")


_SOURCES = """cache AS (
  SELECT c_custkey AS k, 0 AS source_rank, CASE WHEN c_custkey % 3 = 0 THEN '  ' || c_name || ' ' ELSE '' END AS title, c_mktsegment AS publisher, 'alpha' AS source, c_custkey % 5 <> 0 AS known FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, 1, CASE WHEN c_custkey % 4 < 2 THEN c_name || ' II' ELSE '' END, '', 'beta', c_custkey % 7 <> 0 FROM customer WHERE c_custkey % 3 < 2
  UNION ALL SELECT c_custkey, 2, c_name || ' III', 'p3', 'gamma', true FROM customer WHERE c_custkey % 10 = 1),
  hit AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source_rank) AS rn FROM cache WHERE known AND title <> '')"""


def _cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    meta = lambda t, p, s, known: F.when(known, F.struct(t.alias("title"), p.alias("publisher"), F.lit(s).alias("source")))
    customer = table(spark, sf_dir, "customer")
    parts = [
        customer.where(k % 2 == 0).select(k.alias("isbn"), F.lit(0).alias("source_rank"), meta(F.when(k % 3 == 0, F.concat(F.lit("  "), name, F.lit(" "))).otherwise(""), F.col("c_mktsegment"), "alpha", k % 5 != 0).alias("meta")),
        customer.where(k % 3 < 2).select(k.alias("isbn"), F.lit(1).alias("source_rank"), meta(F.when(k % 4 < 2, F.concat(name, F.lit(" II"))).otherwise(""), F.lit(""), "beta", k % 7 != 0).alias("meta")),
        customer.where(k % 10 == 1).select(k.alias("isbn"), F.lit(2).alias("source_rank"), meta(F.concat(name, F.lit(" III")), F.lit("p3"), "gamma", F.lit(True)).alias("meta")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(rf"""WITH {_SOURCES} SELECT c_custkey AS isbn, coalesce(nullif(CASE WHEN c_custkey % 8 = 0 THEN 'own title' ELSE '' END, ''), trim(regexp_replace(title, '\s+', ' ', 'g'), ' '), '') AS title,
  coalesce(nullif(CASE WHEN c_custkey % 6 = 0 THEN 'own' ELSE '' END, ''), publisher, '') AS publisher,
  'catalog' || coalesce('; ' || source, '') AS metadata_sources FROM customer LEFT JOIN (SELECT * FROM hit WHERE rn = 1) ON c_custkey = k""")
def waterfall_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("isbn"), F.when(k % 8 == 0, "own title").otherwise("").alias("title"), F.when(k % 6 == 0, "own").otherwise("").alias("publisher"), F.lit("catalog").alias("metadata_sources"))
    return enrich.fill_empty(rows, enrich.resolve(_cache(spark, sf_dir)))


@query(f"""WITH {_SOURCES}, won AS (SELECT k, source_rank AS w FROM hit WHERE rn = 1)
  SELECT source_rank, count(DISTINCT k) AS queried, count(*) FILTER (source_rank = w) AS resolved FROM cache LEFT JOIN won USING (k) WHERE w IS NULL OR source_rank <= w GROUP BY source_rank""")
def waterfall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.source_stats(_cache(spark, sf_dir))


_FIRST12 = "('978' || lpad(CAST({k} AS VARCHAR), 9, '0'))"
_ISBN = f"({_FIRST12} || {CHECK_SQL.format(x=_FIRST12)})"


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search answer for each order: a document for each of its lines, with the ISBN of its part."""
    first = F.concat(F.lit("978"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))
    code = F.concat(first, I.check_digit13(first))
    line = F.struct(
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("title"), F.array(F.lit("A. Author"), F.lit("B. Author")).alias("author_name"),
        F.transform(F.sequence(F.lit(1), F.lit(45)), lambda i: F.concat(F.lit("s"), i.cast("string"))).alias("subject"), F.array(F.col("l_returnflag")).alias("publisher"), F.array(code, F.lit("bad")).alias("isbn"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", line.alias("d")))).alias("x"))
    return lines.select(F.col("l_orderkey").alias("payload_id"), F.to_json(F.struct(F.col("x.d").alias("docs"))).alias("payload"))


@query(f"""SELECT {_ISBN.format(k="l_partkey")} AS isbn, 'Part ' || l_partkey AS title, 'A. Author; B. Author' AS authors,
  array_to_string(list_transform(range(1, 41), lambda i: 's' || i), '; ') AS subjects, arg_min(l_returnflag, l_orderkey * 100 + l_linenumber) AS publisher FROM lineitem GROUP BY l_partkey""")
def search_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich.parse_search(_payloads(spark, sf_dir))
    return found.select("isbn", "meta.title", "meta.authors", "meta.subjects", "meta.publisher")


def _volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    head, tail = F.concat(F.lit('{"items":[{"volumeInfo":{"title":"T'), k, F.lit('","authors":["A","B"],"categories":["c1","c2"]},"accessInfo":{"accessViewStatus":"SAMPLE"}},')), F.lit(
        '{"accessInfo":{"accessViewStatus":"FULL_PUBLIC_DOMAIN","epub":{"isAvailable":false}}},'
    )
    link = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('"epub":{"downloadLink":"e'), k, F.lit('"},'))).otherwise("")
    last = F.concat(F.lit('{"accessInfo":{"accessViewStatus":"FULL_PUBLIC_DOMAIN",'), link, F.lit('"pdf":{"downloadLink":"p'), k, F.lit('"}}}]}'))
    payload = F.when(F.col("c_custkey") % 5 == 0, F.lit("{}")).when(F.col("c_custkey") % 7 == 0, F.lit('{"items":[]}')).otherwise(F.concat(head, tail, last))
    return table(spark, sf_dir, "customer").select("c_custkey", payload.alias("payload"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'T' || c_custkey END AS title, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'A; B' END AS authors,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'c1; c2' END AS genres FROM customer""")
def volume_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volumes(spark, sf_dir).select("c_custkey", enrich.parse_volume(F.col("payload")).alias("m")).select("c_custkey", "m.title", "m.authors", "m.genres")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'e' || c_custkey ELSE 'p' || c_custkey END AS link FROM customer""")
def public_domain_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volumes(spark, sf_dir).select("c_custkey", enrich.public_domain_link(F.col("payload")).alias("link"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 AND page_id % 2 = 0 THEN 'item' || page_id END AS identifier FROM pages""")
def full_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    url = F.when(k % 2 == 0, F.concat(F.lit("https://archive.org/details/item"), k.cast("string"), F.lit("/page/1"))).otherwise("https://example.org/details/x")
    return table(spark, sf_dir, "pages").select("page_id", enrich.full_view_id(F.when(k % 3 == 0, "full").otherwise("noview"), url).alias("identifier"))


@query(f"""WITH x AS (SELECT 'id' || l_orderkey AS identifier, {_ISBN.format(k="l_partkey")} AS isbn FROM lineitem)
  SELECT isbn, array_to_string(list_sort(list(DISTINCT identifier)), ',') AS ids FROM x GROUP BY isbn""")
def bulk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(table(spark, sf_dir, "lineitem"))


@query(f"""WITH x AS (SELECT 'id' || l_orderkey AS identifier, {_ISBN.format(k="l_partkey")} AS isbn FROM lineitem)
  SELECT isbn, array_to_string(list_sort(list(DISTINCT identifier)), ',') AS ids FROM x GROUP BY isbn""")
def paged_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same index from pages of a search, some of which come in only after the stream has run for the first time."""
    folder = delete_at_end(spark, f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}")
    items = _items(table(spark, sf_dir, "lineitem")).withColumns({"query": F.concat(F.lit("q"), (F.col("l_orderkey") % 3).cast("string")), "page": F.floor(F.col("l_orderkey") / 3000)})
    pages = items.groupBy("query", "page").agg(F.collect_list(F.struct("identifier", F.col("isbns").alias("isbn"))).alias("items"))
    # pages of a query are numbered without gaps, as a cursor leads from each to the next
    order = Window.partitionBy("query").orderBy("page")
    pages = pages.withColumns({"n": F.row_number().over(order), "last": F.lead("page").over(order).isNull()})
    name = F.when(F.col("n") == 1, "start").otherwise(F.col("n").cast("string"))
    body = F.to_json(F.struct("items", F.when(~F.col("last"), (F.col("n") + 1).cast("string")).alias("cursor")))
    pages = checkpointed(pages.select(F.concat("query", F.lit("/"), name, F.lit(".json")).alias("path"), body.alias("record"), (F.col("n") % 4 == 3).alias("late")))
    for part in (pages.where("not late"), pages.where("late")):
        write_tree(part, f"{folder}/pages")
        index.collect_pages(spark, f"{folder}/pages", f"{folder}/items", f"{folder}/checkpoint").awaitTermination()
    return index.collected_index(spark, f"{folder}/items").select("isbn", F.array_join("ids", ",").alias("ids"))


def _items(lines: DataFrame) -> DataFrame:
    first = F.concat(F.lit("978"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))
    lines = lines.select("l_orderkey", F.concat(first, I.check_digit13(first)).alias("code"))
    items = lines.groupBy("l_orderkey").agg(F.concat_ws("; ", F.collect_list("code"), F.lit("none")).alias("isbns"))
    return items.withColumn("identifier", F.concat(F.lit("id"), F.col("l_orderkey").cast("string")))


def _indexed(lines: DataFrame) -> DataFrame:
    return enrich.bulk_index(_items(lines)).select("isbn", F.array_join("ids", ",").alias("ids"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN false WHEN event_id % 5 < 3 THEN true WHEN event_id % 5 = 3 THEN true ELSE false END AS open,
  CASE event_id % 5 WHEN 0 THEN 'archive.org copy is lending-only' WHEN 1 THEN 'https://creativecommons.org/licenses/by/' || event_id WHEN 2 THEN 'x https://creativecommons.org/publicdomain/' WHEN 3 THEN 'public domain (archive.org: NOT_IN_COPYRIGHT)' ELSE 'archive.org copy has no open licence' END AS why FROM events""")
def licence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    md = (
        F.when(k % 5 == 0, '{"access-restricted-item":"TRUE","licenseurl":"https://creativecommons.org/x"}')
        .when(k % 5 == 1, F.concat(F.lit('{"licenseurl":"https://creativecommons.org/licenses/by/'), k.cast("string"), F.lit('"}')))
        .when(k % 5 == 2, '{"licenseurl":["x","https://creativecommons.org/publicdomain/"]}')
        .when(k % 5 == 3, '{"possible-copyright-status":"NOT_IN_COPYRIGHT"}')
        .otherwise("{}")
    )
    return table(spark, sf_dir, "events").select("event_id", enrich.licence_gate(md).alias("g")).select("event_id", "g.open", "g.why")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'a_djvu.txt' WHEN 1 THEN 'b.EPUB' WHEN 2 THEN 'c.pdf' END AS file FROM events""")
def file_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    names = F.concat(F.array(F.lit("meta.xml"), F.lit("z.jpg")), F.when(k <= 2, F.array(F.lit("c.pdf"))).otherwise(F.array(F.lit("q.png"))), F.when(k <= 1, F.array(F.lit("b.EPUB"))).otherwise(F.array(F.lit("r.png"))), F.when(k == 0, F.array(F.lit("a_djvu.txt"))).otherwise(F.array(F.lit("t.png"))))
    return table(spark, sf_dir, "events").select("event_id", enrich.preferred_file(names).alias("file"))


@query("""SELECT page_id, (page_id % 7 = 0 OR contains(substr(html, 1, 3000), '<title>Loading') OR contains(substr(html, 1, 3000), 'DDoS-Guard') OR page_id % 11 = 0) AS blocked FROM pages""")
def blocked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    body = F.when(k % 11 == 0, F.concat(F.lit("<html>DDoS-Guard"), "html")).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", enrich.is_blocked(F.when(k % 7 == 0, 429).otherwise(200), body).alias("blocked"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 3 THEN '' ELSE 'Result & more ' || page_id END AS title FROM pages""")
def page_title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    card = F.concat(F.lit('<!--<a href="/record/'), k, F.lit('"><div><h3 class="t">Result <b>&amp;</b>\n more '), k, F.lit("</h3></div></a>-->"))
    page = F.concat(F.col("html"), F.when(F.col("page_id") % 4 != 3, card).otherwise("<h3>no link</h3>"))
    return table(spark, sf_dir, "pages").select("page_id", enrich.result_title(page, 'href="/record/[^"]+"').alias("title"))


_RUNS = """runs AS (SELECT c.catalog, c.catalog_pos, r.pos, (r.pos * c.step + c.add) % 97 + CASE WHEN r.pos % 50 = 0 THEN 4000 ELSE 1 END AS run_len
  FROM (VALUES ('north', 0, 37, 5), ('md5', 1, 53, 11)) c(catalog, catalog_pos, step, add), (SELECT unnest(range(0, 1200)) AS pos) r),
  iv AS (SELECT catalog, catalog_pos, hi - run_len AS lo, hi, pos FROM (SELECT *, 978000000000 + sum(run_len) OVER (PARTITION BY catalog ORDER BY pos) AS hi FROM runs)),
  keys AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 978000000000 - 500 + o_orderkey * 3 END AS isbn12 FROM orders),
  hits AS (SELECT row_id, isbn12, catalog, catalog_pos FROM keys JOIN iv ON isbn12 >= lo AND isbn12 < hi AND pos % 2 = 0)"""


def _runs(spark: SparkSession) -> DataFrame:
    one = lambda name, place, step, add: spark.range(1200).select(F.lit(name).alias("catalog"), F.lit(place).alias("catalog_pos"), F.col("id").alias("pos"), ((F.col("id") * step + add) % 97 + F.when(F.col("id") % 50 == 0, 4000).otherwise(1)).alias("run_len"))
    return one("north", 0, 37, 5).unionByName(one("md5", 1, 53, 11))


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("row_id"), F.when(k % 19 != 0, F.lit(978_000_000_000 - 500) + k * 3).alias("isbn12"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _runs(spark).select("catalog", "catalog_pos").distinct()
    return membership.members(_keys(spark, sf_dir), membership.runs_to_intervals(_runs(spark))).join(F.broadcast(places), "catalog")


@query(f"WITH {_RUNS} SELECT row_id, isbn12, catalog FROM hits")
def interval_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.members(_keys(spark, sf_dir), membership.runs_to_intervals(_runs(spark))).select("row_id", "isbn12", "catalog")


_CROWDED = """runs AS (SELECT 'c' || l_linenumber AS catalog, l_orderkey AS pos, 1 + CAST(sum(l_partkey) AS BIGINT) % 7 AS run_len FROM lineitem GROUP BY l_linenumber, l_orderkey),
  ends AS (SELECT catalog, pos, run_len, 978000000000 + sum(run_len) OVER (PARTITION BY catalog ORDER BY pos) AS hi FROM runs),
  intervals AS (SELECT catalog, hi - run_len AS lo, hi FROM ends WHERE pos % 2 = 0),
  keys AS (SELECT l_orderkey AS row_id, l_linenumber AS line, 978000000000 + (l_orderkey * 3 + l_partkey * 37) % 60000 AS isbn12 FROM lineitem)"""


@query(f"WITH {_CROWDED} SELECT row_id, line, isbn12, catalog FROM keys JOIN intervals ON isbn12 >= lo AND isbn12 < hi")
def crowded_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many intervals and keys as lineitem has rows, all within a stretch of 60,000 identifiers."""
    lines = table(spark, sf_dir, "lineitem")
    runs = lines.groupBy(F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("catalog"), F.col("l_orderkey").alias("pos")).agg((1 + F.sum("l_partkey") % 7).alias("run_len"))
    keys = lines.select(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("line"), (F.lit(membership.FIRST) + (F.col("l_orderkey") * 3 + F.col("l_partkey") * 37) % 60_000).alias("isbn12"))
    return membership.members(keys, membership.runs_to_intervals(runs))


@query(f"WITH {_RUNS} SELECT catalog, count(*) AS hits, count(*) / (SELECT count(isbn12) FROM keys) AS rate FROM hits GROUP BY catalog")
def catalog_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.catalog_rates(_keys(spark, sf_dir), _hits(spark, sf_dir))


@query(f"""WITH {_RUNS}, per AS (SELECT row_id, bool_or(catalog = 'md5') AS own FROM hits GROUP BY row_id)
  SELECT count(*) AS valid, count(own) AS any_catalog, count(*) FILTER (own) AS specific, count(*) FILTER (own IS NULL) AS no_catalog FROM keys LEFT JOIN per USING (row_id) WHERE isbn12 IS NOT NULL""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.coverage(_keys(spark, sf_dir), _hits(spark, sf_dir), "md5")


@query(f"""WITH {_RUNS} SELECT row_id, count(catalog) AS num_catalogs, coalesce(string_agg(catalog, ';' ORDER BY catalog_pos), '') AS matched_catalogs
  FROM keys LEFT JOIN hits USING (row_id) WHERE keys.isbn12 IS NOT NULL GROUP BY row_id""")
def matched_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(spark, sf_dir).where("isbn12 is not null")
    return membership.matched_list(keys, _hits(spark, sf_dir), "row_id").select("row_id", F.col("num_catalogs").cast("long"), "matched_catalogs")
