"""Queries over text repair, lines, paragraphs, records and language identification."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X
from quillmill.operators import audit, langid, lid, lines, mojibake, records
from quillmill.plans.base import CHECK_SQL, query, spread, table
from quillmill.session import checkpointed, shared_dir
from quillmill.sources.shared import delete_at_end
from quillmill.sources.text_tree import saved, write_tree

_TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>"
_STRIPPED = rf"""stripped AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(
  CASE WHEN len(regexp_extract_all(substr(html, 1, 200000), '{_TAG}')) > 20 THEN regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<head\b.*?</head>', ' ', 'g'), '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?i)<br\s*/?>|</(?:p|div|h[0-9]|li|tr)>', chr(10), 'g'), '{_TAG}', ' ', 'g') ELSE html END,
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS t FROM pages)"""
_SPACE = "'[ \t  -  　]+'"
_LETTERS = "length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))"


def _lines_sql(source: str, key: str, text: str) -> str:
    """Rows (key, pos, line) of a table's texts, horizontal space collapsed."""
    return f"(SELECT {key}, pos, trim(regexp_replace(line, {_SPACE}, ' ', 'g'), ' ') AS line FROM (SELECT {key}, unnest(l) AS line, unnest(range(0, len(l))) AS pos FROM (SELECT {key}, string_split({text}, chr(10)) AS l FROM {source})))"


def _stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select(F.col("page_id").alias("doc_id"), X.unescape_common(X.strip_tags(F.col("html"))).alias("text"))


@query(f"""WITH {_STRIPPED}, ln AS {_lines_sql("stripped", "page_id", "t")}
  SELECT page_id, count(*) FILTER (line <> '') AS n_lines, CAST(sum({_LETTERS.format(x="line")}) AS BIGINT) AS n_letters,
  count(*) FILTER (line <> '' AND NOT ({_LETTERS.format(x="line")} < 3 OR {_LETTERS.format(x="line")} < 0.5::DOUBLE * length(replace(line, ' ', '')))) AS n_kept FROM ln GROUP BY page_id""")
def strip_markup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: markup to lines of text, with what of them is not debris."""
    rows, line = lines.split_lines(_stripped(spark, sf_dir)), F.col("line")
    return rows.groupBy(F.col("doc_id").alias("page_id")).agg(F.count_if(line != "").alias("n_lines"), F.sum(X.letters(line)).alias("n_letters"), F.count_if((line != "") & ~lines.is_debris(line)).alias("n_kept"))


@query(f"WITH {_STRIPPED} SELECT page_id, t AS text FROM stripped")
def markup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stripped(spark, sf_dir).withColumnRenamed("doc_id", "page_id")


_FOLD_FROM, _FOLD_TO = "".join(X.FOLD), "".join(X.FOLD.values()).replace("'", "''")


@query(f"""SELECT doc_id, lower(translate(text, '{_FOLD_FROM}', '{_FOLD_TO}')) AS folded FROM documents""")
def fold_latin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select("doc_id", X.fold_latin(F.col("text")).alias("folded"))


@query(f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ışık ' || text WHEN doc_id % 3 = 1 THEN 'ýþýk Ð ' || text ELSE 'ýş' || text END AS t FROM documents)
  SELECT doc_id, CASE WHEN length(t) - length(replace(replace(t, 'ý', ''), 'þ', '')) > length(t) - length(replace(replace(t, 'ı', ''), 'ş', '')) THEN translate(t, '{"".join(X.CP1254)}', '{"".join(X.CP1254.values())}') ELSE t END AS repaired FROM t""")
def codepage_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codepage(spark, sf_dir, F.col("text"))


def _codepage(spark: SparkSession, sf_dir: str, body: Column) -> DataFrame:
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.concat(F.lit("ışık "), body)).when(k == 1, F.concat(F.lit("ýþýk Ð "), body)).otherwise(F.concat(F.lit("ýş"), body))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", X.fix_codepage(text).alias("repaired"))


_DIRTY = "'Ä±Ã¼' || chr(173) || 'a' || chr(8203) || 'b' || chr(13) || chr(10) || 'c' || chr(12) || 'd' || chr(11) || 'e' || chr(9) || chr(7) || chr(13) || text"


@query(f"""WITH d AS (SELECT doc_id, {_DIRTY} AS t FROM documents)
  SELECT doc_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(t, 'Ä±', 'ı'), 'Ã¼', 'ü'), chr(173), ''), chr(8203), ''), chr(12), chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f]', '', 'g') AS repaired FROM d""")
def char_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _characters(spark, sf_dir, F.col("text"))


def _characters(spark: SparkSession, sf_dir: str, body: Column) -> DataFrame:
    dirty = F.concat(F.lit("Ä±Ã¼­a​b\r\nc\fd\x0be\t\x07\r"), body)
    return spread(table(spark, sf_dir, "documents")).select("doc_id", X.drop_control(X.unify_newlines(X.drop_invisible(X.fix_mojibake(dirty)))).alias("repaired"))


@query("""SELECT doc_id, nfc_normalize(replace(replace(text, 'é', 'e' || chr(769)), 'ñ', 'n' || chr(771))) AS nfc FROM documents""")
def nfc_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _composed(spark, sf_dir, F.col("text"))


def _composed(spark: SparkSession, sf_dir: str, body: Column) -> DataFrame:
    split = F.replace(F.replace(body, F.lit("é"), F.lit("é")), F.lit("ñ"), F.lit("ñ"))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", X.nfc(split).alias("nfc"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select("doc_id", "text")


@query(f"""WITH ln AS {_lines_sql("documents", "doc_id", "text")} SELECT doc_id, pos, line FROM ln WHERE line <> '' AND ({_LETTERS.format(x="line")} < 3 OR {_LETTERS.format(x="line")} < 0.5::DOUBLE * length(replace(line, ' ', '')))""")
def line_debris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.split_lines(_documents(spark, sf_dir)).where(lines.is_debris(F.col("line"))).select("doc_id", F.col("pos").cast("long"), "line")


_TERMINAL = X.TERMINAL.replace("'", "''")
_HEADS = f"""k AS (SELECT *, lower(trim(regexp_replace(line, '[0-9]+', '', 'g'), ' .-–—|')) AS key FROM ln WHERE length(line) BETWEEN 1 AND 80),
  heads AS (SELECT doc_id, key FROM k WHERE key <> '' AND NOT contains('{_TERMINAL}', right(key, 1)) AND regexp_matches(key, '[{X.LATIN}]') GROUP BY doc_id, key HAVING count(*) >= 5)"""


@query(f"""WITH ln AS {_lines_sql("documents", "doc_id", "text")}, {_HEADS} SELECT doc_id, pos, line FROM k JOIN heads USING (doc_id, key)""")
def running_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.with_heads(lines.split_lines(_documents(spark, sf_dir))).where("head").select("doc_id", F.col("pos").cast("long"), "line")


_PAGE_LINES = "CASE o_orderkey % 8 WHEN 0 THEN '- ' || o_orderkey % 2000 || ' -' WHEN 1 THEN 'Page ' || o_orderkey WHEN 2 THEN 'xiv.' WHEN 3 THEN 's. ' || o_orderkey % 99 WHEN 4 THEN o_orderkey || ' items' WHEN 5 THEN 'SAYFA 12 —' WHEN 6 THEN 'vivid' ELSE '' || o_orderkey END"


@query(f"""SELECT o_orderkey, l AS line, regexp_full_match(l, '(?i)[-–—.\\s]*(?:(?:sayfa|page|s\\.|p\\.)\\s*)?(?:[0-9]{{1,4}}|[ivxlc]{{1,6}})[-–—.\\s]*') AS page_number FROM (SELECT o_orderkey, {_PAGE_LINES} AS l FROM orders)""")
def page_number_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = k.cast("string")
    line = (
        F.when(k % 8 == 0, F.concat(F.lit("- "), (k % 2000).cast("string"), F.lit(" -"))).when(k % 8 == 1, F.concat(F.lit("Page "), s)).when(k % 8 == 2, "xiv.").when(k % 8 == 3, F.concat(F.lit("s. "), (k % 99).cast("string")))
        .when(k % 8 == 4, F.concat(s, F.lit(" items"))).when(k % 8 == 5, "SAYFA 12 —").when(k % 8 == 6, "vivid").otherwise(s)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", line.alias("line")).withColumn("page_number", lines.is_page_number(F.col("line")))


#: Documents with blocks: every third line end is doubled, and some lines end in a hyphen before a lower-case line.
_BLOCKS = """doc_blocks AS (SELECT doc_id, string_agg(CASE WHEN pos % 5 = 1 THEN l || '-' ELSE l END || CASE WHEN pos % 3 = 2 THEN chr(10) ELSE '' END, chr(10) ORDER BY pos) AS text
  FROM (SELECT doc_id, unnest(list_transform(p, lambda x: x)) AS l, unnest(range(0, len(p))) AS pos FROM (SELECT doc_id, string_split(replace(text, '. ', chr(10)), chr(10)) AS p FROM documents WHERE length(text) > 0)) GROUP BY doc_id)"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).where("length(text) > 0")
    parts = F.transform(F.split(F.replace("text", F.lit(". "), F.lit("\n")), "\n", -1), lambda x, i: F.concat(x, F.when(i % 5 == 1, "-").otherwise(""), F.when(i % 3 == 2, "\n").otherwise("")))
    return docs.select("doc_id", F.array_join(parts, "\n").alias("text"))


_KEPT = f"""ln AS {_lines_sql("doc_blocks", "doc_id", "text")}, {_HEADS},
  kept AS (SELECT ln.* FROM ln LEFT JOIN (SELECT k.doc_id, k.pos FROM k JOIN heads USING (doc_id, key)) h USING (doc_id, pos) WHERE line = '' OR (h.pos IS NULL
    AND NOT regexp_full_match(line, '(?i)[-–—.\\s]*(?:(?:sayfa|page|s\\.|p\\.)\\s*)?(?:[0-9]{{1,4}}|[ivxlc]{{1,6}})[-–—.\\s]*')
    AND NOT ({_LETTERS.format(x="line")} < 3 OR {_LETTERS.format(x="line")} < 0.5::DOUBLE * length(replace(line, ' ', '')))))"""
_PARAS = f"""{_BLOCKS}, {_KEPT}, med AS (SELECT doc_id, 0.6::DOUBLE * list_sort(list(length(line)))[len(list(line)) // 2 + 1] AS full_width FROM kept WHERE line <> '' GROUP BY doc_id),
  b AS (SELECT *, sum((line = '')::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM kept),
  bl AS (SELECT doc_id, block, min(pos) AS pos, arg_min(line, pos) AS first_line, arg_max(line, pos) AS last_line FROM b WHERE line <> '' GROUP BY doc_id, block),
  lg AS (SELECT *, lag(last_line) OVER (PARTITION BY doc_id ORDER BY block) AS prev FROM bl JOIN med USING (doc_id)),
  st AS (SELECT *, sum(CASE WHEN prev IS NULL OR NOT (ends_with(prev, '-') OR regexp_matches(substr(first_line, 1, 1), '^[\\p{{Ll}}ªº]$') OR (length(prev) >= full_width AND NOT contains('{_TERMINAL}', right(prev, 1)))) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block) AS para FROM lg),
  pl AS (SELECT b.doc_id, para, b.pos, line, lead(line) OVER (PARTITION BY b.doc_id, para ORDER BY b.pos) AS nxt FROM b JOIN st USING (doc_id, block) WHERE line <> ''),
  paras AS (SELECT doc_id, para, string_agg(CASE WHEN nxt IS NULL THEN line WHEN regexp_matches(line, '\\p{{L}}-$') AND regexp_matches(substr(nxt, 1, 1), '^[\\p{{Ll}}ªº]$') THEN substr(line, 1, length(line) - 1) ELSE line || ' ' END, '' ORDER BY pos) AS text FROM pl GROUP BY doc_id, para)"""


@query(f"WITH {_PARAS} SELECT doc_id, full_width FROM med")
def median_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_lines(lines.split_lines(_blocks(spark, sf_dir)))
    return lines.full_width(kept).withColumnRenamed("full", "full_width")


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.paragraphs(lines.drop_lines(lines.split_lines(_blocks(spark, sf_dir))))


@query(f"WITH {_PARAS} SELECT doc_id, CAST(para AS BIGINT) AS para, text FROM paras")
def reflow_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paragraphs(spark, sf_dir)


_EDGE = lines.BOILERPLATE.replace("(?iuU)", "(?i)").replace("'", "''")


@query(f"""WITH {_PARAS}, e AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY para ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(length(text)) OVER (PARTITION BY doc_id) AS total FROM paras)
  SELECT doc_id, CAST(para AS BIGINT) AS para FROM e WHERE NOT ((before < 0.1::DOUBLE * total OR before > 0.97::DOUBLE * total) AND length(text) < 800 AND regexp_matches(text, '{_EDGE}'))""")
def edge_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(_paragraphs(spark, sf_dir)).select("doc_id", "para")


@query("""SELECT doc_id, '<doc>' || chr(10) || '<metadata>' || chr(10) || '<title>Ta b' || doc_id || '</title>' || chr(10) || '<author>' || source || '</author>' || chr(10) || '<isbn>' || doc_id || '</isbn>' || chr(10) || '<language>' || 'xx' || '</language>' ||
  CASE WHEN doc_id % 2 = 0 THEN chr(10) || '<license>open</license>' ELSE '' END || chr(10) || '</metadata>' || chr(10) || '<content>' || chr(10) || text || chr(10) || '</content>' || chr(10) || '</doc>' || chr(10) AS record FROM documents""")
def doc_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    extra = {"source": F.lit(""), "license": F.when(F.col("doc_id") % 2 == 0, "open")}
    return spread(table(spark, sf_dir, "documents")).select("doc_id", records.wrap_record(F.col("text"), F.concat(F.lit(" T<a> b"), k), F.col("source"), k, "xx", extra).alias("record"))


@query("""SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN 'i' || doc_id WHEN doc_id % 3 = 1 THEN 'j' || doc_id END AS isbn, CASE WHEN text IS NOT NULL AND doc_id % 3 = 1 THEN 'cc' END AS license, text AS body FROM documents""")
def record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spread(table(spark, sf_dir, "documents")))


def _split(docs: DataFrame) -> DataFrame:
    k = F.col("doc_id").cast("string")
    wrapped = records.wrap_record(F.lit(""), F.lit("t"), F.lit("a"), F.concat(F.lit("i"), k), "xx")
    whole = F.concat(F.substring_index(wrapped, "\n\n</content>", 1), F.col("text"), F.lit("</content>\n</doc>\n"))
    whole = F.replace(whole, F.lit("<content>\n"), F.lit("<content>"))
    plain = F.concat(F.lit("Title: t\nISBN: j"), k, F.lit("\nLicence: cc\n\n"), "text")
    raw = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace(whole, "<content>\n?", "<content>")).when(F.col("doc_id") % 3 == 1, plain).otherwise(F.col("text"))
    return docs.select("doc_id", records.split_record(raw).alias("r")).select("doc_id", F.try_element_at("r.meta", F.lit("isbn")).alias("isbn"), F.try_element_at("r.meta", F.lit("license")).alias("license"), "r.body")


@query("""WITH p AS (SELECT doc_id, source || '/' || doc_id // 3 AS path FROM documents) SELECT doc_id, path, CASE WHEN f <> doc_id THEN f END AS kept FROM (SELECT *, min(doc_id) OVER (PARTITION BY path) AS f FROM p)""")
def one_copy_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 3).cast("string")).alias("path"))
    return records.one_copy(docs.withColumn("n", F.col("doc_id")), "path", "n", "doc_id").select("doc_id", "path", "kept")


#: All texts, and those of 1,000 to 1,500 characters forty times over, which are long enough to be sampled.
_LONG = r"""long_doc AS (SELECT 'long' || doc_id AS id, trim(regexp_replace(repeat(text || ' ', 40), '\s+', ' ', 'g'), ' ') AS t FROM documents WHERE length(text) BETWEEN 1000 AND 1500 UNION ALL SELECT 'doc' || doc_id, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') FROM documents),
  plan AS (SELECT id AS doc_id, t, CASE WHEN length(t) <= 36000 THEN (length(t) + 1499) // 1500 ELSE 24 END AS n, CASE WHEN length(t) <= 36000 THEN 1500 ELSE (length(t) - 1500) // 23 END AS step FROM long_doc)"""


@query(f"WITH {_LONG} SELECT doc_id, chunk, substr(t, chunk * step + 1, 1500) AS part FROM (SELECT *, unnest(range(0, n)) AS chunk FROM plan)")
def lid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    whole = docs.where(F.length("text").between(1000, 1500)).select(F.concat(F.lit("long"), F.col("doc_id").cast("string")).alias("doc_id"), F.repeat(F.concat("text", F.lit(" ")), F.lit(40)).alias("text"))
    single = docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    return lid.chunks(whole.unionByName(single)).select("doc_id", F.col("chunk").cast("long"), "part")


_VOTES = f"""v AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'tr' ELSE lang END AS lang, {_LETTERS.format(x="text")} AS n, 0.5 + (doc_id % 5) / 10.0 AS prob, text FROM documents),
  two AS (SELECT doc_id, lang, n * prob::DOUBLE AS w FROM v WHERE n >= 100 UNION ALL SELECT doc_id, 'xx', n * 0.25::DOUBLE FROM v WHERE n >= 100), s AS (SELECT doc_id, lang, sum(w) AS w FROM two GROUP BY ALL),
  shares AS (SELECT doc_id, lang, w / sum(w) OVER (PARTITION BY doc_id) AS share FROM s)"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", F.col("text").alias("part"), F.when(F.col("doc_id") % 4 == 0, "tr").otherwise(F.col("lang")).alias("lang"), (F.lit(0.5) + (F.col("doc_id") % 5) / 10).alias("prob"))
    return docs.unionByName(docs.withColumns({"lang": F.lit("xx"), "prob": F.lit(0.25)}))


@query(f"WITH {_VOTES} SELECT doc_id, lang, round(share, 9) AS share FROM shares")
def lid_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lid.vote(_labelled(spark, sf_dir)).select("doc_id", "lang", F.round("share", 9).alias("share"))


@query(f"""WITH {_VOTES} SELECT d.doc_id, CASE WHEN coalesce(max(share) FILTER (shares.lang = 'en') >= 0.5, false) THEN 'keep' ELSE 'cull' END AS decision FROM documents d LEFT JOIN shares USING (doc_id) GROUP BY d.doc_id""")
def lang_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return lid.audit(docs, lid.vote(_labelled(spark, sf_dir)), "en").select("doc_id", "decision")


@query(r"""SELECT doc_id FROM documents WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 500""")
def min_length_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).where(audit.long_enough(F.col("text"))).select("doc_id")


@query()
def lid_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier of the corpus's own languages, then chunks, labels, vote and decision."""
    docs = spread(table(spark, sf_dir, "documents"))
    return lid.audit(docs, lid.vote(langid.label(lid.chunks(docs), langid.train(docs))), "en")


@query()
def profile_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with trigram profiles in place of the classifier."""
    docs = spread(table(spark, sf_dir, "documents"))
    return lid.audit(docs, lid.vote(lid.label(lid.chunks(docs), lid.profiles(docs))), "en")


@query()
def labelled_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole audit of files, with the shares that the classifier finds in them."""
    files, catalog, done = _files(spark, sf_dir)
    files = files.select("path", "raw")
    shares = checkpointed(audit.language_shares(files, langid.train(spread(table(spark, sf_dir, "documents")))))
    kept, culled, _ = audit.audit_files(files, catalog, done, shares, "en")
    return kept.select("path", "isbn", F.lit("completed").alias("status")).unionByName(culled.select("path", "isbn", F.lit("culled").alias("status")))


#: Character repair and markup for texts that need neither re-decoding nor more than the finite map of entities.
_FIXED = f"""doc_blocks AS (SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(CASE WHEN len(regexp_extract_all(substr(t, 1, 200000), '{_TAG}')) > 20 THEN regexp_replace(regexp_replace(t,
    '(?i)<br\\s*/?>|</(?:p|div|h[0-9]|li|tr)>', chr(10), 'g'), '{_TAG}', ' ', 'g') ELSE t END, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS text
  FROM (SELECT doc_id, regexp_replace(replace(replace(replace(translate(coalesce(text, ''), '­​‌‍‎‏⁠﻿￼', ''), chr(12), chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f]', '', 'g') AS t FROM documents))"""
_BODIES = f"""{_PARAS.replace(_BLOCKS, _FIXED)}, e AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY para ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(length(text)) OVER (PARTITION BY doc_id) AS total FROM paras),
  bodies AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY para) AS body FROM e WHERE text <> '' AND NOT ((before < 0.1::DOUBLE * total OR before > 0.97::DOUBLE * total) AND length(text) < 800 AND regexp_matches(text, '{_EDGE}')) GROUP BY doc_id)"""


@query(f"WITH {_BODIES} SELECT doc_id, replace(replace(coalesce(body, ''), '</content>', ''), '</doc>', '') AS body FROM documents LEFT JOIN bodies USING (doc_id)")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.clean(_documents(spark, sf_dir))


_WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(173), ''), '({_WORD})-\n\s*({_WORD})', '\1\2', 'g'),
  '(?m)^\s*[0-9]{{1,4}}\s*$', '', 'g'), '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+', ''), '\s+$', '') || chr(10) AS text FROM documents""")
def first_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", X.first_clean(F.col("text")).alias("text"))


#: Files made of the documents: wrapped, headed and plain ones by turns; a catalog of half of them; a ledger of a fifth.
_CODE = "'978' || lpad(CAST(doc_id AS VARCHAR), 9, '0')"
_FILES = f"""base AS (SELECT *, {_CODE} AS first12 FROM documents), coded AS (SELECT *, first12 || {CHECK_SQL.format(x="first12")} AS code FROM base),
  meta AS (SELECT doc_id, 'lib/' || source || '/book' || doc_id || '.txt' AS path, CASE WHEN doc_id % 3 = 2 THEN '' ELSE code END AS isbn, doc_id % 3 <> 2 AND doc_id % 2 = 0 AS known,
    CASE WHEN doc_id % 3 <> 2 AND doc_id % 2 = 0 THEN 'T' || doc_id WHEN doc_id % 3 = 0 THEN 'W' || doc_id WHEN doc_id % 3 = 1 THEN 'H' || doc_id ELSE 'book' || doc_id END AS title,
    CASE WHEN doc_id % 3 <> 2 AND doc_id % 2 = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'someone' ELSE source END AS author FROM coded)"""


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(path, raw, doc_id), the catalog and the ledger."""
    k = F.col("doc_id")
    first = F.concat(F.lit("978"), F.lpad(k.cast("string"), 9, "0"))
    docs = spread(table(spark, sf_dir, "documents")).where("text is not null").withColumn("code", F.concat(first, I.check_digit13(first)))
    s = k.cast("string")
    wrapped = records.wrap_record(F.col("text"), F.concat(F.lit("W"), s), F.lit("someone"), F.col("code"), "xx")
    raw = F.when(k % 3 == 0, wrapped).when(k % 3 == 1, F.concat(F.lit("Title: H"), s, F.lit("\nISBN: "), F.col("code"), F.lit("\n\n"), "text")).otherwise(F.col("text"))
    files = docs.select(F.concat(F.lit("lib/"), "source", F.lit("/book"), s, F.lit(".txt")).alias("path"), raw.alias("raw"), "doc_id")
    catalog = docs.where(k % 2 == 0).select(F.col("code").alias("ISBN"), F.concat(F.lit("T"), s).alias("Title"), F.lit("").alias("Author"))
    return files, catalog, docs.where(k % 5 == 0).select(F.col("code").alias("key"), F.lit("completed").alias("status"))


@query(f"WITH {_FILES} SELECT path, isbn, title, author, known FROM meta JOIN documents USING (doc_id) WHERE text IS NOT NULL")
def metadata_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, catalog, _ = _files(spark, sf_dir)
    return audit.with_metadata(files.select("path", "raw"), catalog).select("path", "isbn", "title", "author", "known")


@query(f"""WITH {_VOTES}, {_FILES}, d AS (SELECT doc_id, coalesce(max(share) FILTER (shares.lang = 'en') >= 0.5, false) AS keep FROM documents LEFT JOIN shares USING (doc_id) GROUP BY doc_id)
  SELECT path, isbn, CASE WHEN keep THEN 'completed' ELSE 'culled' END AS status, title, author, isbn <> '' AS in_ledger FROM meta JOIN d USING (doc_id) JOIN documents USING (doc_id) WHERE text IS NOT NULL AND NOT (doc_id % 3 = 0 AND doc_id % 5 = 0)""")
def audit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files kept and culled, with the metadata of the record or of the culled row, and whether the ledger has them."""
    files, catalog, done = _files(spark, sf_dir)
    paths = files.select("doc_id", "path")
    shares = lid.vote(_labelled(spark, sf_dir)).join(paths, "doc_id").select(F.col("path").alias("doc_id"), "lang", "share")
    kept, culled, entries = audit.audit_files(files.select("path", "raw"), catalog, done, shares, "en")
    own = records.split_record(F.col("record"))
    kept = kept.withColumn("m", own.meta).select("path", "isbn", F.lit("completed").alias("status"), F.element_at("m", F.lit("title")).alias("title"), F.element_at("m", F.lit("author")).alias("author"))
    rows = kept.unionByName(culled.select("path", "isbn", F.lit("culled").alias("status"), "title", "author"))
    noted = entries.select("path", "status", F.lit(True).alias("noted"))
    return rows.join(noted, ["path", "status"], "left").withColumn("in_ledger", F.coalesce("noted", F.lit(False))).drop("noted")


@query(f"""WITH {_VOTES}, {_BODIES}, d AS (SELECT doc_id, coalesce(max(share) FILTER (shares.lang = 'en') >= 0.5, false) AS keep FROM documents LEFT JOIN shares USING (doc_id) GROUP BY doc_id),
  r AS (SELECT doc_id AS key, source || '/' || doc_id // 4 AS path, keep, replace(replace(coalesce(body, ''), '</content>', ''), '</doc>', '') AS body FROM documents JOIN d USING (doc_id) LEFT JOIN bodies USING (doc_id)),
  f AS (SELECT path, min(key) AS least FROM r WHERE keep AND length(body) >= 500 GROUP BY path)
  SELECT key, path, CASE WHEN NOT keep THEN 'culled' WHEN length(body) < 500 THEN 'no usable text' ELSE 'completed' END AS status, keep AND length(body) >= 500 AND least <> key AS copy, CASE WHEN keep AND length(body) >= 500 AND least = key THEN length(body) END AS written
  FROM r LEFT JOIN f USING (path)""")
def download_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 4).cast("string"))
    found = docs.select(F.col("doc_id").alias("key"), path.alias("path"), F.lit("web").alias("source"), F.col("text").alias("raw"))
    out = audit.save_downloads(found, lid.vote(_labelled(spark, sf_dir)), "en")
    return out.select("key", "path", "status", F.contains("detail", F.lit("one copy kept")).alias("copy"), F.length("body").cast("long").alias("written"))


@query(f"""WITH {_VOTES}, {_BODIES}, d AS (SELECT doc_id, coalesce(max(share) FILTER (shares.lang = 'en') >= 0.5, false) AS keep FROM documents LEFT JOIN shares USING (doc_id) GROUP BY doc_id),
  r AS (SELECT doc_id AS key, source || '/' || doc_id // 4 || '.txt' AS path, doc_id % 2 AS run, keep AND length(replace(replace(coalesce(body, ''), '</content>', ''), '</doc>', '')) >= 500 AS good FROM documents JOIN d USING (doc_id) LEFT JOIN bodies USING (doc_id)),
  o AS (SELECT path, arg_min(key, run * 1000000000 + key) AS own FROM r WHERE good GROUP BY path)
  SELECT key, path, own <> key AS copy, own = key AS there, own FROM r JOIN o USING (path) WHERE good""")
def saved_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts saved in a tree by two runs, the second beside the files of the first: whose file is at each path in the end."""
    root = delete_at_end(spark, f"{shared_dir(spark)}/tree-{uuid.uuid4().hex}")
    docs, shares = spread(table(spark, sf_dir, "documents")), checkpointed(lid.vote(_labelled(spark, sf_dir)))
    path, key = F.concat_ws("/", "source", F.concat(F.floor(F.col("doc_id") / 4).cast("string"), F.lit(".txt"))), F.col("doc_id")
    found = docs.select(key.alias("key"), path.alias("path"), F.lit("web").alias("source"), F.lit("t").alias("title"), F.lit("a").alias("author"), F.col("text").alias("raw"))
    done = []
    for run in (0, 1):
        out = checkpointed(audit.save_downloads(found.where(F.col("key") % 2 == run), shares, "en", earlier=checkpointed(saved(spark, root))))
        write_tree(out, root)
        done.append(out.where("status = 'completed'").select("key", "path", F.contains("detail", F.lit("one copy kept")).alias("copy"), F.col("record").isNotNull().alias("there")))
    owner = saved(spark, root).select("path", F.col("isbn").cast("long").alias("own"))
    return done[0].unionByName(done[1]).join(owner, "path", "left")


@query("SELECT doc_id, text FROM documents")
def mojibake_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose UTF-8 was read as Latin-1 once or twice, or not at all, and the search's repair of them."""
    docs = spread(table(spark, sf_dir, "documents"))
    misread = lambda t: F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")
    key, text = F.col("doc_id"), F.col("text")
    damaged = docs.select("doc_id", F.when(key % 3 == 0, misread(text)).when(key % 3 == 1, misread(misread(text))).otherwise(text).alias("text"))
    return damaged.select("doc_id", mojibake.repairer(mojibake.bigrams(docs))(text).alias("text"))
