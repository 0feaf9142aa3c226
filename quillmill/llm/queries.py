"""The registered queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, importance, jaccard_join, packing, pii, prefix_trie, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_counts, toxicity, warc
from quillmill.llm.store import read_table, written


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = token_counts.Vocabulary.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), vocabulary)


#: Pseudonyms of the registered queries; production runs pass a secret of their own.
PII_KEY = "quillmill-demonstration-key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count_col="n_replaced")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = jaccard_join.jaccard_components(docs)
    near = written(found.groupBy("doc_id").agg(F.min("component_id").alias("cluster")), "clusters", found)
    return written(packing.pack(docs, clusters=near), "packed_bins", near)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(read_table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_warc": op12_warc,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": pipeline,
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_ASCII = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = (
    "CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"
    " WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
)


def shingles_sql(table: str, key: str) -> str:
    """Rows (key, s): the distinct shingle sets of a table's texts."""
    words = _WORDS.format(text=_ASCII.format(text="text"))
    return f"SELECT {key}, {_SHINGLES} AS s FROM (SELECT {key}, {words} AS w FROM {table})"


#: Half the sum of p log2(p / m) and q log2(q / m) over rows (p, q), as a distance.
_JS = "sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))"
_QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
     g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
     r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS times FROM g) WHERE times > 1),
     rw AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, (SELECT unnest(range(0, 5)) AS j) GROUP BY doc_id),
     l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, length(text) AS chars, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS solid,
       length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digit, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS symbol FROM d),
     f AS (SELECT doc_id, lang, w, len(w) AS n_words, solid AS word_chars, symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
       len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed, [lower, upper, digit, chars - solid, symbol, solid - lower - upper - digit - symbol] AS classes FROM l LEFT JOIN rw USING (doc_id)),
     cnt AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM d) GROUP BY ALL),
     tot AS (SELECT lang, sum(n) AS total FROM cnt GROUP BY lang HAVING sum(n) >= {quality_rules.MIN_REFERENCE}),
     com AS (SELECT lang, word, n / total AS q FROM cnt JOIN tot USING (lang) WHERE n >= {quality_rules.COMMON}::DOUBLE * total),
     judged AS (SELECT f.* FROM f JOIN tot USING (lang) WHERE NOT base_failed AND n_words >= {quality_rules.MIN_WORDS}),
     dc AS (SELECT doc_id, word, count(*) AS c FROM (SELECT doc_id, unnest(w) AS word FROM judged) GROUP BY ALL),
     pq AS (SELECT doc_id, coalesce(c, 0) / n_words AS p, q FROM judged JOIN com USING (lang) LEFT JOIN dc USING (doc_id, word)),
     rest AS (SELECT doc_id, greatest(0, 1 - coalesce(sum(p), 0)) AS p, greatest(0, 1 - coalesce(sum(q), 0)) AS q FROM judged LEFT JOIN pq USING (doc_id) GROUP BY doc_id),
     wd AS (SELECT doc_id, {_JS} AS word_distance FROM (SELECT * FROM pq UNION ALL SELECT * FROM rest) GROUP BY doc_id),
     cl AS (SELECT doc_id, lang, unnest(classes) AS v, unnest(range(0, 6)) AS k FROM f),
     ref AS (SELECT lang, k, sum(v) / sum(sum(v)) OVER (PARTITION BY lang) AS q FROM cl GROUP BY lang, k),
     cd AS (SELECT doc_id, {_JS} AS class_distance FROM (SELECT doc_id, v / sum(v) OVER (PARTITION BY doc_id) AS p, q FROM cl JOIN judged USING (doc_id) JOIN ref ON ref.lang = cl.lang AND ref.k = cl.k) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(class_distance > {quality_rules.CLASS_LIMIT}::DOUBLE OR word_distance > {quality_rules.WORD_LIMIT}::DOUBLE, false) AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM f LEFT JOIN wd USING (doc_id) LEFT JOIN cd USING (doc_id)"""

#: The byte table of CRC-32, and the CRC-32 of a text's UTF-8 bytes; crc.t is the table.
_CRC_TABLE = "crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(0, 256)) AS i))"
_CRC = "xor(4294967295, list_reduce(list_transform(range(1, octet_length(encode({x})) + 1), lambda i: ('0x' || substr(hex(encode({x})), 2 * i - 1, 2))::BIGINT), lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))"

_TRIE = f"""
WITH {_CRC_TABLE},
     v AS (SELECT conv_id, turn, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
     own AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, x) AS turns FROM v GROUP BY conv_id),
     h AS (SELECT conv_id, turns, conv_id - conv_id % 100 AS base, {_CRC.format(x="conv_id::VARCHAR")} % 6 AS h FROM own, crc),
     c AS (SELECT h.conv_id, coalesce(b.turns[1:h], []) || h.turns[h + 1:] AS turns FROM h LEFT JOIN own b ON b.conv_id = h.base),
     p AS (SELECT conv_id, size, depth, turns[1:depth] AS path, CASE WHEN depth = 0 THEN 0 ELSE length(turns[depth].t) END AS chars FROM (SELECT conv_id, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth, turns FROM c)),
     n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends, (count(*) - 1) * max(chars) AS own_saved FROM p GROUP BY path, depth),
     k AS (SELECT path[1:depth - 1] AS over, depth - 1 AS over_depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
     f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON over = path AND over_depth = depth),
     up AS (SELECT path[1:d] AS path, d AS depth, own_saved, n_children = 0 AS leaf FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM f)),
     s AS (SELECT path, depth, sum(own_saved)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY ALL)
SELECT f.conv_id, f.depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s ON s.path = f.path AND s.depth = f.depth LEFT JOIN f o ON f.depth > 0 AND o.depth = f.depth - 1 AND o.path = f.path[1:f.depth - 1]"""

_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     d AS (SELECT page_id, octet_length(b) AS size, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS least FROM p),
     e AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, i // 8 * 10 + 1, 10))::BIGINT >> (35 - i % 8 * 5)) & 31)::INT + 1, 1)), '') AS digest FROM d)
SELECT page_id, size AS payload_bytes, digest AS payload_digest, CASE WHEN page_id IS DISTINCT FROM least AND least IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to FROM e"""

_RESAMPLE = f"""
WITH {_CRC_TABLE},
     w AS (SELECT doc_id, regexp_extract_all({_ASCII.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     bw AS (SELECT unnest(regexp_extract_all({_ASCII.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
     dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM w) GROUP BY ALL),
     b AS (SELECT word, {_CRC.format(x="word")} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc),
     s AS (SELECT bucket, sum(n) AS s FROM dw JOIN b USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bw JOIN b USING (word) GROUP BY bucket),
     tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS big, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS small),
     g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big + 10000) / ((s + 1)::DOUBLE * (small + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), tot),
     x AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM dw JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id),
     y AS (SELECT w.doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('2024:' || w.doc_id), 1, 8))::BIGINT AS h FROM w LEFT JOIN x USING (doc_id)),
     z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM y),
     r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM r"""

ORACLE = {
    "op5_quality_rules": _QUALITY,
    "op11_conversation_trie": _TRIE,
    "op12_warc": _WARC,
    "op13_importance_resampling": _RESAMPLE,
    "op1_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
     x AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
     r AS (SELECT s FROM x GROUP BY s HAVING count(*) > 1),
     c AS (SELECT DISTINCT doc_id, i + j AS pos FROM (SELECT doc_id, i FROM x SEMI JOIN r USING (s)), (SELECT unnest(range(0, 35)) AS j)),
     v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
     k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM v ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op10_jaccard_join": f"""
WITH RECURSIVE d AS ({shingles_sql("documents", "doc_id")}),
     g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM d),
     p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
     reach AS (SELECT x, y FROM p UNION SELECT reach.x, p.y FROM reach JOIN p ON reach.y = p.x)
SELECT d.doc_id, len(s) AS n_shingles, least(d.doc_id, coalesce(min(y), d.doc_id)) AS component_id FROM d LEFT JOIN reach ON d.doc_id = x GROUP BY d.doc_id, s""",
    "op4_decontamination": f"""
WITH d AS ({shingles_sql("documents", "doc_id")}), b AS ({shingles_sql("benchmark", "item_id")}),
     dx AS (SELECT doc_id, unnest(s) AS g FROM d), bx AS (SELECT item_id, len(s) AS n, unnest(s) AS g FROM b),
     c AS (SELECT doc_id, item_id, n, count(*) AS shared FROM dx JOIN bx USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n AS item_shingles, shared AS shared_shingles, shared::DOUBLE / n AS containment
FROM c WHERE 100 * shared >= 75 * n""",
}
