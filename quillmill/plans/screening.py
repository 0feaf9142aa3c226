"""Queries over rule screening, with a neutral vocabulary drawn from the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import report, rules, screening
from quillmill.plans.base import CATALOG_SQL, CHECK_SQL, catalog, query, spread, table

#: Rules over part names, types and brands; what they look for has no meaning beyond these tables.
RULES = rules.RuleSet(
    categories=["metal", "shape", "finish", "range"],
    text=[
        {"category": "metal", "confidence": "high", "scope": "all", "pattern": "steel", "exempt": None, "label": "steel"},
        {"category": "metal", "confidence": "review", "scope": "title", "pattern": "brass|tin", "exempt": "brush", "label": "soft metal"},
        {"category": "shape", "confidence": "high", "scope": "all", "pattern": "large [a-z]+", "exempt": "plated", "label": "large"},
        {"category": "finish", "confidence": "review", "scope": "all", "pattern": "polish(ed)?", "exempt": None, "label": "polished"},
    ],
    subject=[{"category": "finish", "pattern": "anodi", "exempt": "economy", "label": "subject anodized"}, {"category": "metal", "pattern": "^copper", "exempt": None, "label": "subject copper"}],
    author=[
        {"category": "shape", "pattern": "brand#1[0-9]", "require": "economy", "skip_otherwise": False, "label": "author ten"},
        {"category": "finish", "pattern": "brand#2[0-9]", "require": "burnish", "skip_otherwise": True, "label": "author twenty"},
        {"category": "metal", "pattern": "brand#33", "require": None, "skip_otherwise": False, "label": "author thirty"},
    ],
    author_high={"author ten", "author thirty"},
    ranges=[
        {"letters": "ab", "low": 10, "high": 20, "category": "range", "confidence": "high", "label": "inner"},
        {"letters": "ab", "low": 1, "high": 40, "category": "range", "confidence": "review", "label": "outer"},
    ],
    prefixes=[{"prefix": "13", "category": "range", "confidence": "high", "label": "thirteen"}, {"prefix": "133", "category": "range", "confidence": "review", "label": "one three three"}],
    exempt_authors="brand#4[0-9]",
    exempt_categories=("metal",),
    context_category="finish",
    fiction="small",
    scholarly="medium",
)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalog rows: words of the type as title, subjects and description."""
    k, kind = F.col("p_partkey"), F.col("p_type")
    return spread(table(spark, sf_dir, "part")).select(
        "p_partkey",
        F.when(k % 10 == 0, "").otherwise(kind).alias("title"),
        F.concat(F.split_part(kind, F.lit(" "), F.lit(2)), F.lit("; "), F.split_part(kind, F.lit(" "), F.lit(3))).alias("subjects"),
        F.when(k % 3 == 0, F.concat(kind, F.lit(" part"))).otherwise("").alias("description"),
        F.col("p_brand").alias("authors"),
        F.when(k % 4 == 0, F.concat(F.lit("AB"), F.col("p_size").cast("string"), F.lit(";zz"))).otherwise("").alias("lcc"),
        F.when(k % 5 == 0, F.concat(F.lit("13/"), (k % 10).cast("string"))).otherwise("").alias("dewey"),
    )


_ROWS = """r AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE lower(p_type) END || ' |  | ' AS title, ' | ' || lower(split_part(p_type, ' ', 2) || '; ' || split_part(p_type, ' ', 3)) || ' |  |  | ' AS meta,
  CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) || ' part' ELSE '' END AS descr, lower(p_brand) AS authors, [lower(split_part(p_type, ' ', 2)), lower(split_part(p_type, ' ', 3))] AS subjects,
  CASE WHEN p_partkey % 4 = 0 THEN p_size END AS num, CASE WHEN p_partkey % 5 = 0 THEN '13' || (p_partkey % 10) END AS code, p_partkey % 10 = 0 AS untitled FROM part),
e AS (SELECT *, title || ' | ' || meta || ' | ' || descr AS everything, title || ' | ' || meta AS topic FROM r),
f AS (SELECT *, 'title' AS field, title AS t, 0 AS fo FROM e UNION ALL SELECT *, 'subjects/genres', meta, 1 FROM e UNION ALL SELECT *, 'description', descr, 2 FROM e),
tr(category, confidence, scope, pattern, exempt, label, ro) AS (VALUES ('metal', 'high', 'all', 'steel', NULL, 'steel', 0), ('metal', 'review', 'title', 'brass|tin', 'brush', 'soft metal', 1),
  ('shape', 'high', 'all', 'large [a-z]+', 'plated', 'large', 2), ('finish', 'review', 'all', 'polish(ed)?', NULL, 'polished', 3)),
sr(category, pattern, exempt, label, ro) AS (VALUES ('finish', 'anodi', 'economy', 'subject anodized', 0), ('metal', '^copper', NULL, 'subject copper', 1)),
ar(category, pattern, req, skip, high, label, ro) AS (VALUES ('shape', 'brand#1[0-9]', 'economy', false, true, 'author ten', 0), ('finish', 'brand#2[0-9]', 'burnish', true, false, 'author twenty', 1), ('metal', 'brand#33', NULL, false, true, 'author thirty', 2)),
raw AS (
  SELECT p_partkey, category, CASE WHEN field = 'title' THEN confidence ELSE 'review' END AS confidence, label, regexp_extract(t, pattern, 0) AS matched, field, fo * 100 + ro AS ord, authors, topic
    FROM f, tr WHERE regexp_matches(t, pattern) AND (scope <> 'title' OR field = 'title') AND NOT coalesce(regexp_matches(everything, exempt), false)
  UNION ALL SELECT p_partkey, category, 'review', label, s, 'subjects', 1000 + so * 10 + ro, authors, topic FROM (SELECT *, unnest(subjects) AS s, unnest(range(0, 2)) AS so FROM e), sr
    WHERE regexp_matches(s, pattern) AND NOT coalesce(regexp_matches(everything, exempt), false)
  UNION ALL SELECT p_partkey, category, CASE WHEN high AND (req IS NULL OR regexp_matches(topic, req)) THEN 'high' ELSE 'review' END, label, regexp_extract(authors, pattern, 0), 'authors', 2000 + ro, authors, topic FROM e, ar
    WHERE regexp_matches(authors, pattern) AND (NOT skip OR req IS NULL OR regexp_matches(topic, req))
  UNION ALL SELECT p_partkey, 'range', CASE WHEN num BETWEEN 10 AND 20 THEN 'high' ELSE 'review' END, CASE WHEN num BETWEEN 10 AND 20 THEN 'inner' ELSE 'outer' END, 'ab' || num, 'lcc', 3000, authors, topic FROM e WHERE num BETWEEN 1 AND 40
  UNION ALL SELECT p_partkey, 'range', 'high', 'thirteen', code, 'dewey', 4000, authors, topic FROM e WHERE starts_with(code, '13')
  UNION ALL SELECT p_partkey, 'range', 'review', 'one three three', code, 'dewey', 4001, authors, topic FROM e WHERE starts_with(code, '133')),
hits AS (SELECT p_partkey, category, CASE WHEN category = 'finish' AND NOT starts_with(label, 'author') AND regexp_matches(topic, 'small') THEN 'review' ELSE confidence END AS confidence, label, matched, field, ord FROM raw
  WHERE NOT (regexp_matches(authors, 'brand#4[0-9]') AND category = 'metal') AND NOT (category = 'finish' AND NOT starts_with(label, 'author') AND confidence = 'review' AND regexp_matches(topic, 'medium')))"""


def _screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.screen(_rows(spark, sf_dir), RULES)


@query(f"WITH {_ROWS} SELECT p_partkey, category, confidence, label, matched, field, row_number() OVER (PARTITION BY p_partkey ORDER BY ord) AS place FROM hits")
def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _screened(spark, sf_dir).select("p_partkey", F.posexplode("hits").alias("pos", "h"))
    return found.select("p_partkey", "h.category", "h.confidence", "h.label", "h.matched", "h.field", (F.col("pos") + 1).cast("long").alias("place"))


_RESOLVED = f"""{_ROWS}, c AS (SELECT *, confidence <> 'high' AS a, list_position(['metal', 'shape', 'finish', 'range'], category) AS b, category || ': ' || label || ' (''' || matched || ''' in ' || field || ')' AS note FROM hits),
  n AS (SELECT p_partkey, note, min((a::INT) * 1000000 + b * 100000 + ord) AS o FROM c GROUP BY ALL),
  four AS (SELECT p_partkey, string_agg(note, ' | ' ORDER BY o) AS reason FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY o) AS rn FROM n) WHERE rn <= 4 GROUP BY p_partkey),
  head AS (SELECT p_partkey, arg_min(category, (a::INT) * 1000000 + b * 100000 + ord) AS category, arg_min(confidence, (a::INT) * 1000000 + b * 100000 + ord) AS confidence,
    substr(array_to_string(list_sort(list(DISTINCT matched)), '; '), 1, 300) AS terms FROM c GROUP BY p_partkey),
  resolved AS (SELECT r.p_partkey, coalesce(head.category, CASE WHEN untitled THEN 'no_metadata' END) AS elim_category, coalesce(head.confidence, CASE WHEN untitled THEN 'n/a' END) AS confidence,
    coalesce(reason, CASE WHEN untitled THEN 'No title or metadata found; cannot be screened' END) AS elim_reason, coalesce(terms, CASE WHEN untitled THEN '' END) AS matched_terms
    FROM r LEFT JOIN head USING (p_partkey) LEFT JOIN four USING (p_partkey))"""


@query(f"WITH {_RESOLVED} SELECT * FROM resolved")
def rule_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.resolve(_screened(spark, sf_dir), RULES).select("p_partkey", "elim_category", "confidence", "elim_reason", "matched_terms")


@query(f"""WITH {_RESOLVED} SELECT coalesce(elim_category, '') AS elim_category, coalesce(confidence, '') AS confidence, coalesce(elim_reason, '') AS elim_reason, count(*) AS rows, sum(l_quantity)::BIGINT AS quantity
  FROM lineitem JOIN resolved ON l_partkey = p_partkey GROUP BY ALL""")
def screened_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line screened as a catalog row of its part: as many rows as a large catalog has."""
    lines = spread(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")).join(_rows(spark, sf_dir), "p_partkey")
    rows = rules.resolve(rules.screen(lines, RULES), RULES)
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.groupBy(text("elim_category"), text("confidence"), text("elim_reason")).agg(F.count("*").alias("rows"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(f"WITH {_ROWS} SELECT label, count(*) AS hits FROM hits GROUP BY label")
def rule_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.histogram(_screened(spark, sf_dir))


@query(f"WITH {_RESOLVED} SELECT elim_category, confidence, count(*) AS rows FROM resolved WHERE elim_category IS NOT NULL GROUP BY ALL")
def category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_category(rules.resolve(_screened(spark, sf_dir), RULES))


_RUN = f"""{CATALOG_SQL}, {_RESOLVED},
  v AS (SELECT input_pos, isbn13, p_partkey, {CHECK_SQL.format(x="isbn13")} = CAST(substr(isbn13, 13, 1) AS INT) AS valid FROM catalog),
  k AS (SELECT *, row_number() OVER w AS rn, first_value(isbn13) OVER w AS keeper FROM v WINDOW w AS (PARTITION BY substr(isbn13, 1, 12) ORDER BY NOT valid, input_pos)),
  run AS (SELECT input_pos, isbn13, CASE WHEN rn > 1 THEN 'duplicate' WHEN NOT valid THEN 'invalid_isbn' ELSE elim_category END AS elim_category, CASE WHEN rn > 1 OR NOT valid THEN 'n/a' ELSE confidence END AS confidence,
    CASE WHEN rn > 1 AND keeper = isbn13 THEN 'Duplicate ISBN' WHEN rn > 1 THEN 'Duplicate of ISBN ' || keeper || ': same first 12 digits, this copy has a wrong check digit'
      WHEN NOT valid THEN 'Invalid ISBN-13 check digit (expected ' || {CHECK_SQL.format(x="isbn13")} || ')' ELSE elim_reason END AS elim_reason,
    CASE WHEN rn > 1 OR NOT valid THEN '' ELSE matched_terms END AS matched_terms FROM k JOIN resolved USING (p_partkey))"""


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog(spark, sf_dir).drop("title").join(_rows(spark, sf_dir), "p_partkey")
    return screening.classified_once(rows, RULES)


@query(f"WITH {_RUN} SELECT *, CASE WHEN elim_category IS NULL THEN 'cleaned' WHEN elim_category = 'no_metadata' THEN 'bare' ELSE 'eliminated' END AS output FROM run")
def screening_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, with the output that each row of the catalog goes to."""
    rows = _run(spark, sf_dir).select("input_pos", "isbn13", "elim_category", "confidence", "elim_reason", "matched_terms")
    names = ("cleaned", "eliminated", "bare")
    cleaned, eliminated, bare = (part.withColumn("output", F.lit(name)) for part, name in zip(screening.outputs(rows), names, strict=True))
    return cleaned.unionByName(eliminated).unionByName(bare)


@query("""SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 20 THEN 'inner' ELSE 'outer' END AS label, 'ab' || p_size || '.5 x' AS matched FROM part WHERE p_size < 40""")
def range_class_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.lit(" ab"), F.col("p_size").cast("string"), F.lit(".5 x"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.array(code, F.lit("c1"), F.lit("ab")).alias("codes"))
    own = rules.RuleSet(categories=["range"], ranges=[{"letters": "ab", "low": 10, "high": 20.5, "category": "range", "confidence": "high", "label": "inner"}, {"letters": "ab", "low": 1, "high": 40, "category": "range", "confidence": "review", "label": "outer"}])
    return part.select("p_partkey", F.explode(rules.range_hits(own, F.col("codes"))).alias("h")).select("p_partkey", "h.label", "h.matched")


@query("""SELECT p_partkey, label, matched FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) || 'x' AS matched FROM part), (VALUES ('1', 'one'), ('13', 'thirteen'), ('4', 'four')) v(prefix, label) WHERE starts_with(matched, prefix)""")
def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rules.RuleSet(categories=["range"], prefixes=[{"prefix": p, "category": "range", "confidence": "high", "label": x} for p, x in (("1", "one"), ("13", "thirteen"), ("4", "four"))])
    part = table(spark, sf_dir, "part").select("p_partkey", F.array(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("/x "))).alias("codes"))
    return part.select("p_partkey", F.explode(rules.prefix_hits(own, F.col("codes"))).alias("h")).select("p_partkey", "h.label", "h.matched")
