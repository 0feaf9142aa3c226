"""Queries over the work ledger and its derived lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import dedup, ledger, report
from quillmill.plans.base import query, table
from quillmill.session import shared_dir
from quillmill.sources.ledger_store import LedgerStore
from quillmill.sources.shared import delete_at_end

_LOG = "log AS (SELECT user_id AS key, event_type AS status, 'd' || event_id || ' for url: http://x/' || event_id AS detail, ts AS updated, event_id AS seq FROM events)"
_LATEST = f"{_LOG}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated DESC, seq DESC) AS rn FROM log) WHERE rn = 1)"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("status"), F.concat(F.lit("d"), e, F.lit(" for url: http://x/"), e).alias("detail"), F.col("ts").alias("updated"), F.col("event_id").alias("seq"))


@query(f"WITH {_LATEST} SELECT key, status, detail, seq FROM latest")
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(_log(spark, sf_dir), ["key"]).select("key", "status", "detail", "seq")


@query(f"WITH {_LATEST} SELECT key, status, detail, seq FROM latest")
def ledger_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, through a store: one log, a compaction, then another log that arrives out of order."""
    store = LedgerStore(spark, delete_at_end(spark, f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"), ["key"], buckets=32)
    log = _log(spark, sf_dir)
    store.append(log.where("seq % 3 <> 0"))
    store.compact()
    store.append(log.where("seq % 3 = 0"))
    return store.read().select("key", "status", "detail", "seq")


@query("""SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def anti_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "completed").otherwise("failed").alias("status"))
    return ledger.to_do(table(spark, sf_dir, "documents"), done, "doc_id").select("doc_id", "lang")


_ANSWERED = """needed AS (SELECT user_id AS key, 'click' AS source FROM events UNION SELECT user_id, 'view' FROM events UNION SELECT user_id, 'purchase' FROM events WHERE user_id % 2 = 0),
  answered AS (SELECT DISTINCT user_id AS key, event_type AS source FROM events WHERE event_id % 4 = 0),
  failed AS (SELECT DISTINCT user_id AS key FROM events WHERE event_type = 'error' AND event_id % 60 = 0), had AS (SELECT DISTINCT user_id AS key FROM events WHERE event_id % 211 = 0)"""


@query(f"""WITH {_ANSWERED} SELECT key FROM needed LEFT JOIN (SELECT *, 1 AS got FROM answered) USING (key, source) WHERE key NOT IN (SELECT key FROM failed) AND key NOT IN (SELECT key FROM had) GROUP BY key HAVING count(*) = count(got)""")
def settlement_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "key")
    need = e.select("key", F.explode(F.when(F.col("key") % 2 == 0, F.array(*map(F.lit, ("click", "view", "purchase")))).otherwise(F.array(*map(F.lit, ("click", "view"))))).alias("source"))
    answered = e.where("event_id % 4 = 0").select("key", F.col("event_type").alias("source"))
    return ledger.settle(need, answered, e.where("event_type = 'error' and event_id % 60 = 0"), e.where("event_id % 211 = 0"), "key")


@query("""WITH r AS (SELECT *, min((event_type = 'error')::INT) OVER w = 1 AND count(*) OVER w = 3 AS trip FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING))
  SELECT event_id, user_id, max(trip::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) = 1 AS down FROM r""")
def breaker_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.breaker(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "user_id", "down")


_WANTED = """books AS (SELECT c_custkey AS ISBN, c_name AS Title FROM customer),
  status AS (SELECT c_custkey AS ISBN, CASE c_custkey % 8 WHEN 0 THEN 'completed' WHEN 1 THEN 'lookup failed' WHEN 2 THEN 'no open copy' ELSE 'culled' END AS status, 'd' || c_custkey AS detail FROM customer WHERE c_custkey % 8 < 4
    UNION ALL SELECT c_custkey, 'no open copy', 'alpha: r' || c_custkey FROM customer WHERE c_custkey % 8 = 4),
  notes AS (SELECT c_custkey AS ISBN, 'old' AS status, 'n' || c_custkey AS detail FROM customer WHERE c_custkey % 3 = 0),
  miss AS (SELECT c_custkey AS ISBN, 'm' || c_custkey AS why FROM customer WHERE c_custkey % 5 = 1)"""


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    customer = table(spark, sf_dir, "customer")
    book = customer.where(k % 8 < 4).select(
        k.alias("ISBN"), F.when(k % 8 == 0, "completed").when(k % 8 == 1, "failed").when(k % 8 == 2, "no_open_copy").otherwise("culled").alias("status"), F.concat(F.lit("d"), s, F.lit(" for url: http://a/b")).alias("detail")
    )
    lookups = customer.where(k % 4 == 0).select(k.alias("ISBN"), F.lit(1).alias("seq"), F.lit("alpha").alias("source"), F.concat(F.lit("r"), s).alias("result")).unionByName(customer.where(k % 4 == 0).select(k.alias("ISBN"), F.lit(2).alias("seq"), F.lit("beta").alias("source"), F.lit("later").alias("result")))
    status = ledger.status_of(book, lookups, "ISBN")
    notes = customer.where(k % 3 == 0).select(k.alias("ISBN"), F.lit("old").alias("status"), F.concat(F.lit("n"), s).alias("detail"))
    missing = customer.where(k % 5 < 2).select(k.alias("ISBN"), F.when(k % 5 == 0, ledger.NO_COPY).otherwise(F.concat(F.lit("m"), s)).alias("reason"))
    bare = table(spark, sf_dir, "supplier").select((F.lit(10_000_000) + F.col("s_suppkey")).alias("ISBN"))
    return ledger.wanted(customer.select(k.alias("ISBN"), F.col("c_name").alias("Title")), notes, missing, status, bare)


_WANTED_ROWS = f"""WITH {_WANTED}, w AS (SELECT ISBN, 'yes' AS Screened, coalesce(s.status, n.status, CASE WHEN why IS NOT NULL THEN 'no open copy' END, '{ledger.NOT_FOUND[0]}') AS Status, coalesce(s.detail, n.detail, why, '{ledger.NOT_FOUND[1]}') AS Detail, Title
  FROM books LEFT JOIN status s USING (ISBN) LEFT JOIN notes n USING (ISBN) LEFT JOIN miss USING (ISBN) UNION ALL SELECT 10000000 + s_suppkey, 'no', '{ledger.BARE[0]}', '{ledger.BARE[1]}', '' FROM supplier)"""


@query(f"{_WANTED_ROWS} SELECT * FROM w WHERE Status NOT IN ('completed', 'culled')")
def wanted_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wanted(spark, sf_dir)


@query(f"{_WANTED_ROWS} SELECT Screened, Status, count(*) AS rows FROM w WHERE Status NOT IN ('completed', 'culled') GROUP BY ALL")
def wanted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(_wanted(spark, sf_dir), "Screened", "Status")


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN least(event_id % 100, 60) ELSE least(CAST(pow(2, event_id % 8 + 1) AS INT), 60) END AS wait FROM events""")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    after = F.when(k % 7 == 0, (k % 100).cast("string")).when(k % 7 == 1, "soon").otherwise("")
    return table(spark, sf_dir, "events").select("event_id", ledger.backoff(k % 8, after).cast("long").alias("wait"))


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 300 AS batch FROM orders""")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.batches(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 300)


_CANDIDATES = """refs AS (SELECT l_orderkey AS key, l_linenumber AS n, CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS source_rank, 'r' || l_partkey AS ref FROM lineitem),
  c AS (SELECT key, source_rank, row_number() OVER (PARTITION BY key, source_rank ORDER BY n, ref) - 1 AS pos, ref FROM refs WHERE key IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))"""


@query(f"WITH {_CANDIDATES} SELECT key, source_rank, pos, CASE source_rank WHEN 0 THEN 'index' WHEN 1 THEN 'view' ELSE 'scan' END AS source, CASE source_rank WHEN 2 THEN 'url' ELSE 'id' END AS kind, ref FROM c")
def candidates_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("rank", F.col("l_linenumber") % 3)
    refs = lambda r: lines.where(F.col("rank") == r).groupBy(F.col("l_orderkey").alias("key")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("r"), F.col("l_partkey").cast("string")).alias("ref")))).alias("x")).select("key", F.col("x.ref").alias("refs"))
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("key"))
    return ledger.candidates(rows, [("index", "id", refs(0)), ("view", "id", refs(1)), ("scan", "url", refs(2))], "key")


@query("""SELECT l_orderkey AS key, arg_min('r' || l_partkey, l_linenumber * 10000000 + l_partkey) FILTER (l_returnflag = 'R') AS ref,
  CASE WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'saved' ELSE coalesce(arg_max('no ' || l_partkey, l_linenumber * 10000000 + l_partkey) FILTER (l_returnflag = 'A'), 'none') END AS reason FROM lineitem GROUP BY l_orderkey""")
def attempt_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, flag = F.col("l_partkey").cast("string"), F.col("l_returnflag")
    tries = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.when(flag != "N", F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")).alias("pos"), (flag == "R").alias("ok"), F.concat(F.lit("r"), p).alias("ref"), F.when(flag == "A", F.concat(F.lit("no "), p)).alias("reason"))
    return ledger.first_success(tries, "key", "none")


@query("""SELECT user_id AS key, substr(string_agg(event_type || ' ' || event_id, '; ' ORDER BY event_id), 1, 500) AS detail FROM events WHERE event_type = 'error' GROUP BY user_id""")
def failure_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    return ledger.failure_details(e.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("why")), "key")


@query("""SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS saved, count(*) FILTER (o_orderstatus = 'P') AS culled, 0::BIGINT AS failed, 0::BIGINT AS no_open_copy, count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) AS pending FROM orders""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return ledger.stage_counts(table(spark, sf_dir, "orders"), F.when(s == "F", "completed").when(s == "P", "culled").otherwise("pending"))


@query("""SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n.d.' WHEN o_orderkey % 5 = 1 THEN '' ELSE CAST(1900 + o_orderkey % 100 AS VARCHAR) END AS DOUBLE) <= 1955, false) AS plausible FROM orders""")
def year_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    year = F.when(k % 5 == 0, "n.d.").when(k % 5 == 1, "").otherwise((1900 + k % 100).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", ledger.year_at_most(year, 1955).alias("plausible"))


@query("""SELECT event_type AS reason, count(*) AS rows FROM events GROUP BY ALL""")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "reason"), "reason")


@query("""SELECT user_id AS key, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS answered FROM events GROUP BY user_id""")
def answered_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.answered(table(spark, sf_dir, "events").withColumnRenamed("user_id", "key"), "key", "event_type")
    return found.select("key", F.array_join("sources", ",").alias("answered"))


@query("""SELECT s_suppkey, s_name, 'x' AS tag FROM supplier""")
def filled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are empty in every row go."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit("").alias("nothing"), F.lit("x").alias("tag"), F.lit(None).cast("string").alias("missing"))
    return dedup.drop_empty_columns(rows)
