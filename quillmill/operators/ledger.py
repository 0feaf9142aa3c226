"""Work ledger: append-only log with latest-wins reads, settlement by set division, wanted list, breaker, backoff."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import textnorm as X
from quillmill.session import checkpointed

# Statuses, their words and default details.
SETTLED = ("completed", "culled", "no_open_copy")
TRIP_AFTER = 3
NO_COPY = "no open-access copy found"
NOT_FOUND = ("not found yet", "no openly licensed copy on archive.org; Open Library and Google Books not checked yet")
BARE = ("no metadata", "bare ISBN with no title or author; never screened")


def latest(log: DataFrame, keys: list[str], order: tuple[str, ...] = ("updated", "seq")) -> DataFrame:
    """The last whole row of each key. max_by combines before the shuffle, so a busy key is no burden."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return last.select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def settled(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status").isin(*SETTLED))


def to_do(rows: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return rows.join(settled(ledger).select(key), key, "left_anti")


def year_at_most(year: Column, limit: int) -> Column:
    """Numeric comparison of a text; what is not a number is false."""
    return F.coalesce(year.try_cast("double") <= limit, F.lit(False))


def answered(lookups: DataFrame, key: str, source: str = "source") -> DataFrame:
    """(key, sources): the sources that have answered for each key, in order of their names; sources are few."""
    return lookups.groupBy(key).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def settle(needed: DataFrame, answered: DataFrame, failures: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Keys for which every needed source has answered, with no failure and no row yet. needed, answered: (key, source)."""
    want = needed.distinct().join(answered.select(key, "source").distinct().withColumn("got", F.lit(1)), [key, "source"], "left")
    done = want.groupBy(key).agg(F.count("*").alias("want"), F.count("got").alias("have")).where("want = have").select(key)
    return done.join(failures.select(key), key, "left_anti").join(ledger.select(key), key, "left_anti")


def failure_details(failures: DataFrame, key: str, limit: int = 500) -> DataFrame:
    """(key, seq, why) to one detail for each key, in order."""
    why = F.array_sort(F.collect_list(F.struct("seq", "why")))
    return failures.groupBy(key).agg(why.alias("w")).select(key, F.substring(F.array_join("w.why", "; "), 1, limit).alias("detail"))


def first_success(attempts: DataFrame, key: str, default: str) -> DataFrame:
    """(key, pos, ok, ref, reason): the first success's ref as saved, else the last failure's reason, else the default."""
    got = attempts.groupBy(key).agg(F.min_by(F.when(F.col("ok"), F.col("ref")), F.when(F.col("ok"), F.col("pos"))).alias("ref"), F.max_by("reason", F.when(~F.col("ok"), F.col("pos"))).alias("reason"))
    return got.select(key, "ref", F.when(F.col("ref").isNotNull(), "saved").otherwise(F.coalesce(F.nullif("reason", F.lit("")), F.lit(default))).alias("reason"))


def candidates(rows: DataFrame, sources: list[tuple[str, str, DataFrame]], key: str) -> DataFrame:
    """(key, source_rank, pos, source, kind, ref) of all sources' references to the rows, in order."""
    parts = [found.select(key, F.lit(rank).alias("source_rank"), F.posexplode("refs").alias("pos", "ref")).withColumns({"source": F.lit(name), "kind": F.lit(kind)}) for rank, (name, kind, found) in enumerate(sources)]
    return reduce(DataFrame.unionByName, parts).join(rows.select(key), key, "left_semi")


def status_of(ledger: DataFrame, lookups: DataFrame, key: str) -> DataFrame:
    """Status and detail in words; keys with lookups but no ledger row get their first lookup."""
    words = F.when(F.col("status") == "failed", "lookup failed").when(F.col("status") == "no_open_copy", "no open copy").otherwise(F.col("status"))
    own = ledger.select(key, words.alias("status"), X.scrub_url(F.col("detail")).alias("detail"))
    first = lookups.groupBy(key).agg(F.min_by(F.struct("source", "result"), "seq").alias("l")).join(ledger.select(key), key, "left_anti")
    return own.unionByName(first.select(key, F.lit("no open copy").alias("status"), F.concat("l.source", F.lit(": "), "l.result").alias("detail")))


def wanted(books: DataFrame, notes: DataFrame, missing: DataFrame, status: DataFrame, bare: DataFrame, key: str = "ISBN") -> DataFrame:
    """Books not yet had, with what is known of each; ledger before old note before miss before default; bare rows last."""
    known = status.select(key, F.struct("status", "detail").alias("s"))
    old = notes.select(key, F.struct("status", "detail").alias("n"))
    miss = missing.where(F.col("reason") != NO_COPY).groupBy(key).agg(F.first("reason").alias("why"))
    rows = books.join(known, key, "left").join(old, key, "left").join(miss, key, "left")
    note = F.coalesce("s", "n", F.when(F.col("why").isNotNull(), F.struct(F.lit("no open copy").alias("status"), F.col("why").alias("detail"))), F.struct(F.lit(NOT_FOUND[0]).alias("status"), F.lit(NOT_FOUND[1]).alias("detail")))
    rows = rows.withColumn("note", note).where(~F.col("note.status").isin("completed", "culled"))
    lead = [F.col(key), F.lit("yes").alias("Screened"), F.col("note.status").alias("Status"), F.col("note.detail").alias("Detail")]
    others = [c for c in books.columns if c != key]
    rows = rows.select(*lead, *others)
    extra = bare.select(F.col(key), F.lit("no").alias("Screened"), F.lit(BARE[0]).alias("Status"), F.lit(BARE[1]).alias("Detail"), *(c for c in others if c in bare.columns))
    return rows.unionByName(extra, allowMissingColumns=True).na.fill("")


def breaker(calls: DataFrame, source: str, order: list[str], failed: Column, trip_after: int = TRIP_AFTER) -> DataFrame:
    """Adds down: from the call on that ends trip_after failures in a row, for good.

    Sources are few and their calls many, so calls are ranged by source and order, and every range is looked at apart. What
    one range tells the next of a source is how many failures it ends with; a row for each range and source carries that on.
    Of a source then only its first trip matters. Calls without a source are never down.
    """
    at = F.struct(*order)
    ranges = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = calls.withColumn("__fail", F.coalesce(failed, F.lit(False))).repartitionByRange(ranges, source, *order).withColumn("__part", F.spark_partition_id())
    rows = checkpointed(rows)
    by = Window.partitionBy("__part", source).orderBy(*order)
    runs = rows.withColumn("__ok", F.sum((~F.col("__fail")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    # failures since the range's last success, or since its start
    runs = runs.withColumn("__run", F.count_if("__fail").over(Window.partitionBy("__part", source, "__ok").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    ends = runs.groupBy("__part", source).agg(F.max("__ok").alias("ok"), F.max_by("__run", at).alias("tail"))
    parts = Window.partitionBy(source).orderBy("__part")
    ends = ends.withColumn("since", F.sum((F.col("ok") > 0).cast("int")).over(parts.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("total", F.sum("tail").over(Window.partitionBy(source, "since").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)))
    carried = ends.select("__part", source, F.coalesce(F.lag("total").over(parts), F.lit(0)).alias("__carried"))
    length = F.col("__run") + F.when(F.col("__ok") == 0, F.col("__carried")).otherwise(0)
    tripped = runs.join(carried, ["__part", source]).where(F.col("__fail") & (length >= trip_after)).groupBy(source).agg(F.min(at).alias("__trip"))
    return rows.join(tripped, source, "left").withColumn("down", F.coalesce(at >= F.col("__trip"), F.lit(False))).drop("__fail", "__part", "__trip")


def backoff(attempt: Column, retry_after: Column | None = None) -> Column:
    """Seconds before the try after this one (0 is the first): doubling, at most 60; a numeric Retry-After wins."""
    own = F.pow(F.lit(2.0), attempt + 1).cast("int")
    asked = F.when(retry_after.rlike("^[0-9]+$"), retry_after.try_cast("int")) if retry_after is not None else F.lit(None).cast("int")
    return F.least(F.coalesce(asked, own), F.lit(60))


def stage_counts(rows: DataFrame, outcome: Column) -> DataFrame:
    """saved, culled, failed, no open copy, and what is left of all."""
    is_ = lambda v: F.count_if(outcome == v)
    counted = rows.agg(F.count("*").alias("total"), is_("completed").alias("saved"), is_("culled").alias("culled"), is_("failed").alias("failed"), is_("no_open_copy").alias("no_open_copy"))
    return counted.withColumn("pending", F.expr("total - saved - culled - failed - no_open_copy"))


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds batch: consecutive rows in order, size at a time. Ranges are sorted apart and their counts summed, so no
    single task sorts or numbers all rows. Their number is fixed, so that both branches see the same ranges."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    parts = parts.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    counts = parts.groupBy("__part").agg(F.count("*").alias("n"))  # one row for each partition
    before = counts.withColumn("__before", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return parts.join(F.broadcast(before), "__part").withColumn("batch", F.floor((F.col("__before") + F.col("__row") - 1) / size)).drop("__part", "__row", "__before")
