"""Operator 13: importance resampling towards a target distribution, with scores that need no explode.

Words are runs of ASCII letters and digits and of any character beyond ASCII, after A-Z became a-z. Features are all runs
of 1 to max_run words, joined by one space; a feature's bucket is its CRC-32 modulo buckets. Of a bucket with s of the S
features of the corpus and t of the T features of the target, the gain is

    floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))

A document's weight is the sum of its features' gains; its score adds Gumbel noise that only its id and the seed decide.
Higher-order functions make each document's array of buckets and add up gains out of one literal array, so that of the
texts only the counts of the buckets are shuffled (each task sends one row for each bucket at most). What comes to the
driver is those counts and the sizes of the rank ranges; neither grows with the data.

Ranks are dealt without a single sorting task: rows are ranged by score, each numbered within its range, and ranges are
offset by the rows before them.

Edge cases: null and empty texts have no features, a weight of 0, and are never drawn (they have under least_words
words). A null id gives the noise of an empty one and loses ties; rows that repeat an id and a score are ranked in order
of n_features. Further columns are ignored. An empty target gives every bucket the gain of t = 0; an empty table gives no
rows. Texts of any length are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.expr import let
from quillmill.llm.store import tidy, written

BUCKETS, MAX_RUN, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, once A-Z are gone.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else; plain ASCII takes Spark's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """Array of the words; a separator at either end leaves an empty string, which is cut off."""

    def inner(parts: Column) -> Column:
        lead, tail = ((p == "").cast("int") for p in (F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)))
        return F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - tail, F.lit(0)))

    return let(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), _BETWEEN, -1), inner)


def bucket_array(words: Column, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> Column:
    """The bucket of every feature, repeats included."""

    def hashed(features: Column) -> Column:
        return F.transform(features, lambda f: (F.crc32(f) % buckets).cast("int"))

    def runs(w: Column, k: int) -> Column:
        starts = F.when(F.size(w) >= k, F.sequence(F.lit(0), F.size(w) - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *(F.get(w, i + d) for d in range(k))))

    if max_run == 1:
        return hashed(words)
    return let(words, lambda w: F.concat(hashed(w), *(hashed(runs(w, k)) for k in range(2, max_run + 1))))


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, max_run: int) -> list[int]:
    """Features in each bucket; tasks add up before the shuffle."""
    rows = texts.select(F.explode(bucket_array(words(F.col(f"`{text_col}`")), buckets, max_run)).alias("bucket"))
    out = [0] * buckets
    with tidy(texts.sparkSession):
        for bucket, n in rows.groupBy("bucket").agg(F.count("*").alias("n")).collect():
            out[bucket] = n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    big, small, size = float(sum(corpus)), float(sum(target)), len(corpus)
    return [math.floor(1000 * math.log((t + 1.0) * (big + size) / ((s + 1.0) * (small + size)))) for s, t in zip(corpus, target, strict=True)]


def literal(values: list[int]) -> Column:
    """One constant array; the optimiser folds it before the plan runs."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def noise(id_: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(docs: DataFrame, gain: list[int], max_run: int = MAX_RUN, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row: one pass without a shuffle."""
    table = literal(gain)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words(F.col(f"`{text_col}`")).alias("words"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), bucket_array(F.col("words"), len(gain), max_run).alias("buckets"))
    weight = F.aggregate("buckets", F.lit(0).cast("bigint"), lambda total, b: total + F.element_at(table, b + 1))
    rows = rows.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), weight.alias("weight"))
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def ranked(rows: DataFrame, order: list[Column], name: str = "placed") -> DataFrame:
    """rows, written, with rank: 1, 2, 3 ... in order. No task sorts more than one range of the order."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # of a sorted partition, the id is the partition's number in the upper bits and the row's place in the lower 33
    placed = written(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    with tidy(rows.sparkSession):
        sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row for each range
    before, total = [], 0
    for i in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(i, 0)
    return placed.withColumn("rank", F.element_at(literal(before), part.cast("int") + 1) + place + 1).drop("__place")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, max_run: int = MAX_RUN, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row: of those with least_words, the percent best have a rank."""
    gain = gains(bucket_counts(docs, text_col, buckets, max_run), bucket_counts(target, target_col, buckets, max_run))
    rows = written(scored(docs, gain, max_run, seed, id_col, text_col), "scored")
    long = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    best = ranked(rows.where(long), order)
    with tidy(docs.sparkSession):
        drawn = percent * rows.where(long).count() // 100
    best = best.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = rows.where(~long).select(*columns, F.lit(None).cast("long").alias("rank"))
    return best.select(*columns, "rank").unionByName(rest)
