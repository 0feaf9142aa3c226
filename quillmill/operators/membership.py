"""Membership of identifiers in run-length-encoded bitmaps: runs to intervals by a two-level prefix sum, then a sweep.

Nothing here depends on how identifiers are spread: the prefix sum works on blocks of runs, the sweep on ranges that hold
equal numbers of edges and keys, so neither a catalog nor a crowded stretch of identifiers is one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillmill.session import checkpointed

#: Identifier that the first run starts at, and places of a catalog whose runs one task adds up.
FIRST, BLOCK = 978_000_000_000, 1 << 16


def prefix_sums(rows: DataFrame, group: str, order: str, value: str, name: str, block: int = BLOCK) -> DataFrame:
    """Adds name: the sum of value over the group's rows up to this one, in order of a whole number.

    Blocks are summed apart, their sums (a row for each block) are added up, and rows are added up within their block.
    Runs and blocks' sums are dealt out by the same keys, so that rows are shuffled once.
    """
    placed = rows.withColumn("__block", F.floor(F.col(order) / block))
    sums = placed.groupBy(group, "__block").agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(group, "__block", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.sum(value).over(Window.partitionBy(group, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("__within", within).join(offsets, [group, "__block"]).withColumn(name, F.col("__before") + F.col("__within")).drop("__block", "__within", "__before")


def runs_to_intervals(runs: DataFrame, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """(catalog, pos, run_len) to (catalog, lo, hi): runs alternate present and absent; present ones as [lo, hi)."""
    ends = prefix_sums(runs, "catalog", "pos", "run_len", "__end", block).withColumn("hi", F.lit(first) + F.col("__end"))
    return ends.where("pos % 2 = 0 and run_len > 0").select("catalog", (F.col("hi") - F.col("run_len")).alias("lo"), "hi")


def _sweep(carried: dict[int, dict[str, int]], columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hits of a sorted range: a key is in a catalog if the furthest end of the intervals begun so far lies beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach: dict[str, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if reach is None:
                reach = dict(carried.get(batch.column("__part")[0].as_py(), {}))
            names = batch.column("__catalog").dictionary_encode()
            which = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            point, end = batch.column("__point").to_numpy(), batch.column("__end").fill_null(0).to_numpy(zero_copy_only=False)
            at, rows, hits = np.flatnonzero(which < 0), [], []
            local = {n: i for i, n in enumerate(names.dictionary.to_pylist())}
            seen = sorted(reach.keys() | local.keys())
            for name in seen:
                edges = np.flatnonzero(which == local[name]) if name in local else np.zeros(0, np.int64)
                furthest = np.maximum.accumulate(np.concatenate([[reach.get(name, -(2**63))], end[edges]]))
                inside = at[furthest[np.searchsorted(edges, at)] > point[at]]
                rows.append(inside)
                hits.append(np.full(len(inside), len(hits)))
                reach[name] = int(furthest[-1])
            taken = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            catalogs = pa.DictionaryArray.from_arrays(pa.array(np.concatenate(hits) if hits else np.zeros(0, np.int64)), pa.array(seen, pa.string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(taken) for c in columns), catalogs], [*columns, "catalog"])

    return run


def members(keys: DataFrame, intervals: DataFrame, key: str = "isbn12") -> DataFrame:
    """Rows of keys with each catalog (a text) whose intervals hold the key: a sweep over edges and keys in one order.

    Interval starts and keys are ranged together by their place, rows with one key also by a hash of the whole row, and
    sorted, so that ranges hold equal numbers of rows however crowded the keys are. A range starts with the furthest end
    that intervals of the ranges before it reach, for each catalog: what is collected is a row for each range and catalog.
    No key meets an interval that it is not compared with; a key costs one row, and one more for each catalog that holds it.
    """
    spark, names = keys.sparkSession, keys.columns
    edges = intervals.select(F.col("lo").cast("long").alias("__point"), F.col("hi").cast("long").alias("__end"), F.col("catalog").cast("string").alias("__catalog"))
    rows = keys.where(F.col(f"`{key}`").isNotNull()).withColumns({"__point": F.col(f"`{key}`").cast("long"), "__salt": F.xxhash64(*(F.col(f"`{c}`") for c in names))})
    order = ["__point", F.col("__end").isNull(), "__salt", "__end"]  # an interval that starts at a key holds it
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = edges.unionByName(rows, allowMissingColumns=True).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    events = checkpointed(events.drop("__salt").withColumn("__part", F.spark_partition_id()))  # both passes below see the same ranges
    reached: dict[int, dict[str, int]] = {}
    for r in events.where("__end is not null").groupBy("__part", "__catalog").agg(F.max("__end").alias("reach")).collect():
        reached.setdefault(r["__part"], {})[r["__catalog"]] = r.reach
    carried, now = {}, {}
    for part in range(ranges):
        carried[part] = dict(now)
        for name, end in reached.get(part, {}).items():
            now[name] = max(end, now.get(name, end))
    schema = StructType([*keys.schema.fields, StructField("catalog", StringType())])
    return events.mapInArrow(_sweep(carried, names), schema)


def matched_list(keys: DataFrame, hits: DataFrame, key: str = "isbn12") -> DataFrame:
    """Per key the number of catalogs and their names, in catalog order, joined by semicolons. hits carries catalog_pos."""
    names = hits.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("catalog_pos", "catalog"))).alias("c"))
    names = names.select(key, F.size("c").alias("num_catalogs"), F.array_join("c.catalog", ";").alias("matched_catalogs"))
    return keys.join(names, key, "left").withColumns({"num_catalogs": F.coalesce("num_catalogs", F.lit(0)), "matched_catalogs": F.coalesce("matched_catalogs", F.lit(""))})


def catalog_rates(keys: DataFrame, hits: DataFrame, key: str = "isbn12") -> DataFrame:
    """Hits of each catalog and their share of the valid rows."""
    valid = keys.agg(F.count(key).alias("valid"))
    return hits.groupBy("catalog").agg(F.count("*").alias("hits")).crossJoin(F.broadcast(valid)).select("catalog", "hits", (F.col("hits") / F.col("valid")).alias("rate"))


def coverage(keys: DataFrame, hits: DataFrame, specific: str, key: str = "isbn12", row: str = "row_id") -> DataFrame:
    """One row: valid rows, those in any catalog, in the specific one, in none."""
    per = hits.groupBy(row).agg(F.bool_or(F.col("catalog") == specific).alias("own"))
    joined = keys.where(F.col(key).isNotNull()).join(per, row, "left")
    return joined.agg(F.count("*").alias("valid"), F.count("own").alias("any_catalog"), F.count_if("own").alias("specific"), F.count_if(F.col("own").isNull()).alias("no_catalog"))
