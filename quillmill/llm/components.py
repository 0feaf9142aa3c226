"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.store import delete, renamed, tidy, written

#: A key with more rows than this is a hub, unless that would make more than HUBS of them.
HUB_ROWS, HUBS = 256, 1 << 16
#: Edges (16 bytes each) that one task may settle.
SMALL = 1 << 17


def hub_rows(total: int) -> int:
    """Rows from which a key counts as a hub: of total rows no more than HUBS keys have more than that."""
    return max(HUB_ROWS, -(-total // HUBS))


def join_hubs(rows: DataFrame, values: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """rows with the columns of values, which has one row for each key and in n the number of the key's rows.

    A plain join would put all rows of a hub into one task. Hubs are few (hub_rows) and broadcast, so that only the
    rows of other keys are shuffled.
    """
    hub = F.col("n") > hub_rows(total)
    hubs = F.broadcast(values.where(hub).drop("n"))
    return rows.join(hubs, key).unionByName(rows.join(hubs.select(key), key, "left_anti").join(values.where(~hub).drop("n"), key, how))


def _beside_least(rows: DataFrame, total: int) -> DataFrame:
    """rows (a, b) with m, the least of a and all its b."""
    return join_hubs(rows, rows.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n")), "a", total)


def _settled(now: DataFrame) -> bool:
    """Whether the edges are stars: every node has one root, and no root has one."""
    ends = now.select(F.col("a").alias("node"), F.lit(1).alias("low")).unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("low")))
    ends = ends.groupBy("node").agg(F.sum("low").alias("roots"), F.min("low").alias("low"))
    with tidy(now.sparkSession):
        return ends.where("roots > 1 or (roots = 1 and low = 0)").isEmpty()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that it can reach) of each node that is not its own least, by halving label paths."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low, high, label = np.minimum(at[: len(a)], at[len(a) :]), np.maximum(at[: len(a)], at[len(a) :]), np.arange(len(nodes))
    while True:
        x, y = label[low], label[high]
        if (x == y).all():
            far = label != np.arange(len(nodes))
            return nodes[far], nodes[label[far]]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
    if parts:
        node, root = forest(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(edges: DataFrame, *done: DataFrame, rounds: int = 100, small: int = SMALL) -> DataFrame:
    """(node, root) for each node of the edges (a, b), where root is the least node that it can reach and not itself.

    Up to small edges are settled in one task; the roots are the same either way. A graph that has not settled when the
    rounds run out is an error, since its components would be split.
    done: written tables that only the edges read; they are deleted.
    """
    a, b = F.col("a"), F.col("b")
    now = written(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges", *done)
    with tidy(now.sparkSession):
        total = now.count()
    if total <= small:
        return written(now.coalesce(1).mapInArrow(_one_task, "node long, root long"), "roots", now)
    for _ in range(rounds):
        if _settled(now):
            return renamed(now, "node", "root")
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        large = _beside_least(both, 2 * total).where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "edges", now)
        near = _beside_least(large, 2 * total)  # m is a neighbour here: every a is larger than its b
        moved = near.select(F.when(b == F.col("m"), a).otherwise(b).alias("a"), F.col("m").alias("b"))
        now = written(moved.distinct(), "edges", large)
    delete(now)
    raise RuntimeError(f"components have not settled in {rounds} rounds")
