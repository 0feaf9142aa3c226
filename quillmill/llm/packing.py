"""Operator 8: conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Documents go to shards of bounded size by a hash of their id. Within a shard, pieces are placed longest first. Open
bins are kept in order of their residual, each with a bitmap of the sources and one of the duplicate clusters that it
holds; a successor search starts at the least residual that fits and goes on until it meets a bin that holds neither
the piece's source nor its cluster. That is the tightest compatible bin; if there is none, a bin is opened.

A document longer than a bin is cut into full pieces, each a bin of its own, and a rest that is placed as others are.
The cluster is that of documents with equal words (A-Z in lower case), unless a column gives it. A null source is a
source like any other.

Edge cases: null and empty texts have no words and get one piece of 0 words with a null bin; repeated rows are copies
of each other and never share a bin; ties in length are broken by id, then by input order in the shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import text as T

CAPACITY, SHARD_DOCS, SALTS = 2048, 2048, 4096
PACKED = "doc_id {id}, piece long, start_word long, n_words long, bin_id long"


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin of each piece, for pieces of 1 to capacity words that come longest first."""
    source_bit = {s: i for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit = {c: i for i, c in enumerate(c for c, n in Counter(clusters).items() if n > 1)}
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[tuple[int, int]] = []  # bitmaps of sources and clusters of each bin
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s = 1 << source_bit[source]
        c = 1 << cluster_bit[cluster] if cluster in cluster_bit else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (held[order[at][1]][0] & s or held[order[at][1]][1] & c):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
            held[b] = (held[b][0] | s, held[b][1] | c)
        else:
            residual, b = capacity, len(held)
            held.append((s, c))
        if residual > size:
            insort(order, (residual - size, b))
        placed.append(b)
    return placed


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """doc_id, piece, start_word, n_words and bin_id of each piece of each row.

    clusters (doc_id, cluster), one row for each id at most, goes before the cluster of equal words; it is joined to the
    measured rows, so that no text is shuffled.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shards = max(1, -(-docs.count() // shard_docs))
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"), F.xxhash64(cluster).alias("given"), cluster.isNotNull().alias("has"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = T.utf8(batch.column(1))
            words, same = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, j in T.slices(off, 1 << 18):
                words[i:j], same[i:j] = measured(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            given = batch.column(4).to_numpy(zero_copy_only=False)
            salt = np.arange(batch.num_rows) % SALTS  # rows that repeat one id and text go to several shards too
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), batch.column(2), pa.array(np.where(given, batch.column(3).to_numpy(), same)), pa.array(salt, pa.int32())], ["doc_id", "n", "source", "cluster", "salt"])

    def place(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        n = table["n"].to_numpy()
        ids, sources, clusters = (table[c].to_pylist() for c in ("doc_id", "source", "cluster"))
        full = n // capacity
        rest = n - full * capacity
        some = [r for r in range(len(n)) if rest[r]]
        some.sort(key=lambda r: (-rest[r], ids[r] is not None, ids[r]))
        bins = dict(zip(some, best_fit([int(rest[r]) for r in some], [sources[r] for r in some], [clusters[r] for r in some], capacity), strict=True))
        base = (shard << 32) + max(bins.values(), default=-1) + 1
        out: list[tuple] = []
        for r in range(len(n)):
            for piece in range(int(full[r])):
                out.append((ids[r], piece, piece * capacity, capacity, base))
                base += 1
            if rest[r] or not n[r]:
                out.append((ids[r], int(full[r]), int(full[r]) * capacity, int(rest[r]), (shard << 32) + bins[r] if r in bins else None))
        columns = list(zip(*out, strict=True))
        return pa.table([pa.array(columns[0], table["doc_id"].type), *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", "piece", "start_word", "n_words", "bin_id"])

    sizes = rows.mapInArrow(measure, f"doc_id {id_type}, n long, source string, cluster long, salt int")
    if clusters is not None:
        given = clusters.select(F.col("doc_id").alias("__id"), F.xxhash64(F.col("cluster").cast("string")).alias("__cluster"), F.col("cluster").isNotNull().alias("__has"))
        joined = sizes.join(given, F.col("doc_id") == F.col("__id"), "left")
        sizes = joined.withColumn("cluster", F.when(F.col("__has"), F.col("__cluster")).otherwise(F.col("cluster"))).drop("__id", "__cluster", "__has")
    sharded = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "salt"), F.lit(shards))).drop("salt")
    return sharded.groupBy("shard").applyInArrow(place, PACKED.format(id=id_type))


def measured(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each text, and a hash of its sequence of words (A-Z in lower case)."""
    joined, starts, ends, n = T.joined_words(buf, off)
    same = b"".join(blake2b(joined[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    return n, np.frombuffer(same, np.int64)
