"""Texts in numbered blocks, and an exchange of numpy arrays between tasks.

Rows are packed once into a table of chunks (about a megabyte of text, compressed); chunks make up blocks (at most
BLOCK_BYTES of text) that later passes join by number. Hashes travel as one binary row for each task and bucket instead
of a row for each hash, so that shuffles of billions of hashes cost bytes, not rows. Hash buckets are many more than
tasks; a block and a bucket each fit in one worker's memory.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import text as T
from quillmill.llm.store import tidy, written

CHUNK_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: Hash buckets for each shuffle partition at least, and bytes of text for each bucket at most.
BUCKETS_EACH, BUCKET_BYTES = 4, 64 << 20
#: Bits of a hash that are kept beside its bucket.
KEPT_BITS = 40


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(raw)}q", *map(len, raw)) + b"".join(raw))


def expand(value: bytes, *kinds: type) -> list[np.ndarray]:
    """The arrays of a squeezed value."""
    data = zstandard.ZstdDecompressor().decompress(value)
    sizes = struct.unpack_from(f"<{len(kinds)}q", data)
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def pack_sorted(values: np.ndarray) -> np.ndarray:
    """Ascending values of KEPT_BITS as byte planes of their differences, which compress."""
    steps = np.diff(values, prepend=T.U64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[: KEPT_BITS // 8]).ravel()


def unpack_sorted(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(planes) * 8 // KEPT_BITS, 8), np.uint8)
    out[:, : KEPT_BITS // 8] = planes.reshape(KEPT_BITS // 8, -1).T
    return np.cumsum(out.view(T.U64).ravel(), dtype=T.U64)


def buckets(table: DataFrame) -> int:
    """Hash buckets for a packed table: each is one group of a later pass, so their number follows the bytes."""
    spark = table.sparkSession
    with tidy(spark):
        size = table.agg(F.sum("size").alias("s")).first().s or 0
    return min(1 << 23, max(16, BUCKETS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)))


def packed(docs: DataFrame, id_col: str, text_col: str, shape: Callable | None = None) -> DataFrame:
    """Table (block long, chunk int, size long, ids binary, texts binary): ids as an Arrow stream, texts as offsets and UTF-8 bytes.

    shape(buf, off) may replace the texts' bytes, such as by their words.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, chunk, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            buf, off = T.utf8(batch.column(1))
            for i, j in T.slices(off, CHUNK_BYTES):
                own, first = buf[off[i] : off[j]], off[i : j + 1] - off[i]
                if size + len(own) > BLOCK_BYTES:
                    block, chunk, size = block + 1, 0, 0
                size += len(own)
                if shape:
                    own, first = shape(own, first)
                ids = pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i)], ["id"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, ids.schema) as out:
                    out.write_batch(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 24) + block], pa.int64()), pa.array([chunk], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([squeeze(first, own)], pa.binary())],
                    ["block", "chunk", "size", "ids", "texts"],
                )
                chunk += 1

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    return written(rows.mapInArrow(pack, "block long, chunk int, size long, ids binary, texts binary"), "packed")


def ids_of(value: bytes) -> pa.Array:
    return pa.ipc.open_stream(value).read_all().column(0).combine_chunks()


def pieces(off: np.ndarray, buf: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a chunk that stay in cache: index of the first text, bytes, offsets."""
    for i, j in T.slices(off, limit):
        yield i, buf[off[i] : off[j]], off[i : j + 1] - off[i]


def bucket_keys(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket in the upper bits, and the KEPT_BITS lower bits of the hash: what the exchange knows a hash by."""
    bits, low = T.U64(KEPT_BITS), T.U64((1 << KEPT_BITS) - 1)
    return ((hashes >> bits) % T.U64(n)) << bits | (hashes & low)


def by_bucket(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts bucket keys and the first row of each bucket."""
    order = np.argsort(keys)
    return order, np.searchsorted(keys[order], np.arange(n + 1, dtype=T.U64) << T.U64(KEPT_BITS))


class Gatherer:
    """Collects columns of rows over a task and gives them out by bucket in order of their keys, before they outgrow the task's memory."""

    def __init__(self, n: int, limit: int = 1 << 21):
        self.n, self.limit, self.have, self.size = n, limit, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        """The first column holds the bucket keys by which rows are dealt out."""
        self.have.append(columns)
        self.size += len(columns[0])
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        if self.size:
            columns = [np.concatenate(c) for c in zip(*self.have, strict=True)]
            self.have, self.size = [], 0
            order, first = by_bucket(columns[0], self.n)
            columns = [c[order] for c in columns]
            for b in np.flatnonzero(np.diff(first)):
                yield int(b), tuple(c[first[b] : first[b + 1]] for c in columns)


class RunGatherer:
    """Collects bucket keys of numbered blocks over a task and gives them out by bucket, as one value: ascending keys, a run for each block.

    The bucket, the block's place among those in hand and a key's KEPT_BITS make one number, so that sorting numbers is
    all it takes; the blocks are told by the lengths of their runs and not beside each key.
    """

    def __init__(self, n: int, limit: int = 1 << 21):
        self.limit, self.have, self.blocks, self.size = limit, [], [], 0
        self.bits = min(16, 64 - KEPT_BITS - (n - 1).bit_length())  # of a block's place

    def add(self, keys: np.ndarray, block: int) -> Iterator[tuple[int, bytes]]:
        if not self.blocks or self.blocks[-1] != block:
            if len(self.blocks) == 1 << self.bits:
                yield from self.flush()
            self.blocks.append(block)
        bucket, low = keys >> T.U64(KEPT_BITS), keys & T.U64((1 << KEPT_BITS) - 1)
        self.have.append(bucket << T.U64(KEPT_BITS + self.bits) | T.U64(len(self.blocks) - 1 << KEPT_BITS) | low)
        self.size += len(keys)
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if self.size:
            keys, blocks = np.concatenate(self.have), np.array(self.blocks, np.int64)
            keys.sort()
            run = keys >> T.U64(KEPT_BITS)
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]]))
            run, keys = run[first[:-1]], keys & T.U64((1 << KEPT_BITS) - 1)
            bucket, place = (run >> T.U64(self.bits)).astype(np.int64), run & T.U64((1 << self.bits) - 1)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield int(bucket[i]), squeeze(pack_sorted(keys[first[i] : first[j]]), blocks[place[i:j].astype(np.int64)], np.diff(first[i : j + 1]))
        self.have, self.blocks, self.size = [], [], 0


def runs(value: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys without their bucket, and the block and length of each run, from a value of a RunGatherer."""
    planes, blocks, size = expand(value, np.uint8, np.int64, np.int64)
    # where a run ends, the next key's difference has wrapped around
    return unpack_sorted(planes) & T.U64((1 << KEPT_BITS) - 1), blocks, size


def binary_batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of integers with one binary value last."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], names)
