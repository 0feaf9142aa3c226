"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets. A partition of sets up to size u keeps, of each item, its
floor((1 - t) * u) + 1 least shingle hashes as sketch (bottom-k MinHash). A document that holds a share of at least t
of an item cannot miss all of these, so the search loses nothing, however long the document; what it finds is then
verified by exact containment: |item & document| / |item| >= t over distinct shingles.

Shingles are five words (runs other than blanks and 0x09-0x0D) with A-Z in lower case; a text of fewer words is one
shingle as a whole. Items are taken in blocks of bounded size, each broadcast and held against all documents.

Edge cases: null or empty texts and items match nothing; repeated documents or items give repeated pairs; an empty
table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import text as T

#: Bytes of item texts in one block; what is broadcast is about as large.
BLOCK_BYTES = 8 << 20
PAIRS = "doc_id {id}, item_id {item}, item_shingles long, shared_shingles long, containment double"


class Sketches:
    """The index over one block of items."""

    def __init__(self, ids: list, texts: list[str], threshold: float, k: int):
        buf, off = T.utf8(pa.array(texts, pa.large_string()))
        self.ids, self.threshold, self.k = ids, threshold, k
        self.values, self.off = T.shingle_sets(T.lower_ascii(buf), off, k)
        sizes = np.diff(self.off)
        self.need = np.ceil(threshold * sizes - 1e-9).astype(np.int64)
        upper = np.where(sizes > 0, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))), 0).astype(np.int64)  # one partition for each power of two
        keep = np.minimum(np.floor((1 - threshold) * upper + 1e-9).astype(np.int64) + 1, sizes)
        picked = [self.values[self.off[i] : self.off[i] + keep[i]] for i in range(len(ids))]  # sets are sorted: the first are the least
        hashes = np.concatenate(picked) if picked else np.zeros(0, T.U64)
        owner = np.repeat(np.arange(len(ids)), keep)
        order = np.argsort(hashes, kind="stable")
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.owner, self.first = owner[order], np.append(first, len(owner))

    def candidates(self, values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Distinct (document, item) pairs that share a sketch value."""
        if not len(self.hashes) or not len(values):
            return np.zeros((0, 2), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == values)
        n = self.first[at[hit] + 1] - self.first[at[hit]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        items = self.owner[np.repeat(self.first[at[hit]], n) + within]
        pairs = np.unique(np.repeat(doc[hit], n) * len(self.ids) + items)
        return np.stack([pairs // len(self.ids), pairs % len(self.ids)], 1)

    def matches(self, buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, size of the item's set, shared shingles) of all pairs that reach the threshold."""
        values, first = T.shingle_sets(T.lower_ascii(buf), off, self.k)
        doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
        for d, i in self.candidates(values, doc):
            own, item = values[first[d] : first[d + 1]], self.values[self.off[i] : self.off[i + 1]]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[at] == item).sum())
            if shared >= self.need[i]:
                yield int(d), int(i), len(item), shared


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").toLocalIterator():
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t)
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, k: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row for each pair of a document and a benchmark item that it contains to at least the threshold."""
    context = docs.sparkSession.sparkContext
    schema = PAIRS.format(id=docs.schema[id_col].dataType.simpleString(), item=benchmark.schema[item_col].dataType.simpleString())
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(benchmark.schema[item_col].dataType.simpleString())
    rows, out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), None
    for ids, texts in _blocks(benchmark, item_col, item_text_col):
        shared = context.broadcast(Sketches(ids, texts, threshold, k))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                buf, off = T.utf8(batch.column(1))
                for i, j in T.slices(off):
                    found = list(index.matches(buf[off[i] : off[j]], off[i : j + 1] - off[i]))
                    if found:
                        d, item, size, same = map(list, zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([i + x for x in d])), pa.array([index.ids[x] for x in item], item_type), pa.array(size, pa.int64()), pa.array(same, pa.int64()), pa.array([s / z for s, z in zip(same, size, strict=True)])],
                            ["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"],
                        )

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that contain no benchmark item to the threshold; rows with a null id are judged by their text too."""
    context, blocks = docs.sparkSession.sparkContext, None
    out, names = docs, docs.columns
    for ids, texts in _blocks(benchmark, "item_id", "text"):
        blocks = context.broadcast(Sketches(ids, texts, threshold, k))

        def clean(batches: Iterator[pa.RecordBatch], shared=blocks) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                buf, off = T.utf8(batch.column(names.index(text_col)))
                keep = np.ones(batch.num_rows, bool)
                for i, j in T.slices(off):
                    keep[[i + d for d, *_ in index.matches(buf[off[i] : off[j]], off[i : j + 1] - off[i])]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(clean, docs.schema)
    return out
