"""Operator 9: quality classifier on random-indexing word vectors.

Each term has a fixed sparse ternary index vector. A term's context vector is the sum of the index vectors of the
terms within two words of it, over the whole corpus; terms are hashed to a fixed number of rows, so the table of
context vectors has one size whatever the corpus, and it is summed by an ordinary aggregation. A document is the mean
of its terms' normed vectors, once over its words and once over their shapes (which kinds of characters a word has),
with the logarithm of its length. A two-layer numpy network turns that into a probability, calibrated by a
temperature on held-back training rows.

Labels are learned from the rows whose crc32(doc_id as text) mod 3 is not 1, at most SAMPLE_ROWS of them, chosen by a
hash. doc_id, labels, lang and source are never inputs of a score.

Edge cases: null and empty texts have zero vectors and get a score as others do; with no labels, or of one class only,
all scores are the (smoothed) share of label 1; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import text as T
from quillmill.llm.linear import TwoLayer
from quillmill.llm.store import written

ROWS, SHAPES, DIMS, NONZERO, REACH = 8192, 512, 24, 4, 2
#: Largest number of labelled rows that the network is trained on.
SAMPLE_ROWS = 20_000
_KIND = np.full(256, 64, np.uint8)  # by byte: lower, upper, digit, sentence marks, quotes and dashes, other marks, beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 4
_KIND[[ord(c) for c in ".,;:?"]] = 8
_KIND[[ord(c) for c in "'\"-()!"]] = 16
_KIND[[ord(c) for c in "#*$%&|<>@/\\_=+~^`[]{}"]] = 32


def held_out(column: str) -> F.Column:
    """True for rows whose labels must not be learned from."""
    return F.crc32(F.col(column).cast("string")) % 3 == 1


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors, the same in every process."""
    rng = np.random.default_rng(3)
    out = np.zeros((ROWS + SHAPES, DIMS), np.float32)
    for row in out:
        row[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def terms(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, row of each word's shape, and the texts' first words."""
    starts, ends, first = T.word_spans(buf, off)
    words = T.span_hashes(buf, starts, ends)
    rows = (words % T.U64(ROWS)).astype(np.int32)
    kinds = np.bitwise_or.reduceat(_KIND[buf], starts) if len(starts) else np.zeros(0, np.uint8)
    length = np.minimum((ends - starts) // 6, 3)
    return rows, ROWS + kinds.astype(np.int32) * 4 + length.astype(np.int32), first


def _context(rows: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each word the sum of the index vectors within REACH words, in its own text."""
    own = index[rows]
    out = np.zeros_like(own)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for d in range(1, REACH + 1):
        if len(rows) > d:
            same = (doc[d:] == doc[:-d])[:, None]
            out[d:] += own[:-d] * same
            out[:-d] += own[d:] * same
    return out


def word_vectors(docs: DataFrame, text_col: str) -> np.ndarray:
    """Context vectors of all rows of the table, summed over the whole corpus and normed."""
    columns = [f"v{i}" for i in range(DIMS)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((ROWS + SHAPES, DIMS))
        for batch in batches:
            buf, off = T.utf8(batch.column(0))
            for i, j in T.slices(off):
                words, shapes, first = terms(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                if len(words):
                    context = _context(words, first, index)
                    for c in range(DIMS):
                        total[:ROWS, c] += np.bincount(words, context[:, c], ROWS)
                        total[ROWS:, c] += np.bincount(shapes - ROWS, context[:, c], SHAPES)
        some = np.flatnonzero(np.any(total, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(total[some, c]) for c in range(DIMS))], ["row", *columns])

    summed = docs.select(F.col(text_col).cast("string")).mapInArrow(gather, "row int, " + ", ".join(f"{c} double" for c in columns)).groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))
    out = np.zeros((ROWS + SHAPES, DIMS))
    found = summed.toPandas()  # at most ROWS + SHAPES rows
    out[found["row"].to_numpy(int)] = found[columns].to_numpy(float)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(buf: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of each text."""
    words, shapes, first = terms(buf, off)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIMS + 1), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        out[some, :DIMS] = np.add.reduceat(vectors[words], first[some]) / n[some, None]
        out[some, DIMS:-1] = np.add.reduceat(vectors[shapes], first[some]) / n[some, None]
    out[:, -1] = np.log1p(n)
    return out


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and its features as packed 32-bit floats."""
    shared = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text_col))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = T.utf8(batch.column(1))
            parts = [pooled(buf[off[i] : off[j]], off[i : j + 1] - off[i], shared.value) for i, j in T.slices(off)]
            rows = np.concatenate(parts) if parts else np.zeros((0, 2 * DIMS + 1), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(pool, f"doc_id {kind}, x binary")


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    x = written(features(docs, id_col, text_col), "features")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = x.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "x").select("x", "y").limit(sample_rows).toPandas()  # ids may repeat
    data = np.frombuffer(b"".join(map(bytes, rows["x"])), np.float32).reshape(-1, 2 * DIMS + 1)
    model = docs.sparkSession.sparkContext.broadcast(TwoLayer(data, rows["y"].to_numpy()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, _ = T.utf8(batch.column(1))
            s = model.value.score(np.frombuffer(buf.tobytes(), np.float32).reshape(-1, 2 * DIMS + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = written(x.mapInArrow(score, f"doc_id {x.schema['doc_id'].dataType.simpleString()}, score double, predicted int"), "scores", x)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")
