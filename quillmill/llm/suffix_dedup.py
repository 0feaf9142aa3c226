"""Operator 7: suffix-array deduplication over bytes, by merging the shards' Burrows-Wheeler transforms.

A byte goes if it is covered by a string of LENGTH bytes of one document that also starts anywhere else, in the same
document or another; overlaps count, and strings are judged on the input. See repeats.py for how strings that may be
equal meet in one shard; there the transforms of parts of the shard are merged by iterative interleave refinement, and
the common prefixes of neighbours give the repeated intervals.

Edge cases: a null text is empty; with fewer than LENGTH bytes nothing is removed; a repeated row counts as another
document; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmill.llm.blocks import packed
from quillmill.llm.bwt_merge import repeated_strings
from quillmill.llm.fm_index import runs
from quillmill.llm.repeats import Units, mark_repeats, single_bytes

LENGTH, GRAM = 400, 48


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared_anchors and, if asked for, the removed spans (first and
    last byte) of each row.

    n_shared_anchors counts the places of a document where an anchor (gram bytes) starts that is an anchor elsewhere too:
    it tells of passages that repeat and are too short to be removed.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def digest(ids: pa.Array, units: Units, covered: np.ndarray, anchors: np.ndarray) -> pa.Table:
        rows, gone = [], np.concatenate([[0], np.cumsum(covered)])
        for a, b in zip(units.first[:-1].tolist(), units.first[1:].tolist(), strict=True):
            some = gone[b] > gone[a]
            spans = runs(covered[a:b]) if some else []
            text = units.buf[a:b][~covered[a:b]].tobytes() if some else units.span(a, b)
            rows.append((b - a, int(gone[b] - gone[a]), len(spans), hashlib.sha256(text).hexdigest(), [list(s) for s in spans]))
        n, removed, count, sums, spans = zip(*rows, strict=True) if rows else ((),) * 5
        shared = np.diff(np.searchsorted(anchors, units.first))
        columns = [ids, *(pa.array(x, pa.int64()) for x in (n, removed, count)), pa.array(sums, pa.string()), pa.array(shared, pa.int64())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared_anchors"]
        return pa.table([*columns, pa.array(spans, pa.list_(pa.list_(pa.int64())))], [*names, "spans"]) if with_spans else pa.table(columns, names)

    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared_anchors long" + ", spans array<array<long>>" * with_spans
    return mark_repeats(packed(docs, id_col, text_col), single_bytes, length, gram, repeated_strings(length), digest, schema)
