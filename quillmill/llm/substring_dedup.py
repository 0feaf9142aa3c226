"""Operator 1: substring deduplication over words, by FM-indexes of the shards.

A window is a run of WINDOW words of one document; a word goes if it lies in a window whose words also start anywhere
else, in the same document or another. Windows are judged on the input. See repeats.py for how windows that may be
equal meet in one shard; there a compressed FM-index of the shard's segments gives the matching statistics of each
segment, and the intervals that reach the threshold are reported.

Edge cases: null and empty texts have no words; with fewer than WINDOW words nothing is removed; a repeated row counts
as another document; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmill.llm import text as T
from quillmill.llm.blocks import packed
from quillmill.llm.fm_index import repeated_windows
from quillmill.llm.repeats import Units, mark_repeats, words

WINDOW, GRAM = 35, 12


def only_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as their words joined by one space."""
    starts, ends, first = T.word_spans(buf, off)
    if not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(off), np.int64)
    out = np.where(T.IS_WORD[buf], buf, np.uint8(0x20))
    keep = T.IS_WORD[buf]
    inner = np.ones(len(ends), bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False
    keep[ends[inner]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[off]


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept text of each row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def digest(ids: pa.Array, units: Units, covered: np.ndarray, _: np.ndarray) -> pa.Table:
        gone, sums, texts = np.concatenate([[0], np.cumsum(covered)]), [], []
        for a, b in zip(units.first[:-1].tolist(), units.first[1:].tolist(), strict=True):
            if a == b:
                text = b""
            elif gone[a] == gone[b]:
                text = units.span(a, b)
            else:
                text = b" ".join(units.span(i, i + 1) for i in range(a, b) if not covered[i])
            sums.append(hashlib.sha256(text).hexdigest())
            if with_text:
                texts.append(text.decode("utf-8", "replace"))
        columns = [ids, pa.array(np.diff(units.first), pa.int64()), pa.array(gone[units.first[1:]] - gone[units.first[:-1]], pa.int64()), pa.array(sums, pa.string())]
        return pa.table([*columns, pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "text"]) if with_text else pa.table(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return mark_repeats(packed(docs, id_col, text_col, only_words), words, window, gram, repeated_windows(window), digest, schema)
