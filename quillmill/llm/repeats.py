"""Repeated windows: which windows of a fixed number of units (words or bytes) occur more than once in a corpus.

Nothing is compared pairwise and no window is shipped by itself. Every window picks an anchor, its least k-gram by
hash; equal windows pick equal anchors. Consecutive windows with one anchor form a segment.

1. Anchors are counted by hash bucket; windows whose anchor occurs once are unique.
2. Segments of repeated anchors go, as text, to the shard that their anchor's hash names, so all occurrences of a
   window meet in one shard. An anchor with very many different segments (the edge of a passage that countless
   documents share) is split: its windows travel one by one, dealt out by their own hash.
3. Each shard indexes its different segments, with how often each occurs, and reports the windows that the index holds
   more than once. Only keys whose texts are all of one window (split anchors, above all) have nothing to search in:
   equal texts are counted.
4. The reports go back to the blocks of documents.

The index is the caller's: an FM-index (words) or merged Burrows-Wheeler transforms (bytes).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import blocks as B
from quillmill.llm import text as T
from quillmill.llm.store import written

_PLACE = 24  # bits of a position within a slice
#: An anchor is split when it has so many different segments, and this share of its bucket's.
HOT_SEGMENTS, HOT_SHARE = 512, 0.1
#: Text of one index.
INDEX_BYTES = 1 << 20
LOW = T.U64((1 << B.KEPT_BITS) - 1)


@dataclass
class Units:
    """Units of a slice of texts: their values, the first unit of each text, and where each unit starts and ends in buf."""

    buf: np.ndarray
    values: np.ndarray
    first: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def span(self, a: int, b: int) -> bytes:
        """Bytes of units a to b - 1."""
        return (self.buf[a:b] if self.starts is None else self.buf[self.starts[a] : self.ends[b - 1]]).tobytes()


def words(buf: np.ndarray, off: np.ndarray) -> Units:
    starts, ends, first = T.word_spans(buf, off)
    return Units(buf, T.span_hashes(buf, starts, ends), first, starts, ends)


def single_bytes(buf: np.ndarray, off: np.ndarray) -> Units:
    return Units(buf, T.byte_values(buf), off)


def _least(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each w consecutive values, the first of equals."""
    out, step = [], (1 << _PLACE) - w
    for at in range(0, max(1, len(values) - w + 1), step):
        part = values[at : at + step + w - 1]
        placed = (part & ~T.U64((1 << _PLACE) - 1)) | np.arange(len(part), dtype=T.U64)
        out.append((T.sliding_min(placed, w) & T.U64((1 << _PLACE) - 1)).astype(np.int64) + at)
    return np.concatenate(out)


@dataclass
class Segments:
    """first and last window of each segment, its anchor's bucket key and place, and a hash of its units."""

    a: np.ndarray
    b: np.ndarray
    anchor: np.ndarray
    at: np.ndarray
    ident: np.ndarray


def segments(units: Units, window: int, k: int, n_buckets: int) -> tuple[Segments, Callable[[np.ndarray], np.ndarray]]:
    """Segments of a slice, and a function that hashes the windows at given starts."""
    v, n = units.values, len(units.values)
    power, inverse = T._power(T._BASE, n), T._power(T._INVERSE, n + 1)
    sums = np.zeros(n + 1, T.U64)
    np.cumsum(v * power, out=sums[1:])

    def hashes(a: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return T.mix((sums[a + length] - sums[a]) * inverse[a] + np.asarray(length).astype(T.U64))

    none = Segments(*(np.zeros(0, t) for t in (np.int64, np.int64, T.U64, np.int64, T.U64)))
    counts = np.diff(units.first) - window + 1
    whole = np.flatnonzero(counts > 0)
    if n < window or not len(whole):
        return none, lambda a: hashes(a, window)
    grams = hashes(np.arange(n - k + 1), k)
    least = _least(grams, window - k + 1)
    start = np.repeat(units.first[whole], counts[whole]) + (np.arange(counts[whole].sum()) - np.repeat(np.cumsum(counts[whole]) - counts[whole], counts[whole]))
    own = least[start]
    new = np.ones(len(start), bool)
    new[1:] = own[1:] != own[:-1]
    lead = np.flatnonzero(new)
    a, b = start[lead], start[np.append(lead[1:], len(start)) - 1]
    return Segments(a, b, B.bucket_keys(grams[own[lead]], n_buckets), own[lead], hashes(a, b - a + window)), lambda s: hashes(s, window)


def _count_anchors(table: DataFrame, unit: Callable, window: int, k: int, n: int) -> DataFrame:
    """(bucket, blob of anchors, blocks, occurrences, different segments)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = B.Gatherer(n)

        def rows(parts: Iterator) -> Iterator[pa.RecordBatch]:
            for bucket, (anchor, block, times, kinds) in parts:
                yield B.binary_batch(["bucket", "data"], [(bucket, B.squeeze(B.pack_sorted(anchor & LOW), block, times, kinds))])

        for batch in batches:
            for block, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                off, buf = B.expand(texts.as_py(), np.int64, np.uint8)
                for _, own, first in B.pieces(off, buf):
                    found, _ = segments(unit(own, first), window, k, n)
                    if len(found.a):
                        order = np.lexsort((found.ident, found.anchor))
                        anchor, ident = found.anchor[order], found.ident[order]
                        lead = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                        fresh = np.ones(len(anchor), np.int64)
                        fresh[1:] = (anchor[1:] != anchor[:-1]) | (ident[1:] != ident[:-1])
                        times = np.diff(np.append(lead, len(anchor)))
                        yield from rows(out.add(anchor[lead], np.full(len(lead), block), np.minimum(times, 2).astype(np.uint8), np.minimum(np.add.reduceat(fresh, lead), 65535).astype(np.uint16)))
        yield from rows(out.flush())

    return table.select("block", "texts").mapInArrow(gather, "bucket long, data binary")


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """(block, blob of the repeated anchors that it holds and whether each is split)."""
    parts = [B.expand(x.as_py(), np.uint8, np.int64, np.uint8, np.uint16) for x in table["data"]]
    parts = [(B.unpack_sorted(p[0]), *p[1:]) for p in parts]
    anchor, block, times, kinds = (np.concatenate(c) for c in zip(*parts, strict=True))
    anchor |= T.U64(table["bucket"][0].as_py()) << T.U64(B.KEPT_BITS)
    order = np.argsort(anchor)
    anchor, block, times, kinds = anchor[order], block[order], times[order], kinds[order]
    lead = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    total, load = np.add.reduceat(times.astype(np.int64), lead), np.add.reduceat(kinds.astype(np.int64), lead)
    hot = load >= max(HOT_SEGMENTS, HOT_SHARE * load[total > 1].sum())
    size = np.diff(np.append(lead, len(anchor)))
    keep = np.repeat(total > 1, size)
    anchor, block, hot = anchor[keep], block[keep], np.repeat(hot, size)[keep]
    order = np.lexsort((anchor, block))
    anchor, block, hot = anchor[order], block[order], hot[order]
    rows = []
    for i, j in _runs(block):
        fresh = np.concatenate([[True], anchor[i + 1 : j] != anchor[i : j - 1]])
        rows.append((int(block[i]), 0, B.squeeze(anchor[i:j][fresh], hot[i:j][fresh])))
    return pa.Table.from_batches([B.binary_batch(["block", "kind", "data"], rows)])


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(values):
        edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
        yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


class Hits:
    """The repeated anchors of a block."""

    def __init__(self, values: list[bytes]):
        parts = [B.expand(v, T.U64, np.bool_) for v in values]
        anchor = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, T.U64)
        hot = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, bool)
        order = np.argsort(anchor)
        self.anchor, self.hot = anchor[order], hot[order]

    def pick(self, found: Segments, window_hash: Callable, n_buckets: int) -> tuple[np.ndarray, ...]:
        """First window, last window, key and identity of each segment that must be looked up, and its anchors' places."""
        if not len(self.anchor) or not len(found.a):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, T.U64),) * 2 + (np.zeros(0, np.int64),)
        at = np.minimum(np.searchsorted(self.anchor, found.anchor), len(self.anchor) - 1)
        some = self.anchor[at] == found.anchor
        hot = some & self.hot[at]
        plain = some & ~hot
        length = (found.b - found.a + 1)[hot]
        single = np.repeat(found.a[hot], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        own = window_hash(single)
        keys = np.concatenate([found.anchor[plain], B.bucket_keys(own, n_buckets)])
        return np.concatenate([found.a[plain], single]), np.concatenate([found.b[plain], single]), keys, np.concatenate([found.ident[plain], own]), np.unique(found.at[some])


def _ship(unit: Callable, window: int, k: int, n: int) -> Callable:
    """Cogroup of a block's chunks and hits: (bucket, block, blob of keys, identities, occurrences, windows, lengths, texts)."""

    def ship(left: pa.Table, right: pa.Table) -> pa.Table:
        hits, rows = Hits([x.as_py() for x in right["data"]]), []
        key, ident, times, wide, texts = [], [], [], [], []
        if left.num_rows and right.num_rows:
            seen: dict[tuple[int, int], int] = {}
            for value in left["texts"]:
                off, buf = B.expand(value.as_py(), np.int64, np.uint8)
                for _, own, first in B.pieces(off, buf):
                    units = unit(own, first)
                    found, window_hash = segments(units, window, k, n)
                    for a, b, x, y in zip(*(c.tolist() for c in hits.pick(found, window_hash, n)[:4]), strict=True):
                        at = seen.get((x, y))
                        if at is None:
                            seen[x, y] = len(key)
                            key.append(x)
                            ident.append(y)
                            times.append(1)
                            wide.append(b - a + 1)
                            texts.append(units.span(a, b + window))
                        else:
                            times[at] = 2
            if key:
                block = left["block"][0].as_py()
                keys, idents, counts, widths = np.array(key, T.U64), np.array(ident, T.U64), np.array(times, np.uint8), np.array(wide, np.int32)
                order, lead = B.by_bucket(keys, n)
                for b in np.flatnonzero(np.diff(lead)):
                    own = order[lead[b] : lead[b + 1]]
                    data = [texts[i] for i in own]
                    rows.append((int(b), block, B.squeeze(keys[own], idents[own], counts[own], widths[own], np.array([len(d) for d in data], np.int64), np.frombuffer(b"".join(data), np.uint8))))
        return pa.Table.from_batches([B.binary_batch(["bucket", "block", "data"], rows)])

    return ship


def _solve(solver: Callable) -> Callable:
    """Group of a bucket's segments: (block, blob of identities and first and last repeated window of each run)."""

    def solve(table: pa.Table) -> pa.Table:
        owner: dict[tuple[int, bytes], int] = {}
        keys, texts, times, wide, homes = [], [], [], [], []
        for block, value in zip(table["block"].to_pylist(), table["data"], strict=True):
            key, ident, count, windows, length, data = B.expand(value.as_py(), T.U64, T.U64, np.uint8, np.int32, np.int64, np.uint8)
            data, end = data.tobytes(), 0
            for x, y, c, w, size in zip(key.tolist(), ident.tolist(), count.tolist(), windows.tolist(), length.tolist(), strict=True):
                text = data[end : end + size]
                end += size
                at = owner.get((x, text))
                if at is None:
                    owner[x, text] = at = len(texts)
                    keys.append(x)
                    texts.append(text)
                    times.append(0)
                    wide.append(w)
                    homes.append([])
                times[at] += c
                homes[at].append((block, y))
        owner.clear()
        widest: dict[int, int] = {}
        for x, w in zip(keys, wide, strict=True):
            widest[x] = max(widest.get(x, 1), w)
        found = {i: [(0, 0)] if times[i] > 1 else [] for i, x in enumerate(keys) if widest[x] == 1}  # texts of one window: equal or not
        for batch in _batches(sorted((i for i in range(len(keys)) if i not in found), key=lambda i: keys[i]), keys, texts):
            found.update(zip(batch, solver([texts[i] for i in batch], [times[i] for i in batch]), strict=True))
        out: dict[int, list[tuple[int, int, int]]] = {}
        for i, runs in found.items():
            for block, y in homes[i] if runs else ():
                out.setdefault(block, []).extend((y, a, b) for a, b in runs)
        rows = []
        for block, all_runs in out.items():
            y, a, b = zip(*all_runs, strict=True)
            rows.append((block, 1, B.squeeze(np.array(y, T.U64), np.array(a, np.int64), np.array(b, np.int64))))
        return pa.Table.from_batches([B.binary_batch(["block", "kind", "data"], rows)])

    return solve


def _batches(order: list[int], keys: list[int], texts: list[bytes]) -> Iterator[list[int]]:
    """Parts of order of about INDEX_BYTES of text that keep each key's segments together."""
    batch, size = [], 0
    for n, i in enumerate(order):
        if size >= INDEX_BYTES and keys[i] != keys[order[n - 1]]:
            yield batch
            batch, size = [], 0
        batch.append(i)
        size += len(texts[i])
    if batch:
        yield batch


class Reports:
    """Repeated runs of a block's segments by identity."""

    def __init__(self, values: list[bytes]):
        parts = [B.expand(v, T.U64, np.int64, np.int64) for v in values]
        ident, a, b = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, T.U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(ident, kind="stable")
        self.ident, self.a, self.b = ident[order], a[order], b[order]

    def covered(self, n: int, a: np.ndarray, b: np.ndarray, ident: np.ndarray, window: int) -> np.ndarray:
        """Which of n units lie in a repeated window."""
        lo, hi = np.searchsorted(self.ident, ident, "left"), np.searchsorted(self.ident, ident, "right")
        size = hi - lo
        at = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        begin, stop = np.repeat(a, size) + self.a[at], np.minimum(np.repeat(a, size) + self.b[at], np.repeat(b, size)) + window
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, begin, 1)
        np.add.at(marks, stop, -1)
        return np.cumsum(marks[:-1]) > 0


def mark_repeats(table: DataFrame, unit: Callable, window: int, k: int, solver: Callable, digest: Callable, schema: str) -> DataFrame:
    """digest(ids, units, covered, anchors) of each slice of a packed table, which is deleted with the other tables.

    covered tells the units in repeated windows; anchors has the units at which a k-gram starts that some window picked
    as its anchor and that some other window, elsewhere, picked too. digest returns an Arrow table of the given schema.
    """
    n = B.buckets(table)
    counted = _count_anchors(table, unit, window, k, n).groupBy("bucket").applyInArrow(_repeated_anchors, "block long, kind long, data binary")
    hits = written(counted, "anchors")
    shipped = table.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(_ship(unit, window, k, n), "bucket long, block long, data binary")
    reports = written(shipped.groupBy("bucket").applyInArrow(_solve(solver), "block long, kind long, data binary"), "reports")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = right["kind"].to_numpy()
        data = [x.as_py() for x in right["data"]]
        hits, runs = Hits([d for d, x in zip(data, kind, strict=True) if not x]), Reports([d for d, x in zip(data, kind, strict=True) if x])
        out = []
        for ids, texts in zip(left["ids"], left["texts"], strict=True):
            off, buf = B.expand(texts.as_py(), np.int64, np.uint8)
            own_ids = B.ids_of(ids.as_py())
            for i, own, first in B.pieces(off, buf):
                units = unit(own, first)
                covered, anchors = np.zeros(len(units.values), bool), np.zeros(0, np.int64)
                if len(hits.anchor):
                    found, window_hash = segments(units, window, k, n)
                    a, b, _, ident, anchors = hits.pick(found, window_hash, n)
                    if len(runs.ident):
                        covered = runs.covered(len(units.values), a, b, ident, window)
                out.append(digest(own_ids.slice(i, len(first) - 1), units, covered, anchors))
        return pa.concat_tables(out) if out else digest(pa.array([], pa.int64()), unit(np.zeros(0, np.uint8), np.zeros(1, np.int64)), np.zeros(0, bool), np.zeros(0, np.int64))

    both = hits.unionByName(reports)
    return written(table.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(finish, schema), "marked", table, hits, reports)
