"""Vectorised text kernels on Arrow's UTF-8 buffers: words, hashes and windows without a Python string per word.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are 64-bit and always mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE = np.random.default_rng(20240501).integers(0, 2**63, 256, dtype=U64) * U64(2) + U64(1)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FLAT = np.where(IS_WORD, _LOWER, np.uint8(0x20))
#: Masks of the first 0 to 8 bytes of a number as it lies in memory.
_FIRST = np.tril(np.full((9, 8), 255, np.uint8), -1).view(U64).ravel()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = 1 << 21):
    """Ranges of texts that hold up to limit bytes, or one longer text."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more entry at the end)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = (buf - np.uint8(9) > np.uint8(4)) & (buf != np.uint8(0x20))  # IS_WORD, without a look-up for each byte
    start, last = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    begin, end = off[off < len(buf)], off[off > 0] - 1
    start[begin], last[end] = word[begin], word[end]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def joined_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that hold each text's words, A-Z in lower case and joined by one space; where each text's start and end; its number of words."""
    flat = _FLAT[buf]
    word = flat != np.uint8(0x20)
    start, keep = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    keep[1:] |= word[:-1]
    begin = off[off < len(buf)]
    start[begin] = keep[begin] = word[begin]
    gone = np.flatnonzero(~keep)
    joined, first = flat[keep] if len(gone) else flat, off - np.searchsorted(gone, off)
    ends = first[1:].copy()
    some = np.flatnonzero(ends > first[:-1])
    ends[some] -= joined[ends[some] - 1] == np.uint8(0x20)
    return joined, first[:-1], ends, np.diff(np.searchsorted(np.flatnonzero(start), off))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span."""
    n = len(buf)
    if not n:
        return np.zeros(0, U64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[buf] * _power(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts] + (ends - starts).astype(U64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word, eight at a time; cheaper than span_hashes, of which long words (over 64 bytes) have theirs."""
    size = ends - starts
    eight = np.lib.stride_tricks.as_strided(np.append(buf, np.zeros(8, np.uint8))[:8].view(U64), (len(buf) + 1,), (1,), writeable=False)
    out = mix((eight[starts] & _FIRST[np.minimum(size, 8)]) * U64(_BASE) + size.astype(U64))
    far = np.flatnonzero((size > 8) & (size <= 64))
    at, rest = starts[far] + 8, size[far] - 8
    while len(far):
        out[far] = mix(out[far] * U64(_BASE) + (eight[at] & _FIRST[np.minimum(rest, 8)]))
        more = rest > 8
        far, at, rest = far[more], at[more] + 8, rest[more] - 8
    long = np.flatnonzero(size > 64)
    if len(long):
        out[long] = span_hashes(buf, starts[long], ends[long])
    return out


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values."""
    n = len(values)
    if n < k:
        return np.zeros(0, U64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(values * _power(_BASE, n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * _power(_INVERSE, n)[: n - k + 1])


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTE[buf]


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values."""
    if len(values) < w:
        return values[:0]
    out, have = values, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = w - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles of each text and their offsets; a shorter text has its whole sequence as one."""
    starts, ends, first = word_spans(buf, off)
    words = word_hashes(buf, starts, ends)
    n_words = np.diff(first)
    n = np.where(n_words < k, np.minimum(n_words, 1), n_words - k + 1)
    own = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(own[-1]) + np.repeat(first[:-1] - own[:-1], n)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    whole = np.zeros(len(at), bool)
    whole[own[short]] = True
    value = np.empty(len(at), U64)
    value[~whole] = gram_hashes(words, k)[at[~whole]]
    value[whole] = [_whole(words[first[i] : first[i + 1]]) for i in short]
    for i, j in zip(own[:-1][n > 1].tolist(), own[1:][n > 1].tolist(), strict=True):  # far cheaper than an order over all texts
        value[i:j].sort()
    keep = np.ones(len(value), bool)
    keep[1:] = value[1:] != value[:-1]
    keep[own[:-1][n > 0]] = True
    return value[keep], own - np.searchsorted(np.flatnonzero(~keep), own)


def _whole(words: np.ndarray) -> U64:
    """One value for a sequence of under k words; its length keeps it apart from shingles."""
    return mix(gram_hashes(words, len(words)) + U64(len(words)))[0]


def set_ids(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One 64-bit identity for each set of values, as a signed integer; 0 stands for the empty set."""
    twisted = mix(values + U64(0x1234567))
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(twisted * mix(twisted), out=sums[1:])
    ids = mix(sums[off[1:]] - sums[off[:-1]] + np.diff(off).astype(U64) * U64(_BASE))
    return np.where(np.diff(off) > 0, ids | U64(1), U64(0)).view(np.int64)
