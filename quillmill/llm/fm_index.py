"""A compressed FM-index over words, searched for many texts at once.

The Burrows-Wheeler transform of the texts (words as symbols, texts kept apart by symbol 0) is held in a wavelet
matrix: one bit vector for each bit of a symbol, packed into 64-bit words with running counts. Backward search extends
matches to the left; where a match cannot be extended, it is cut to its parent interval by the common prefixes of
neighbouring suffixes. That gives the matching statistics of a text: the length of the longest match at each word.
"""

from __future__ import annotations

import numpy as np

from quillmill.llm import text as T


class BitVector:
    """Bits in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little").view(np.uint64)
        self.counts = np.zeros(len(self.packed) + 1, np.uint32)
        np.cumsum(np.bitwise_count(self.packed), out=self.counts[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones come before each place."""
        word = at >> 6
        inside = np.bitwise_count(self.packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
        return self.counts[word].astype(np.int64) + inside


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append((level, BitVector(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where row at of the transform leads in the lowest level, as if it held symbol."""
        for level, vector, zeros in self.levels:
            ones = vector.ones(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at


class Nearest:
    """Nearest smaller values of an array of bytes, by a tree of minima (one more byte for each value)."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(values) > 1:
            if len(values) % 2:
                values = np.append(values, values.dtype.type(np.iinfo(values.dtype).max))
                self.levels[-1] = values
            values = np.minimum(values[::2], values[1::2])
            self.levels.append(values)

    def find(self, at: np.ndarray, limit: np.ndarray, side: int) -> np.ndarray:
        """Nearest place before (side 0) or after (side 1) each at whose value is below limit; there must be one."""
        out = at - 1 + 2 * side
        far = np.flatnonzero(self.levels[0][out] >= limit)
        if not len(far):
            return out
        node, level, limit, todo = at[far], 0, limit[far], np.arange(len(far))
        top = np.zeros(len(far), np.int64)
        while len(todo):  # up, to the first sibling on that side that holds a smaller value
            own = node[todo]
            good = (own & 1) != side
            good[good] = self.levels[level][own[good] ^ 1] < limit[todo[good]]
            top[todo[good]] = level
            node[todo[good]] ^= 1
            todo = todo[~good]
            node[todo] >>= 1
            level += 1
        for level in range(int(top.max()), 0, -1):  # down, by the child nearer to at
            down = np.flatnonzero(top >= level)
            child = 2 * node[down] + 1 - side
            child ^= self.levels[level - 1][child] >= limit[down]
            node[down] = child
        out[far] = node
        return out


class FmIndex:
    """Index of sequences of symbols 1 and up, each followed by symbol 0; heavy: symbols whose text stands for two equal ones.

    Suffixes are sorted by as many symbols as the longest sequence has. Per symbol it holds about 1.5 bits for each bit
    of the alphabet, two bytes of common prefixes (four beyond sequences of 127) and 1.5 bits of weights.
    """

    def __init__(self, symbols: np.ndarray, heavy: np.ndarray | None = None):
        n = self.n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        depth = 1 << int(max(1, np.diff(ends, prepend=-1).max(initial=1))).bit_length()
        ranks, r, h = [], symbols.astype(np.int64), 1
        while True:
            r = np.unique(r, return_inverse=True)[1].astype(np.int64) + 1
            ranks.append(np.concatenate([r, np.zeros(2 * depth, np.int64)]))
            if h >= depth:
                break
            r = r * (n + 1) + ranks[-1][h : n + h]
            h *= 2
        suffixes = np.argsort(ranks[-1][:n], kind="stable")
        common = np.zeros(n + 1, np.min_scalar_type(2 * depth))  # of rows j - 1 and j, plus one; 0 at both ends
        common[1:n] = self._common(ranks, suffixes) + 1
        self.common, self.nearest = common, Nearest(common)
        self.heavy = BitVector(np.zeros(n, bool) if heavy is None else heavy[suffixes])
        transform = symbols[suffixes - 1]
        bits = max(1, int(symbols.max()).bit_length())
        self.matrix = WaveletMatrix(transform, bits)
        size = 1 << bits
        count = np.bincount(symbols, minlength=size)
        every = np.arange(size)
        self.shift = np.cumsum(count) - count - self.matrix.follow(every, np.zeros(size, np.int64))

    @staticmethod
    def _common(ranks: list[np.ndarray], suffixes: np.ndarray) -> np.ndarray:
        a, b, same = suffixes[:-1], suffixes[1:], np.zeros(len(suffixes) - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            same += (ranks[level][a + same] == ranks[level][b + same]) * (1 << level)
        return same

    def occurrences(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return hi - lo + self.heavy.ones(hi) - self.heavy.ones(lo)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose suffixes start with symbol and go on as those of [lo, hi)."""
        m = len(lo)
        found = self.matrix.follow(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.concatenate([self.shift[symbol]] * 2)
        return found[:m], found[m:]

    def statistics(self, symbols: np.ndarray, first: np.ndarray, least: int, times: int) -> np.ndarray:
        """For each symbol the length of the longest match that starts there and occurs so many times.

        Matches that end before a text's first least symbols are not followed: no match of that length can start
        further left.
        """
        out = np.zeros(len(symbols), np.int64)
        start, at = first[:-1].copy(), first[1:].copy()
        lo, hi, size = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        while True:
            on = (at > start) & (at - start + size >= least)
            if not on.all():
                start, at, lo, hi, size = (x[on] for x in (start, at, lo, hi, size))
            if not len(at):
                return out
            x, y = self.extend(symbols[at - 1], lo, hi)
            good = (y > x) & (self.occurrences(x, y) >= times)
            lo, hi = np.where(good, x, lo), np.where(good, y, hi)
            size = size + good
            at = at - good
            out[at[good]] = size[good]
            stuck = np.flatnonzero(~good)
            if len(stuck):
                root = size[stuck] == 0
                at[stuck[root]] -= 1
                lo[stuck[root]], hi[stuck[root]] = 0, self.n
                stuck = stuck[~root]
                a, b = lo[stuck], hi[stuck]
                left, right = self.common[a], self.common[b]
                depth = np.maximum(left, right)  # 1 and up, but for the whole index
                whole = depth == 0
                lo[stuck], hi[stuck] = self._wider(a, left, depth, 0), self._wider(b, right, depth, 1)
                size[stuck] = np.where(whole, 0, depth.astype(np.int64) - 1)

    def _wider(self, edge: np.ndarray, own: np.ndarray, depth: np.ndarray, side: int) -> np.ndarray:
        """The interval's edge after a cut to depth: it moves where the common prefix there is that long."""
        out, some = edge.copy(), np.flatnonzero((own == depth) & (depth > 0))
        out[some] = self.nearest.find(edge[some], depth[some], side)
        return out


def repeated_windows(window: int):
    """Solver: the runs of windows of so many words that occur again in another of the texts, or again in the same.

    times tells how many equal texts each stands for.
    """

    def solve(texts: list[bytes], times: list[int]) -> list[list[tuple[int, int]]]:
        if not texts:
            return []
        data = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts, ends, first = T.word_spans(data, off)
        symbols = np.unique(T.span_hashes(data, starts, ends), return_inverse=True)[1].astype(np.int64) + 1
        heavy = np.repeat(np.array(times) > 1, np.diff(first))
        index = FmIndex(np.insert(symbols, first[1:], 0), np.insert(heavy, first[1:], False))
        match = index.statistics(symbols, first, window, 2) >= window
        return [runs(match[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]

    return solve


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))
