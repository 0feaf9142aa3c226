"""Merged Burrows-Wheeler transforms: repeated strings of a set of texts without sorting all their suffixes together.

Each shard of the texts has its own transform, from a suffix sort of its own. The transforms are merged by iterative
interleave refinement: the interleave holds the rows of all shards in an order that is right for some symbols; sorting
it stably by the symbols that the transforms hold there makes one that is right for one symbol more. A symbol stands
for STEP bytes, so length / STEP refinements order all suffixes by their first bytes. Rows that agree so far are a
block; a row that parts from all others has its place, and its common prefix with the rows that are followed is known
to a symbol, so only blocks of two rows and more are refined on. What is still a block at the end is a repeated interval.

Texts count as circular, so that no symbol is short; refinement starts from the rows where a string of length bytes
that lies in one text ends. A text may stand for several equal ones: a row of it that parts from all others is repeated.
"""

from __future__ import annotations

import numpy as np

from quillmill.llm.fm_index import runs

STEP, SHARDS = 16, 4


def _stable_order(values: np.ndarray) -> np.ndarray:
    """Stable order of values from 0 to 2**32 - 1, by one or two passes of radix sort."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if len(values) and values.max() > 0xFFFF:
        order = order[np.argsort((values >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def _ranks(values: np.ndarray) -> np.ndarray:
    """Dense ranks of values."""
    order = np.argsort(values)
    new = np.ones(len(values), np.int64)
    new[1:] = values[order][1:] != values[order][:-1]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


class Rotations:
    """All rotations of the texts: position by position, with symbols of STEP bytes."""

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        n = int(self.size.sum())
        self.base = np.repeat(self.first, self.size)
        self.length = np.repeat(self.size, self.size)
        self.place = np.arange(n) - self.base
        self.text = np.repeat(np.arange(len(texts)), self.size)
        data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
        eight, step = data, self.ahead(1)
        for bits in (8, 16, 32):  # one byte to two, to four, to eight
            eight = (eight << np.uint64(bits)) | eight[step]
            step = step[step]
        rank = _ranks(eight)
        self.symbol = _ranks(rank * (n + 1) + rank[step])

    def ahead(self, by: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Position so many bytes further on in each text, of all positions or of some."""
        return self.base[at] + (self.place[at] + by) % self.length[at]

    def sorted_shard(self, lo: int, hi: int, depth: int) -> np.ndarray:
        """Positions lo to hi - 1 (whole texts), in the order of at least depth bytes from each.

        Prefix doubling, which looks only at positions that still tie.
        """
        order = np.argsort(self.symbol[lo:hi]) + lo
        rank = np.empty(hi - lo, np.int64)
        key, h, open_rows = self.symbol[order], STEP, np.arange(hi - lo)
        while True:
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            lead = np.flatnonzero(new)
            size = np.diff(np.append(lead, len(key)))
            group = np.repeat(open_rows[lead], size)  # the place in the order at which the tie starts
            rank[order[open_rows] - lo] = group
            tied = np.repeat(size > 1, size)
            open_rows, group = open_rows[tied], group[tied]
            if h >= depth or not len(open_rows):
                return order
            own = order[open_rows]
            key = group * (hi - lo) + rank[self.ahead(h, own) - lo]
            turn = np.argsort(key)
            key, order[open_rows] = key[turn], own[turn]
            h *= 2


def merge(rotations: Rotations, shards: list[tuple[int, int]], length: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where repeated strings of length bytes start, in merged order, and their intervals' numbers; the same starts of
    strings that only heavy texts hold; and for each position the refinement in which its row parted from all others
    (0: never, or it was not reached).
    """
    position = np.concatenate([rotations.sorted_shard(lo, hi, length + STEP) for lo, hi in shards])
    n, steps = len(position), length // STEP
    row = np.empty(n, np.int64)
    row[position] = np.arange(n)
    back = rotations.ahead(-STEP, position)
    transform, back = rotations.symbol[back], row[back]
    ends = (rotations.place >= length) | (rotations.place == 0)
    live = np.flatnonzero((ends & (rotations.length >= length))[position])  # shard behind shard: right for no symbol
    block, parted, alone = np.zeros(len(live), np.int64), np.zeros(n, np.int32), [np.zeros(0, np.int64)]
    for step in range(1, steps + 1):
        if not len(live):
            break
        symbol = transform[live]
        turn = _stable_order(symbol)
        symbol, below, live = symbol[turn], block[turn], back[live[turn]]
        new = np.ones(len(live), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (below[1:] != below[:-1])
        single = new & np.append(new[1:], True)
        gone = position[live[single]]
        parted[gone] = step
        gone = gone[heavy[rotations.text[gone]]]
        alone.append(rotations.ahead(STEP * (step - steps), gone))
        block, live = np.cumsum(new)[~single], live[~single]
    return position[live], block, np.concatenate(alone), parted


def repeated_strings(length: int):
    """Solver: the runs of strings of so many bytes that start again in another of the texts, or again in the same.

    times tells how many equal texts each stands for.
    """
    if length % STEP:
        raise ValueError(f"length must be a multiple of {STEP}")

    def solve(texts: list[bytes], times: list[int]) -> list[list[tuple[int, int]]]:
        if not texts:
            return []
        shards = min(SHARDS, len(texts))
        dealt = [i for s in range(shards) for i in range(s, len(texts), shards)]  # likely copies come one after another
        rotations = Rotations([texts[i] for i in dealt])
        cuts = np.cumsum([0] + [len(range(s, len(texts), shards)) for s in range(shards)])
        bounds = np.append(rotations.first, rotations.size.sum())[cuts].tolist()
        many, _, alone, _ = merge(rotations, list(zip(bounds[:-1], bounds[1:], strict=True)), length, np.array(times)[dealt] > 1)
        found = np.zeros(int(rotations.size.sum()), bool)
        found[many] = found[alone] = True
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for i, first, size in zip(dealt, rotations.first.tolist(), rotations.size.tolist(), strict=True):
            out[i] = runs(found[first : first + size - length + 1])
        return out

    return solve
