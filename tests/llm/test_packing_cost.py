"""What packing and the join do to every byte: the same results as plain Python, at the cost of a few passes."""

import time
from collections import defaultdict

import numpy as np
import pyarrow as pa

from quillmill.llm import blocks as B
from quillmill.llm import jaccard_join, packing
from quillmill.llm import text as T

TEXTS = [
    "", " ", "a", " a", "a ", "\n\ta  B\x0b\x0c\r c\n\n", "one two three four five", "One  two\tthree four FIVE ", None, "\xa0x y \x00 \x1f z", "ÄÖ ß é" * 9,
    "same same same same same same same", "a b c d e a b c d e a b c d e", " " * 300, "x" * 5000, "tail", "  lead and trail  ", "tail", "K K k",
]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _random_texts(n: int) -> list[str]:
    rng = np.random.default_rng(8)
    return ["".join(rng.choice(list("aAbB \n\t"), int(size), p=[0.2, 0.2, 0.2, 0.1, 0.2, 0.05, 0.05])) for size in rng.integers(0, 60, n)]


def test_measured_words_are_those_of_plain_python():
    texts = TEXTS + _random_texts(3000)
    n, same = packing.measured(*T.utf8(pa.array(texts)))
    assert n.tolist() == [len(_words(t)) for t in texts]
    by_words, by_hash = defaultdict(set), defaultdict(set)
    for text, h in zip(texts, same.tolist(), strict=True):
        by_words[tuple(_words(text))].add(h)
        by_hash[h].add(tuple(_words(text)))
    assert {len(x) for x in (*by_words.values(), *by_hash.values())} == {1}


def test_spans_and_shingles_are_those_of_plain_python():
    for texts in (TEXTS + _random_texts(3000), TEXTS[:2], [], [""], ["a"]):
        buf, off = T.utf8(pa.array(texts, pa.string()))
        starts, ends, first = T.word_spans(buf, off)
        raw = [(t or "").encode().split() for t in texts]
        assert [buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [w for words in raw for w in words]
        assert np.diff(first).tolist() == [len(words) for words in raw]
        value, own = T.shingle_sets(buf, off)
        sets = [{tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set() for words in raw]
        assert np.diff(own).tolist() == [len(s) for s in sets]
        meaning = defaultdict(set)
        for i, s in enumerate(sets):
            have = value[own[i] : own[i + 1]]
            assert (have[1:] > have[:-1]).all()
            meaning[frozenset(have.tolist())].add(frozenset(s))
        assert all(len(x) == 1 for x in meaning.values()) and len(meaning) == len(set(map(frozenset, sets)))


def test_word_hashes_tell_words_apart_wherever_they_lie():
    words = [bytes([97 + i % 3]) * n for n in range(1, 140) for i in range(3)] + [b"a" * n + b"z" + b"a" * (70 - n) for n in range(70)]
    buf, off = T.utf8(pa.array([b" ".join(words).decode(), "q " + b"  ".join(words[::-1]).decode()]))
    starts, ends, first = T.word_spans(buf, off)
    h = T.word_hashes(buf, starts, ends)
    assert len(set(h[: first[1]].tolist())) == len(words)
    assert h[: first[1]].tolist() == h[first[1] + 1 :][::-1].tolist()
    assert not len(T.word_hashes(buf[:0], starts[:0], ends[:0]))


def test_exchange_of_runs_loses_nothing_and_is_smaller():
    rng = np.random.default_rng(3)
    for n, limit in ((16, 1 << 62), (204, 5000), ((1 << 23) - 5, 1 << 62)):
        out, rows, sent = B.RunGatherer(n, limit), [], []
        plain = B.Gatherer(n, limit)
        plain_bytes = 0
        for block in (7, (5 << 24) + 1, 7, 9, 9, 10):
            keys = B.bucket_keys(rng.integers(0, 2**64, 4000 if n < 1 << 20 else 50, dtype=T.U64), n)
            keys = np.concatenate([keys, keys[:20]])  # keys that several sets of a block hold
            sent += [(int(k), block) for k in keys]
            rows += out.add(keys, block)
            plain_bytes += sum(len(B.squeeze(B.pack_sorted(k & jaccard_join.LOW), b)) for _, (k, b) in plain.add(keys, np.full(len(keys), block)))
        rows += out.flush()
        plain_bytes += sum(len(B.squeeze(B.pack_sorted(k & jaccard_join.LOW), b)) for _, (k, b) in plain.flush())
        got = []
        for bucket, value in rows:
            low, blocks, size = B.runs(value)
            got += [((bucket << B.KEPT_BITS) | k, b) for k, b in zip(low.tolist(), np.repeat(blocks, size).tolist(), strict=True)]
        assert sorted(got) == sorted(sent)
        assert n > 1 << 20 or sum(len(v) for _, v in rows) < plain_bytes
        assert list(out.flush()) == []


def _least_time(f) -> float:
    def once() -> float:
        began = time.process_time()
        f()
        return time.process_time() - began

    return min(once() for _ in range(7))


def test_measuring_and_storing_cost_less_than_hashing_each_word():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)).decode() for n in rng.integers(2, 10, 3000)]
    buf, off = T.utf8(pa.array([" ".join(rng.choice(words, 300)) for _ in range(500)]))
    starts, ends, _ = T.word_spans(buf, off)
    hashing = _least_time(lambda: T.span_hashes(buf, starts, ends))
    assert _least_time(lambda: packing.measured(buf, off)) < hashing
    assert _least_time(lambda: jaccard_join._lowered(buf, off)) < hashing / 2
