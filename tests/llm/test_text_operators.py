"""Operators 1, 2, 4, 5, 7, 8 and 10 against brute force, with the awkward rows that every operator must take."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm import bwt_merge, decontaminate, fm_index, jaccard_join, packing, quality_rules, substring_dedup, suffix_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, chunk int, id string, n long, data binary, kind int"


def frame(spark, texts, parts=3):
    """Documents with columns whose names clash with those that operators use inside."""
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s0", "s0", None, "s1")[i % 4], None if t is None else len(t), 1, 2, "x", 3, None, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def awkward(seed=0, words=40):
    """Nulls, empties, blanks, repeats, near copies, periodic and long texts, shared passages, letters beyond ASCII."""
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choice(["ab", "Cé", "dd", "e", "fgh", "ïj", "kl", "mno"]) + str(rng.randrange(400)) for _ in range(n))
    base, passage = make(150), make(words)
    near = base.split()
    near[70] = "changed"
    return [
        None, "", " \n\t ", "one", "one", "One", "two words\n", base, base, " ".join(near), base + " tail", make(30) + " " + passage + "\n" + make(50), passage + " " + make(20), passage,
        "x y " * 120, "x y " * 60, make(2000) + " " + passage, "ö" * 900, "nospace" * 300, *(make(rng.randrange(1, 90)) for _ in range(20)), base.upper(), "a\nb\na\nb\n\n" * 9, make(12), None,
    ]


def repeated(sequences, window):
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        cover = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                cover[i : i + window] = [True] * window
        out.append(cover)
    return out


@pytest.mark.parametrize(("seed", "window", "gram"), [(1, 35, 12), (2, 6, 3)])
def test_substring_dedup(spark, seed, window, gram):
    texts = awkward(seed)
    words = [WORD.findall(t or "") for t in texts]
    want = {i: (len(w), sum(c), hashlib.sha256(" ".join(x for x, z in zip(w, c, strict=True) if not z).encode()).hexdigest()) for i, (w, c) in enumerate(zip(words, repeated(words, window), strict=True))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame(spark, texts), window, gram).collect()}
    assert got == want and any(w[1] for w in want.values())


@pytest.mark.parametrize(("seed", "length", "gram"), [(1, 400, 48), (2, 32, 8)])
def test_suffix_dedup(spark, seed, length, gram):
    texts = awkward(seed)
    data = [(t or "").encode() for t in texts]
    want = {}
    for i, (d, c) in enumerate(zip(data, repeated(data, length), strict=True)):
        spans = len(re.findall("1+", "".join("01"[x] for x in c)))
        want[i] = (len(d), sum(c), spans, hashlib.sha256(bytes(b for b, z in zip(d, c, strict=True) if not z)).hexdigest())
    rows = suffix_dedup.suffix_dedup(frame(spark, texts), length, gram, with_spans=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert all(sum(b - a + 1 for a, b in r.spans) == r.n_removed for r in rows) and any(w[1] for w in want.values())


def test_split_anchors(spark, monkeypatch):
    """The edges of a passage that very many documents share travel window by window."""
    from quillmill.llm import repeats

    monkeypatch.setattr(repeats, "HOT_SEGMENTS", 4)
    monkeypatch.setattr(repeats, "HOT_SHARE", 0.0)
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join(f"{rng.randrange(50)}" for _ in range(9)) + " " + passage + " " + " ".join(f"{rng.randrange(50)}" for _ in range(9)) for _ in range(60)]
    words = [t.split() for t in texts]
    want = [sum(c) for c in repeated(words, 6)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(frame(spark, texts), 6, 3).collect()}
    assert [got[i] for i in range(60)] == want


def test_matching_statistics():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 4, n) for n in (30, 40, 1, 25)]
    index = fm_index.FmIndex(np.concatenate([np.append(t, 0) for t in texts]))
    flat, bounds = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = index.statistics(flat, bounds, 1, 2)
    count = Counter(tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1))
    want = [max((j - i for j in range(i + 1, len(t) + 1) if count[tuple(t[i:j])] > 1), default=0) for t in texts for i in range(len(t))]
    assert got.tolist() == want


def test_merged_order():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(64, 120))) for _ in range(9)]
    texts += [texts[0][5:70], texts[3][10:60], texts[3][:45] + texts[5][20:60], b"ab" * 40, bytes(rng.choice(b"cd") for _ in range(50))]
    heavy = np.zeros(len(texts), bool)
    heavy[[7, 13]] = True
    rotations = bwt_merge.Rotations(texts)
    cuts = np.append(rotations.first, rotations.size.sum())[[0, 2, 5, 9, 14]]
    shards = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    for lo, hi in shards:
        order = rotations.sorted_shard(lo, hi, 48)
        heads = [(texts[t] * 3)[p - rotations.first[t] :][:48] for p in order for t in [rotations.text[p]]]
        assert heads == sorted(heads)
    many, interval, alone, parted = bwt_merge.merge(rotations, shards, 32, heavy)
    place = lambda p: (int(rotations.text[p]), int(rotations.place[p]))
    own = {(t, i): d[i : i + 32] for t, d in enumerate(texts) for i in range(len(d) - 31)}
    times = Counter(own.values())
    heads = [own[place(p)] for p in many]
    assert heads == sorted(heads) and {place(p) for p in many} >= {k for k, v in own.items() if times[v] > 1}
    assert [a == b for a, b in zip(heads, heads[1:])] == [a == b for a, b in zip(interval.tolist(), interval.tolist()[1:])]
    assert {place(p) for p in many} | {place(p) for p in alone} == {k for k, v in own.items() if times[v] > 1 or heavy[k[0]]}
    assert set(np.unique(parted)) <= {0, 1, 2}


def test_repeats_of_any_length_are_found_in_the_indexes():
    """Both solvers against counting, on near-equal texts, with texts that stand for several."""
    rng = random.Random(9)
    base = [rng.choice("abcdefgh") for _ in range(230)]
    texts = []
    for _ in range(40):
        t = list(base[rng.randrange(60) : rng.randrange(150, 231)])
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        texts.append(t)
    times = [1 + (i % 7 == 0) for i in range(40)]
    for window, make, join in ((100, fm_index.repeated_windows, " "), (35, fm_index.repeated_windows, " "), (64, bwt_merge.repeated_strings, ""), (32, bwt_merge.repeated_strings, "")):
        long = [(t, n) for t, n in zip(texts, times, strict=True) if len(t) >= window]
        seen = Counter()
        for t, n in long:
            seen.update({tuple(t[i : i + window]): n for i in range(len(t) - window + 1)} if n > 1 else Counter(tuple(t[i : i + window]) for i in range(len(t) - window + 1)))
        got = make(window)([join.join(t).encode() for t, _ in long], [n for _, n in long])
        want = [[i for i in range(len(t) - window + 1) if seen[tuple(t[i : i + window])] > 1] for t, _ in long]
        assert [[i for a, b in runs for i in range(a, b + 1)] for runs in got] == want


def test_nearest_smaller():
    rng = np.random.default_rng(4)
    for n in (2, 3, 17, 1000):
        values = rng.integers(1, 9, n + 1).astype(np.uint8)
        values[[0, n]] = 0
        at = np.arange(1, n)
        near = fm_index.Nearest(values)
        limit = np.maximum(values[at], 1)
        assert near.find(at, limit, 0).tolist() == [max(j for j in range(i) if values[j] < limit[i - 1]) for i in at]
        assert near.find(at, limit, 1).tolist() == [min(j for j in range(i + 1, n + 1) if values[j] < limit[i - 1]) for i in at]


def shingles(text, k=5):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("cell", [256, 4])
def test_jaccard_components(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    rng = random.Random(8)
    texts = awkward(8)
    seed = texts[7].split()
    for _ in range(60):  # copies with edits, some of them at the edge of the threshold
        t = list(seed)
        for _ in range(rng.randrange(0, 8)):
            t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(t[: rng.randrange(110, 151)]))
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, texts)).collect()}
    assert got == {i: (len(s), find(i)) for i, s in enumerate(sets)}
    kept = jaccard_join.drop_near_duplicates(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_divide_skip_equals_counting():
    rng = random.Random(2)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(20, 50))), np.uint64) for _ in range(80)]
    index = jaccard_join.InvertedIndex(sets, list(range(40)))
    for q in sets:
        want = [i for i in range(40) if 100 * len(np.intersect1d(q, sets[i])) >= 75 * len(np.union1d(q, sets[i]))]
        assert sorted(index.search(q)) == want


def test_decontamination(spark):
    texts = awkward(3)
    rng = random.Random(1)
    items = [texts[13], texts[12][:60], "one", None, "", " ".join(f"q{rng.randrange(99)}" for _ in range(30)), texts[13].upper(), "a b c d e"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (r.item_shingles, r.shared_shingles) for r in decontaminate.contaminated_pairs(frame(spark, texts), bench).collect()}
    sets = [shingles(t) for t in items]
    want = {(d, i): (len(s), len(s & shingles(t))) for d, t in enumerate(texts) for i, s in enumerate(sets) if s and 100 * len(s & shingles(t)) >= 75 * len(s)}
    assert got == want and want
    clean = decontaminate.decontaminate(frame(spark, texts), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want}) and len(clean.columns) == 11
    monkey = decontaminate.BLOCK_BYTES
    decontaminate.BLOCK_BYTES = 1  # a block for each item
    try:
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(frame(spark, texts), bench).collect()} == set(want)
    finally:
        decontaminate.BLOCK_BYTES = monkey


def test_packing(spark):
    texts = awkward(5)
    rows = packing.pack(frame(spark, texts), capacity=100, shard_docs=1000).collect()
    words, source = [WORD.findall(t or "") for t in texts], [("s0", "s0", None, "s1")[i % 4] for i in range(len(texts))]
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start_word, r.n_words))
        if r.n_words:
            bins[r.bin_id].append(r)
    for i, w in enumerate(words):
        assert sorted(pieces[i]) == ([(p, 100 * p, min(100, len(w) - 100 * p)) for p in range(-(-len(w) // 100))] or [(0, 0, 0)])
    for own in bins.values():
        assert sum(r.n_words for r in own) <= 100 and len({source[r.doc_id] for r in own}) == len(own)
        assert len({" ".join(words[r.doc_id]).translate({c: c + 32 for c in range(65, 91)}) for r in own}) == len(own)


def test_best_fit_takes_the_tightest_compatible_bin():
    assert packing.best_fit([60, 50, 30, 30, 20], ["a", "b", "a", "c", "c"], [1, 2, 3, 3, 4], 100) == [0, 1, 1, 0, 1]
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 101) for _ in range(300)), reverse=True)
    sources, clusters = [rng.randrange(6) for _ in sizes], [rng.randrange(40) for _ in sizes]
    bins: list[list[int]] = []
    for i, n in enumerate(sizes):  # every bin looked at
        fits = [b for b in range(len(bins)) if sum(sizes[j] for j in bins[b]) + n <= 100 and all(sources[j] != sources[i] and clusters[j] != clusters[i] for j in bins[b])]
        b = min(fits, key=lambda b: (100 - sum(sizes[j] for j in bins[b]), b), default=len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    assert packing.best_fit(sizes, sources, clusters, 100) == [next(b for b, x in enumerate(bins) if i in x) for i in range(len(sizes))]


def test_token_counts(spark):
    from tokenizers import Tokenizer, models, normalizers

    public = pytest.importorskip("public_tokenizers")
    vocabulary = token_counts.Vocabulary.from_sentencepiece(public.path("piece_bpe_32k.model"))
    t = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts = [*awkward(4), "日本 語😀x  a   b\t\n\n c", "▁▁ literal ▁", "  ", "<s> x</s>"]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(frame(spark, texts), vocabulary).collect()}
    assert got == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_token_counts_ties():
    """All ways through small vocabularies with many equal scores; no byte pieces, so unknown runs count once."""
    from tokenizers import Tokenizer, models

    rng = random.Random(3)
    for _ in range(60):
        pieces = [("<unk>", 0.0), *{"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): float(-rng.randrange(1, 4)) for _ in range(10)}.items()]
        counter, t = token_counts.Counter(token_counts.Vocabulary(tuple(pieces))), Tokenizer(models.Unigram(pieces, unk_id=0))
        for _ in range(20):
            text = "".join(rng.choice("abcz") for _ in range(rng.randrange(1, 12)))
            assert counter.unit(text)[0] == len(t.encode(text).ids)


def test_quality_rules(spark):
    texts = awkward(7) + ["the cat and the dog " * 3 + " ".join(f"w{i}" for i in range(60)) + " the cat of the sea" for _ in range(40)] + ["### $$$ %%% &&& *** " + " ".join(f"{i}|{i}###" for i in range(90))]
    docs = frame(spark, texts)
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    langs = defaultdict(Counter)
    classes = defaultdict(lambda: np.zeros(6))

    def kinds(t):
        n = [sum(c in s for c in t) for s in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\x0b\f\r", "#*$%&|<>")]
        return np.array([*n, len(t) - sum(n)], float)

    def js(p, q):
        p, q = p / max(p.sum(), 1e-9), q / max(q.sum(), 1e-9)
        m = (p + q) / 2
        return math.sqrt(max(0.0, sum((x * math.log2(x / z) if x > 0 else 0) + (y * math.log2(y / z) if y > 0 else 0) for x, y, z in zip(p, q, m, strict=True)) / 2))

    lang = lambda i: ("en", "fr", None)[i % 3] or ""
    for i, t in enumerate(texts):
        langs[lang(i)].update(WORD.findall(t or ""))
        classes[lang(i)] += kinds(t or "")
    verdicts = set()
    for i, t in enumerate(texts):
        w, r = WORD.findall(t or ""), rows[i]
        grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        cover = {j + d for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for d in range(5)}
        own = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(own) - len(set(own)), len(cover))
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        total, keep = sum(langs[lang(i)].values()), not failed
        if not failed and len(w) >= quality_rules.MIN_WORDS and total >= quality_rules.MIN_REFERENCE:
            common = sorted(x for x, n in langs[lang(i)].items() if n >= quality_rules.COMMON * total)
            share = [langs[lang(i)][x] / total for x in common]
            n = [w.count(x) for x in common]
            a, b = js(kinds(t), classes[lang(i)]), js(np.array([*n, len(w) - sum(n)], float), np.array([*share, 1 - sum(share)]))
            assert abs(r.class_distance - a) < 1e-9 and abs(r.word_distance - b) < 1e-7
            keep = a <= quality_rules.CLASS_LIMIT and b <= quality_rules.WORD_LIMIT
        assert (r.base_failed, r.kept) == (failed, keep)
        verdicts.add((failed, keep))
    assert (False, False) in verdicts and (False, True) in verdicts


def test_empty_tables(spark):
    docs = frame(spark, []).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    made = [
        substring_dedup.substring_dedup(docs), suffix_dedup.suffix_dedup(docs), jaccard_join.jaccard_components(docs), jaccard_join.drop_near_duplicates(docs), packing.pack(docs), quality_rules.quality_rules(docs),
        decontaminate.contaminated_pairs(docs, bench), decontaminate.decontaminate(docs, bench), token_counts.token_counts(docs, token_counts.Vocabulary((("a", 0.0),))),
    ]
    assert [d.count() for d in made] == [0] * len(made)
    some = frame(spark, ["a b"])
    assert decontaminate.contaminated_pairs(some, bench).count() == 0 and decontaminate.decontaminate(some, bench).count() == 1


def test_repeated_ids(spark):
    docs = frame(spark, ["a b c", "d e f"]).withColumn("doc_id", F.lit(7).cast("long"))
    assert jaccard_join.jaccard_components(docs).count() == 2 and jaccard_join.drop_near_duplicates(docs).count() == 2
    assert substring_dedup.substring_dedup(docs).count() == 2 and packing.pack(docs).count() == 2
