"""Very long texts, an independent Feistel network, and the pipeline against brute force on awkward tables."""

import hashlib
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillmill.llm import blocks, jaccard_join, packing, pii, quality_rules, substring_dedup, suffix_dedup, token_counts
from quillmill.llm.text import U64
from tests.llm.test_text_operators import WORD, awkward, shingles


def letters(n, seed):
    return np.random.default_rng(seed).integers(97, 123, n).astype(np.uint8)


def long_words(n, seed):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**9, n)]


def test_suffix_dedup_of_texts_past_every_limit(spark):
    """17 MB pass the bits of a position, 9 MB a block and 2 MB a chunk; all else in them is random."""
    big, middle, small = letters(17 << 20, 1), letters(9 << 20, 2), letters(2 << 20, 3)
    passage = letters(900, 4)
    big[16_777_000:16_777_900] = passage  # across 2 ** 24
    middle[-900:] = passage
    small[:500] = passage[100:600]
    small[1_500_000:1_500_399] = passage[:399]
    small[1_500_399] = passage[399] ^ 1
    big[16_776_999], big[16_777_900], middle[-901], small[1_499_999], small[500] = 97, 97, 98, 99, passage[600] ^ 1  # no match is longer by chance
    texts = [x.tobytes().decode() for x in (big, middle, small)]
    rows = {r.doc_id: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), with_spans=True).collect()}
    assert {i: [tuple(s) for s in r.spans] for i, r in rows.items()} == {0: [(16_777_000, 16_777_899)], 1: [(len(middle) - 900, len(middle) - 1)], 2: [(0, 499)]}
    assert rows[2].kept_sha256 == hashlib.sha256(texts[2][500:].encode()).hexdigest() and rows[0].n_bytes == 17 << 20


def test_word_operators_on_texts_past_every_limit(spark):
    one, two = long_words(1_000_000, 5), long_words(150_000, 6)  # 10 MB and 1.5 MB
    two[1000:1100] = one[999_800:999_900]
    near = list(one)
    near[::50] = ["other"] * len(near[::50])  # nine in ten of the shingles stay
    texts = [" ".join(x) for x in (one, two, near)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs.where("doc_id < 2")).collect()}
    assert got == {0: (1_000_000, 100), 1: (150_000, 100)}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    sets = [shingles(t) for t in texts]
    linked = 100 * len(sets[0] & sets[2]) >= 75 * len(sets[0] | sets[2])
    assert found == {0: (len(sets[0]), 0), 1: (len(sets[1]), 1), 2: (len(sets[2]), 0 if linked else 2)}
    one_doc = docs.where("doc_id = 1")
    r = quality_rules.quality_rules(one_doc).collect()[0]
    assert (r.n_words, r.word_chars, r.n_repeat_words, r.base_failed) == (150_000, sum(map(len, two)), 0, False)
    pieces = packing.pack(one_doc).collect()
    assert len(pieces) == -(-150_000 // 2048) and sum(p.n_words for p in pieces) == 150_000
    counts = token_counts.token_counts(one_doc, token_counts.Vocabulary((("<unk>", 0.0), *((c, -1.0) for c in "w0123456789▁"))))
    assert counts.collect()[0].n_tokens == len(texts[1]) + 1


def test_keys_of_the_exchange():
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 2**63, 5000, dtype=U64) * U64(2)
    keys = blocks.bucket_keys(hashes, 37)
    order, first = blocks.by_bucket(keys, 37)
    assert first[0] == 0 and first[-1] == 5000 and len(first) == 38
    for b in range(37):
        own = keys[order[first[b] : first[b + 1]]]
        assert (own >> U64(blocks.KEPT_BITS) == U64(b)).all() and (np.diff(own.astype(np.int64)) >= 0).all()
        low = own & U64((1 << blocks.KEPT_BITS) - 1)
        assert (blocks.unpack_sorted(blocks.pack_sorted(low)) == low).all()
    assert len(blocks.unpack_sorted(blocks.pack_sorted(hashes[:0]))) == 0


def permuted(left, right, a, b, key, kind):
    """The Feistel network in plain Python."""
    for turn in range(1, 9):
        f = lambda x: int(hashlib.sha512(f"{key}|{kind}|{turn}|{x}".encode()).hexdigest()[:13], 16)  # noqa: E731, B023
        left, right = ((left + f(right)) % a, right) if turn % 2 else (left, (right + f(left)) % b)
    return left, right


def permuted_digits(v, key, kind):
    h = len(v) // 2
    x, y = permuted(int(v[:h]), int(v[h:]), 10**h, 10 ** (len(v) - h), key, kind)
    return f"{x:0{h}}{y:0{len(v) - h}}"


def test_pseudonyms_equal_an_independent_network(spark):
    def card(v):
        payload = permuted_digits(v[:-1], "k", "card")
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(payload)))
        return payload + str(-total % 10)

    def day(v):
        n = (date.fromisoformat(v) - date(1800, 1, 1)).days
        x, y = permuted(n // 773, n % 773, 189, 773, "k", "date")
        return (date(1800, 1, 1) + timedelta(days=x * 773 + y)).isoformat()

    def address(v):
        o = list(map(int, v.split(".")))
        x, y = permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "k", "ip")
        return ".".join(map(str, (*divmod(x, 256), *divmod(y, 256))))

    def social(v):
        area, group, serial = int(v[:3]), int(v[4:6]), int(v[7:])
        x, y = permuted(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "k", "ssn")
        return f"{x + (2 if x >= 665 else 1):03}-{y // 9999 + 1:02}-{y % 9999 + 1:04}"

    cases = [("4111111111111111", card), ("378282246310005", card), ("2024-02-29", day), ("1999-12-31", day), ("97.51.17.173", address), ("123-45-6789", social), ("899-99-9999", social)]
    rows = spark.createDataFrame([(i, f"see {v}, twice {v}") for i, (v, _) in enumerate(cases)], "__pii_row int, text string")
    got = [r.text for r in pii.pseudonymise(rows.unionByName(rows), "k").orderBy("__pii_row").collect()]
    want = [f"see {f(v)}, twice {f(v)}" for v, f in cases]
    assert got == [w for w in want for _ in (0, 1)]
    assert pii.pseudonymise(rows.limit(0), "k").count() == 0


def permuted_characters(v, key, kind, letters=26):
    """The network over characters, each within its class, in plain Python."""

    def add(x, other, turn):
        stream, out = hashlib.sha512(f"{key}|{kind}|{turn}|{other}".encode()).hexdigest(), ""
        for i, c in enumerate(x):
            by = int(stream[2 * i % 126 :][:2], 16)
            for first, size in (("0", 10), ("A", letters), ("a", letters)):
                if first <= c < chr(ord(first) + size):
                    c = chr((ord(c) - ord(first) + by) % size + ord(first))
                    break
            out += c
        return out

    left, right = v[: len(v) // 2], v[len(v) // 2 :]
    for turn in range(1, 9):
        left, right = (add(left, right, turn), right) if turn % 2 else (left, add(right, left, turn))
    return left + right


def test_phones_accounts_mails_and_secrets_equal_an_independent_network(spark):
    def refilled(shape, filling):
        it = iter(filling)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def phone(code):
        return lambda v: code + refilled(v[len(code) :], permuted_digits("".join(c for c in v[len(code) :] if c.isdigit()), "k", "phone"))

    def account(v):
        rest = permuted_characters(v.replace(" ", "")[4:], "k", "iban")
        check = 98 - int("".join(str(int(c, 36)) for c in rest + v[:2] + "00")) % 97
        new = f"{v[:2]}{check:02}{rest}"
        it = iter(new)
        return "".join(c if c == " " else next(it) for c in v)

    mail = lambda v: permuted_characters(v.split("@")[0], "k", "mail") + "@" + v.split("@")[1]
    secret = lambda v: permuted_characters(v, "k", "secret", 6)
    cases = [
        ("+49 30 1234567", phone("+49")), ("+1 (017) 555-7713", phone("+1")), ("+353 86 123 4567", phone("+353")), ("GB82 WEST 1234 5698 7654 32", account), ("DE89370400440532013000", account),
        ("ab.55@mail9.example.com", mail), ("Some.One+x@example.org", mail), ("04dbebab91ab85687d33eeaaf9ac699e1188f962", secret), ("9233A8ECF7C5B09FE5949719B6B82BC439E9329B", secret), ("0a1B" * 60, secret),
    ]
    rows = spark.createDataFrame([(i, f"see {v} now") for i, (v, _) in enumerate(cases)], "i int, text string")
    got = [r.text for r in pii.pseudonymise(rows, "k").orderBy("i").collect()]
    assert got == [f"see {f(v)} now" for v, f in cases] and all(g != f"see {v} now" for g, (v, _) in zip(got, cases, strict=True))


@pytest.fixture
def tables(tmp_path):
    texts = awkward(11)
    texts += [" ".join(long_words(60_000, 9)), "call +49 30 1234567 or mail some.one@example.com about 4111 1111 1111 1111 today please"]
    items = [texts[13], "nothing of this kind is anywhere in the documents at all", None, ""]
    n = len(texts)
    docs = {"doc_id": list(range(n)), "text": texts, "lang": [("en", None)[i % 2] for i in range(n)], "source": [("s0", "s1", None)[i % 3] for i in range(n)], "n_chars": [None if t is None else len(t) for t in texts]}
    docs |= {"block": [1] * n, "node": ["x"] * n, "n": [None] * n, "score": [0.5] * n}
    pq.write_table(pa.table({k: pa.array(v, pa.int64()) if k in ("block", "n") else pa.array(v) for k, v in docs.items()}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2, 3, 4], "text": items}), tmp_path / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([0, 3], pa.int64()), "quality": pa.array([1, 1], pa.int64()), "toxic": pa.array([0, 0], pa.int64())}), tmp_path / "labels.parquet")
    return str(tmp_path), texts, items, docs["source"]


def test_pipeline_against_brute_force(spark, tables):
    import corpus_pipeline

    folder, texts, items, source = tables
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    leaks = {i for i, s in enumerate(sets) for item in map(shingles, items) if item and 100 * len(item & s) >= 75 * len(item)}
    kept = {i for i in range(len(texts)) if root[i] == i} - leaks
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append((r.start_word, r.n_words))
        if r.n_words:
            bins[r.bin_id].append(r)
    assert pieces.keys() == kept and leaks
    for i in kept:
        n = len(WORD.findall(texts[i] or ""))
        assert sorted(pieces[i]) == ([(s, min(2048, n - s)) for s in range(0, n, 2048)] or [(0, 0)])
    for own in bins.values():
        assert sum(r.n_words for r in own) <= 2048 and max(Counter(source[r.doc_id] for r in own).values()) == 1


def test_pipeline_on_empty_tables_and_its_pii_stage(spark, tables, tmp_path):
    import corpus_pipeline

    folder, texts, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.pseudonymise(spark, docs, folder)
    assert out.columns == docs.columns and out.where("n_chars <> length(text) or (text is null) <> (n_chars is null)").count() == 0
    last = out.where(F.col("doc_id") == len(texts) - 1).first().text
    assert re.fullmatch(r"call \+49 \d\d \d{7} or mail [a-z]{4}\.[a-z]{3}@example\.com about \d{4} \d{4} \d{4} \d{4} today please", last) and last != texts[-1]
    empty = tmp_path / "empty"
    empty.mkdir()
    for name in ("documents", "benchmark", "labels"):
        pq.write_table(pq.read_table(f"{folder}/{name}.parquet").slice(0, 0), empty / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_search_of_large_blocks_ships_few_rows(spark, monkeypatch):
    """Of sets that all link almost none are shipped to other cells; the rows of sets that do not are bounded by their shingles."""
    monkeypatch.setattr(jaccard_join, "CELL", 16)
    shipped = []
    real = jaccard_join.searches
    monkeypatch.setattr(jaccard_join, "searches", lambda *a: (lambda out: shipped.append(out.count()) or out)(real(*a)))
    rng = np.random.default_rng(12)
    base = long_words(120, 13)
    copies = []
    for _ in range(1200):
        t = list(base)
        t[rng.integers(120)] = f"x{rng.integers(10**9)}"
        copies.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.jaccard_components(docs).collect()} == {0}
    alike = sum(shipped)
    shipped.clear()
    apart = [" ".join(base[:60] + long_words(60, 1000 + i)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string")
    assert jaccard_join.jaccard_components(docs).where("doc_id = component_id").count() == 300
    cells = -(-300 // 16)
    assert alike <= 1200 and sum(shipped) <= 300 * cells
