"""Operators 11, 12 and 13 against brute force, with nulls, ties, repeated rows, clashing names, long texts and empty tables."""

import base64
import gzip
import hashlib
import io
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quillmill.llm import importance, prefix_trie, store, warc


def nodes_by_brute_force(rows, share=100, heads=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = tuple(own.get(c - c % share, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    ends = {p: ",".join(str(c) for c in sorted(m) if whole[c] == p) for p, m in members.items()}
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items()),
        key=repr,
    )


def nodes(frame):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect()), key=repr)


def conversations(seed):
    """Groups that share heads, a common first turn, copies of whole conversations, prefixes of others, nulls, deep ones."""
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("ab é\U0001f600") for _ in range(n))
    common, rows = say(30), []
    for c in [*range(0, 260), *range(1000, 1030), 4096, 8192, 10**12]:
        if c in (100, 17):
            continue  # a group without its first conversation, a gap
        turns = [(t, ("user", "assistant")[t % 2], common if t == 0 and c % 3 == 0 else say(rng.randrange(3))) for t in range(rng.randrange(1, 9))]
        if c % 5 == 0:
            turns = [(t, "user", f"t{t}") for t in range(7)]
        if c % 50 == 3:
            turns = [(t, "user", f"t{t % 7}") for t in range(90 + c % 4)]
        rows += [(c, *t) for t in turns]
    rows += [(7, None, None, None), (7, 2, None, ""), (12, 1, "x", None), (None, 1, "user", "lost"), (2000, 0, "user", None)]
    rng.shuffle(rows)
    return [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(q[0], q[1]) for q in rows[:i]}]


@pytest.mark.parametrize(("seed", "ranges"), [(2, 41), (3, 1)])
def test_trie(spark, monkeypatch, seed, ranges):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 3)
    rows = conversations(seed)
    frame = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "conv_id long, turn int, role string, text string, part int, key string, n int").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert nodes(prefix_trie.conversation_trie(frame)) == nodes_by_brute_force(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_few_rows(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    for rows in ([(5, None, None, None)], [(c, 0, "user", "x" * 100_000) for c in range(4)], [(1, 0, "u", "a"), (2, 0, "u", "b")]):
        assert nodes(prefix_trie.conversation_trie(spark.createDataFrame(rows, schema))) == nodes_by_brute_force(rows)


def test_equal_turns_go_in_one_order(spark):
    rows = [(103, 1, "u", x) for x in "abc"] + [(103, 1, "u", "a")]
    schema = "conv_id long, turn int, role string, text string"
    one, two = (nodes(prefix_trie.conversation_trie(spark.createDataFrame(x, schema).coalesce(1))) for x in (rows, rows[::-1]))
    assert one == two and max(x[1] for x in one) == 4 - min(4, zlib.crc32(b"103") % 6)


def test_points_are_fewer_than_nodes():
    """Only ends, leaves and branches are made: unary nodes appear when the trie is expanded."""
    key = lambda *t: b"".join(hashlib.md5(x.encode()).digest() + len(x).to_bytes(4, "big") for x in t)
    seqs = sorted([key(*"abcdefgh"), key(*"abcdxyz"), key(*"abcdefgh", "i")])
    trie = prefix_trie.Patricia(seqs, [1, 1, 1], [1, 2, 3], -1, -1)
    assert len(trie.depth) == 5 and len(trie.nodes()["point"]) == 13  # the root, one branch, three ends


def pages():
    rng = random.Random(4)
    body = lambda n: "".join(rng.choice("<p>é\r\n x") for _ in range(n))
    same = body(500)
    rows = [(i, f"http://h/{i}", body(rng.randrange(300))) for i in range(40)]
    rows += [(90, "http://h/a b\r\nX: y", same), (50, None, same), (70, "u", same), (50, None, same), (None, "n", same), (60, "e", ""), (61, "e", None), (62, "e", None), (None, "z", "alone"), (None, "z", "alone")]
    return [*rows, (99, "long", "0123456789" * 200_000), (98, "crlf", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n")]


def records_by_brute_force(rows, min_bytes=0):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = least.get(html or "")
        refers = first if len(data) >= min_bytes and first is not None and first != i else None
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("min_bytes", "groups", "archive_bytes"), [(0, 1 << 16, 1 << 26), (10, 1, 3000)])
def test_pages_through_archives(spark, monkeypatch, tmp_path, min_bytes, groups, archive_bytes):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", groups)
    rows = pages()
    frame = spark.createDataFrame([(*r, 1, "x", b"") for r in rows], "page_id long, url string, html string, n int, least string, payload binary").repartition(3)
    got = warc.page_records(frame, str(tmp_path), min_bytes=min_bytes, archive_bytes=archive_bytes)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr) == records_by_brute_force(rows, min_bytes)
    archives = sorted((tmp_path / "archives").glob("*.warc.gz"))
    assert len(archives) > (5 if archive_bytes == 3000 else 0)
    seen = 0
    for a in archives:  # any gzip reader reads them, and each index entry is a member that stands alone
        data = a.read_bytes()
        entries = [json.loads(x) for x in (a.parent / (a.name + ".idx")).read_text().splitlines()]
        assert b"".join(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) for e in entries) == gzip.decompress(data)
        assert sum(e["length"] for e in entries) == len(data)
        assert all(warc.headers(warc.read_record(str(a), e["offset"], e["length"]).partition(warc.END)[0])["warc-record-id"] == e["id"] for e in entries)
        seen += len(entries)
    assert seen == len(rows)


def test_archives_give_payloads_back(spark, tmp_path):
    rows = pages()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    final = warc.normalise(warc.write_archives(frame, f"{tmp_path}/draft"), f"{tmp_path}/final")
    got = {r.record_id: r for r in warc.read_archives(final, with_payload=True, range_bytes=2000).collect()}
    for i, uri, html in rows:
        if i is not None and got[warc.record_id(str(i))].record_type == "response":
            assert bytes(got[warc.record_id(str(i))].payload).decode() == (html or "")
    assert got[warc.record_id("90")].uri == "http://h/a%20b%0D%0AX:%20y"


def test_no_pages(spark):
    assert warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def archive(n=30, seed=1):
    rng = random.Random(seed)
    return [warc.record("response", str(i), "http://x", "D", data, len(data)) for i in range(n) for data in [bytes(rng.choice(b"ab\r\n") for _ in range(rng.choice((0, 5, 100_000))))]]


def test_normaliser_takes_any_members():
    parts = archive()
    whole = gzip.compress(b"".join(parts))
    several = b"".join(gzip.compress(b"".join(parts[i : i + 7])) for i in range(0, 30, 7))
    split = b"".join(parts)[:177_777], b"".join(parts)[177_777:]  # members that end within a record
    for data in (whole, several, b"".join(gzip.compress(p) for p in parts), b"".join(map(gzip.compress, split)), whole + b"\0" * 99):
        out = io.BytesIO()
        entries = list(warc.rewrite(io.BytesIO(data), out))
        assert [gzip.decompress(out.getvalue()[e["offset"] : e["offset"] + e["length"]]) for e in entries] == parts
    for bad in (whole[:-200], gzip.compress(b"".join(parts)[:-90_000])):
        with pytest.raises(ValueError, match="ends"):
            list(warc.rewrite(io.BytesIO(bad), io.BytesIO()))


def test_a_wrong_digest_is_an_error(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    draft = warc.write_archives(frame, f"{tmp_path}/draft")
    path = next((tmp_path / "draft").glob("*.gz"))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"text\r\n\r\n", b"next\r\n\r\n")))
    with pytest.raises(Exception, match="another digest"):
        warc.read_archives(warc.normalise(draft, f"{tmp_path}/final")).collect()


def test_files_of_lost_attempts_go(spark, tmp_path):
    frame = spark.createDataFrame([(i, "u", f"text {i}") for i in range(20)], "page_id long, url string, html string")
    (tmp_path / "draft").mkdir()
    (tmp_path / "draft" / "lost.warc.gz").write_bytes(b"half")
    table = warc.write_archives(frame, f"{tmp_path}/draft")
    assert {p.name for p in (tmp_path / "draft").glob("*.gz")} == {r.archive.rpartition("/")[2] for r in table.collect()}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_run):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return [" ".join(w[i : i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1)], len(w)


def sample_by_brute_force(rows, target, buckets, max_run, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, max_run)[0])
    t = Counter(bucket(f) for x in target for f in features(x, max_run)[0])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out, long = [], []
    for i, text in rows:
        f, n = features(text, max_run)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        row = [i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if n >= least:
            long.append(row)
    long.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(long[: percent * len(long) // 100], 1):
        row[4] = place
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize(("buckets", "max_run", "percent", "least"), [(10_000, 1, 10, 20), (64, 3, 50, 1), (7, 2, 100, 0)])
def test_resampling(spark, buckets, max_run, percent, least):
    rng = random.Random(buckets)
    word = lambda: rng.choice(["Über", "déjà", "the", "THE", "x1", "a_b", "naïve", "日本", "don't"]) + str(rng.randrange(30))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " .,; "), (None, "only one"), (3, rows[3][1]), (3, rows[3][1] + " more"), (203, "long " * 300_000), (204, "!x!"), (205, "Ā\x00b\x7fC`d{E")]
    target = [" ".join(word() for _ in range(15)) for _ in range(9)] + [None, ""]
    docs = spark.createDataFrame([(*r, 5, "w", 1) for r in rows], "doc_id long, text string, score int, words string, rank long").repartition(3)
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, least, buckets, max_run)
    want = sample_by_brute_force(rows, target, buckets, max_run, percent, least, importance.SEED)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_resampling_without_rows(spark):
    docs, none = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert importance.resample(docs.where("doc_id is null"), none).collect() == []
    assert [r.rank for r in importance.resample(docs, none, percent=100).collect()] == [1]


def test_scores_need_no_exchange(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = importance.scored(docs, [0] * 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Python" not in plan


def test_tables_of_failed_writes_go(spark):
    folder = store.shared_dir(spark)
    with pytest.raises(Exception, match="no number"):
        store.written(spark.range(3).selectExpr("raise_error('no number') as x", "id"), "broken")
    assert not [n for n in store.listed(spark, folder) if n.startswith("broken")]
