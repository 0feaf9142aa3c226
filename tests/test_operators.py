import bisect
import random
import struct
import zipfile
from collections import Counter

from pyspark.sql import functions as F

from quillmill.functions.textnorm import TERMINAL
from quillmill.operators import dedup, ledger, lid, lines, membership, records
from quillmill.sources import bencode, files, tables
from quillmill.streaming import landing


def model_reflow(all_lines):
    """Paragraphs by walking the lines once, written for this test."""
    blocks, now = [], []
    for x in [*all_lines, ""]:
        if x:
            now.append(x)
        elif now:
            blocks, now = [*blocks, now], []
    if not blocks:
        return []
    w = sorted(len(x) for b in blocks for x in b)
    limit, out = 0.6 * w[len(w) // 2], []
    for b in blocks:
        if out and (out[-1][-1].endswith("-") or b[0][0].islower() or (len(out[-1][-1]) >= limit and out[-1][-1][-1] not in TERMINAL)):
            out[-1] = out[-1] + b
        else:
            out.append(b)
    texts = []
    for p in out:
        t = p[0]
        for x in p[1:]:
            t = t[:-1] + x if t.endswith("-") and t[-2:-1].isalpha() and x[0].islower() else t + " " + x
        texts.append(t)
    return texts


def test_reflow_equals_model(spark):
    rng = random.Random(4)
    docs = {i: [rng.choice(["", "Abc def", "ghi jkl mno-", "Pqr stu.", "vwx", "A longer line of text here", "yz-"]) for _ in range(rng.randint(0, 14))] for i in range(300)}
    rows = [(i, j, x) for i, d in docs.items() for j, x in enumerate(d)]
    got = {}
    for r in lines.paragraphs(spark.createDataFrame(rows, "doc_id long, pos int, line string")).collect():
        got.setdefault(r.doc_id, []).append((r.para, r.text))
    for i, d in docs.items():
        assert [t for _, t in sorted(got.get(i, []))] == model_reflow(d)


def test_drop_lines(spark):
    text = ["Head 1", "- 12 -", "xiv", "s. 4", "12345", "..", "Good line of text", "x" * 80, "", "Head 2", "Head 3", "Head 4", "Head 5", "Ends (a)"] + ["Other 1"] * 4
    kept = [r.line for r in lines.drop_lines(lines.split_lines(spark.createDataFrame([(1, "\n".join(text))], "doc_id long, text string"))).orderBy("pos").collect()]
    assert kept == ["Good line of text", "x" * 80, "", "Ends (a)"] + ["Other 1"] * 4


def test_boilerplate_edges(spark):
    paras = [(1, i, t) for i, t in enumerate(["Copyright 2020" + "x" * 86, "Middle copyright " + "y" * 900, "z" * 900, "ISBN 1" + "w" * 20])] + [(2, 0, "All rights reserved" + "v" * 800)]
    kept = {(r.doc_id, r.para) for r in lines.drop_boilerplate(spark.createDataFrame(paras, "doc_id long, para long, text string")).collect()}
    assert kept == {(1, 1), (1, 2), (2, 0)}


def test_clean_keeps_letters(spark):
    rows = [(1, "One line of text\nthat goes on.\n\nSecond paragraph</doc>."), (2, None), (3, "")]
    got = {r.doc_id: r.body for r in lines.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "One line of text that goes on.\n\nSecond paragraph.", 2: "", 3: ""}


def test_members_equal_bisect(spark):
    rng = random.Random(1)
    runs = [rng.choice([0, 1, 3, 50, 5000]) for _ in range(400)]
    ends, at = [], 1000
    for n in runs:
        at += n
        ends.append(at)
    keys = [rng.randint(900, at + 100) for _ in range(2000)]
    want = {k for k in keys if 1000 <= k < at and bisect.bisect_right(ends, k) % 2 == 0}
    table = spark.createDataFrame([("c", i, n) for i, n in enumerate(runs)], "catalog string, pos long, run_len long")
    found = membership.members(spark.createDataFrame([(k,) for k in keys], "isbn12 long"), membership.runs_to_intervals(table, 1000, block=37))
    assert {r.isbn12 for r in found.collect()} == want and found.count() == sum(k in want for k in keys)


def test_duplicates_without_valid_row(spark):
    rows = [("9780306406158", "", 1), ("9780306406159", "t", 2), ("", "a", 3), ("", "b", 4)]
    got = {r.input_pos: (r.elim_category, r.elim_reason) for r in dedup.mark_duplicates(spark.createDataFrame(rows, "isbn13 string, title string, input_pos long")).collect()}
    assert got[2][0] == "invalid_isbn" and got[1] == ("duplicate", "Duplicate of ISBN 9780306406159: same first 12 digits, this copy has a wrong check digit")
    assert got[4] == ("duplicate", "Duplicate ISBN") and got[3][0] == "invalid_isbn"


def test_ledger_latest_is_idempotent(spark):
    log = spark.createDataFrame([(1, "a", 5, 1), (1, "b", 5, 2), (2, "c", 1, 1)], "key int, status string, updated int, seq int")
    once = ledger.latest(log, ["key"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, ledger.latest(once, ["key"]).collect())) == [(1, "b", 5, 2), (2, "c", 1, 1)]


def test_record_dialects(spark):
    raw = [" <doc>\n<metadata>\n<isbn>1</isbn>\n<isbn>2</isbn></metadata>\n<content>a</content>b</content>\n</doc>", "Title: x\nISBN: 7\nLicence: cc\n\nBody\n\nmore", "No header: here\n\nBody", ""]
    got = [(dict(r.r.meta), r.r.body) for r in spark.createDataFrame(list(enumerate(raw)), "i int, t string").select("i", records.split_record(F.col("t")).alias("r")).orderBy("i").collect()]
    assert got == [({"isbn": "2"}, "a</content>b"), ({"title": "x", "isbn": "7", "license": "cc"}, "Body\n\nmore"), ({}, raw[2]), ({}, "")]


def test_vote_and_audit(spark):
    rows = [(1, "x" * 100, "tr", 0.5), (1, "y" * 100, "en", 0.5), (2, "x" * 99, "tr", 1.0), (3, "x" * 800, "en", 1.0), (3, "x" * 100, "tr", 1.0)]
    docs = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "doc_id long")
    got = {r.doc_id: (r.decision, r.summary) for r in lid.audit(docs, lid.vote(spark.createDataFrame(rows, "doc_id long, part string, lang string, prob double")), "tr").collect()}
    assert got == {1: ("keep", "en 50%, tr 50%"), 2: ("cull", ""), 3: ("cull", "en 89%, tr 11%"), 4: ("cull", "")}


def test_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labelled = lid.label(lid.chunks(docs), lid.profiles(docs)).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").where("length(part) > 300")
    right = labelled.agg(F.avg((F.col("lang") == F.col("truth")).cast("int")).alias("r")).first().r
    assert right > 0.9


def test_catalog_files(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes("﻿isbn13,title,note\n1,\"a \"\"q\"\"\nb\",NA\n2,,\n".encode())
    rows = tables.read_catalog(spark, str(path))
    assert rows.columns == ["isbn13", "title", "note"] and sorted(map(tuple, rows.collect())) == [("1", 'a "q"\nb', "NA"), ("2", "", "")]
    tables.write_catalog(rows, str(tmp_path / "out"), compressed=True)
    assert sorted(map(tuple, tables.read_catalog(spark, str(tmp_path / "out"), ["title"]).collect())) == [("",), ('a "q"\nb',)]
    tables.write_catalog(rows, str(tmp_path / "marked"), bom=True)
    assert all(f.read_bytes().startswith(b"\xef\xbb\xbfisbn13,") for f in (tmp_path / "marked").glob("part-*.csv"))
    assert tables.read_catalog(spark, str(tmp_path / "marked")).columns == rows.columns
    tables.append_catalog(rows, str(tmp_path / "more"), ["isbn13"])
    tables.append_catalog(rows, str(tmp_path / "more"), ["isbn13"])
    assert tables.read_catalog(spark, str(tmp_path / "more")).count() == 4


def test_cache_and_snapshots(spark, tmp_path):
    meta = "title string"
    for title in ("old", None):
        rows = spark.createDataFrame([("1", (title,) if title else None), ("2", ("x",))], f"isbn string, meta struct<{meta}>")
        tables.append_cache(rows, str(tmp_path / "cache"))
    got = {r.isbn: r.meta for r in tables.read_cache(spark, str(tmp_path / "cache"), meta).collect()}
    assert got["1"] is None and got["2"].title == "x"
    (tmp_path / "cache" / "older.json").write_text('{"isbn":"1","meta":{"title":"oldest"}}\n{"isbn":"3","meta":{"title":"a"}}\n{"isbn":"3","meta":{"title":"b"}}\n')
    got = {r.isbn: r.meta for r in tables.read_cache(spark, str(tmp_path / "cache"), meta).collect()}
    assert got["1"] is None and got["3"].title == "b"
    for n in (1, 2):
        tables.write_snapshot(spark.range(n), str(tmp_path / "snap"))
    assert tables.read_snapshot(spark, str(tmp_path / "snap")).count() == 2
    tables.write_records(spark.createDataFrame([("A/B.txt", "t")], "path string, record string"), str(tmp_path / "rec"))
    assert spark.read.parquet(str(tmp_path / "rec")).count() == 1


def test_book_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.TXT").write_bytes(b"ok \xff")
    with zipfile.ZipFile(tmp_path / "a" / "y.epub", "w") as z:
        z.writestr("b.xhtml", "two")
        z.writestr("a.html", "one &amp;")
        z.writestr("style.css", "no")
    (tmp_path / "z.epub").write_bytes(b"broken")
    got = {r.path.rsplit("/", 1)[-1]: (r.raw, r.error) for r in files.read_books(files.scan_books(spark, str(tmp_path))).collect()}
    assert got["x.TXT"] == ("ok �", None) and got["y.epub"] == ("one &\ntwo", None) and got["z.epub"][0] is None and "BadZipFile" in got["z.epub"][1]


def test_bencoded_bitmaps(spark, tmp_path):
    parts = {"md5": [3, 4, 5], "north": [1]}
    body = b"".join(f"{len(k)}:{k}".encode() + f"{4 * len(v)}:".encode() + struct.pack(f"<{len(v)}I", *v) for k, v in parts.items())
    (tmp_path / "codes.benc").write_bytes(b"d" + body + b"e")
    spark.dataSource.register(bencode.BitmapSource)
    read = lambda path=f"{tmp_path}/codes.benc", **o: sorted(map(tuple, spark.read.format("bencoded_bitmaps").options(**o).load(str(path)).collect()))
    assert read(f"file://{tmp_path}/codes.benc") == read(f"file:{tmp_path}/codes.benc") == read()
    assert read() == [("md5", 0, 0, 3), ("md5", 0, 1, 4), ("md5", 0, 2, 5), ("north", 1, 0, 1)] == read(partBytes=6) and read(catalogs="north") == [("north", 1, 0, 1)]


def test_stream_cleans_each_file_once(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "check")]
    for n in (1, 2):
        spark.createDataFrame([(n, "Some text here.\n\nMore text.")], "doc_id long, text string").write.mode("append").parquet(where[0])
        landing.clean_stream(spark, *where).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(where[1]).collect()) == [1, 2]


def test_sweep_over_borders_catalogs_and_hot_keys(spark):
    rng = random.Random(5)
    spans = [(c, lo, lo + rng.choice([1, 2, 40, 9000])) for c in ("a", "b", "ü", "wide") for lo in rng.sample(range(5000), 60)] + [("wide", 0, 6000)]
    keys = [(i, rng.choice([17, rng.randrange(-5, 6100)]), "x") for i in range(3000)] + [(None, None, None), (9, 4999, None)]
    intervals = spark.createDataFrame(spans, "catalog string, lo long, hi long").repartition(3)
    found = membership.members(spark.createDataFrame(keys, "row_id long, isbn12 long, `hi` string").repartition(5), intervals)
    assert found.columns == ["row_id", "isbn12", "hi", "catalog"]
    want = sorted((i, k, x or "", c) for i, k, x in keys if k is not None for c in ("a", "b", "ü", "wide") if any(d == c and lo <= k < hi for d, lo, hi in spans))
    assert sorted((r.row_id, r.isbn12, r.hi or "", r.catalog) for r in found.collect()) == want
    assert membership.members(spark.createDataFrame(keys, "row_id long, isbn12 long, t string"), intervals.limit(0)).collect() == []
    assert membership.members(spark.createDataFrame([], "isbn12 long"), intervals).collect() == []


def test_sweep_spreads_a_crowded_stretch(spark):
    """A third of the keys are one key, and all others lie close together: no range holds over twice the median's rows."""
    keys = spark.range(60_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 4000).alias("isbn12"))
    intervals = spark.range(2000).select(F.lit("c").alias("catalog"), (F.col("id") * 2).alias("lo"), (F.col("id") * 2 + 1).alias("hi"))
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        found = membership.members(keys, intervals).select("row_id", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    sizes = sorted(Counter(r.p for r in found).values())
    assert len(found) == sum(1 for i in range(60_000) if i % 3 == 0 or i % 4000 % 2 == 0) and len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]


def test_prefix_sums_by_blocks(spark):
    rows = [(g, p * 3, p % 5 - 1) for g in "ab" for p in range(200)]
    got = membership.prefix_sums(spark.createDataFrame(rows, "g string, p long, v long").repartition(4), "g", "p", "v", "s", block=50).collect()
    assert {(r.g, r.p): r.s for r in got} == {(g, p * 3): sum(q % 5 - 1 for q in range(p + 1)) for g in "ab" for p in range(200)} and len(got) == 400


def test_breaker_over_ranges(spark):
    """One source has most calls and runs of failures that lie across the borders of ranges."""
    rng = random.Random(11)
    calls, want = [], {}
    for source, n, bad in (("hot", 4000, 0.0), ("late", 900, 0.3), ("all", 300, 1.0), ("short", 2, 1.0), ("never", 500, 0.1)):
        fails = [rng.random() < bad and not (source == "never" and i % 3 == 0) for i in range(n)]
        if source == "hot":
            fails = [i % 3 != 0 for i in range(n)]  # two in a row, everywhere
            fails[3999], fails[3998], fails[3997] = True, True, True
        down = False
        for i, f in enumerate(fails):
            down = down or (i >= 2 and fails[i - 2] and fails[i - 1] and f)
            calls.append((source, i, f, i))
            want[source, i] = down
    rng.shuffle(calls)
    frame = spark.createDataFrame([*calls, (None, 1, True, 1), (None, 2, True, 2), (None, 3, None, 3)], "s string, t long, f boolean, seq long").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        got = ledger.breaker(frame, "s", ["t", "seq"], F.col("f")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert {(r.s, r.t): r.down for r in got if r.s} == want and [r.down for r in got if r.s is None] == [False] * 3


def test_hot_keys_have_the_same_keeper(spark):
    rng = random.Random(12)
    rows = [(rng.choice(["", "9780306406157", "9780306406158", "97803064061", "9781234567897"]), rng.choice(["", "t"]), i) for i in range(600)]
    frame = spark.createDataFrame(rows, "isbn13 string, title string, input_pos long").repartition(4)
    one, two = (sorted(map(tuple, dedup.mark_duplicates(frame, hot_rows=n).collect()), key=repr) for n in (50, 1 << 20))
    assert one == two and len(one) == 600
