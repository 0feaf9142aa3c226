"""Queries that take whole inputs, on small tables made for what a cut would lose."""

import pyarrow as pa
import pyarrow.parquet as pq

from quillmill.plans import registry


def rows(spark, folder, query, name, columns):
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return registry.QUERIES[query](spark, str(folder)).collect()


def test_repairs_reach_the_end_of_a_text(spark, tmp_path):
    docs = {"doc_id": [0, 1, 2], "text": ["x" * 1000 + " ýþýþý"] * 3}
    got = {r.doc_id: r.repaired for r in rows(spark, tmp_path, "codepage_repair", "documents", docs)}
    assert got == {0: "ışık " + "x" * 1000 + " ışışı", 1: "ışık Ğ " + "x" * 1000 + " ışışı", 2: "ış" + "x" * 1000 + " ışışı"}
    docs = {"doc_id": [1], "text": ["x" * 1000 + "Ã¼­\r\n\x07end"]}
    assert rows(spark, tmp_path, "char_repair", "documents", docs)[0].repaired == "ıüab\nc\nde\t\n" + "x" * 1000 + "ü\nend"
    docs = {"doc_id": [1], "text": ["x" * 1000 + "é"]}
    assert rows(spark, tmp_path, "nfc_normal", "documents", docs)[0].nfc == "x" * 1000 + "é"


def test_every_order_is_indexed(spark, tmp_path):
    got = rows(spark, tmp_path, "bulk_index", "lineitem", {"l_orderkey": [1, 2, 3, 4, 4], "l_partkey": [7, 7, 8, 7, 9]})
    assert {r.isbn[3:12]: r.ids for r in got} == {"000000007": "id1,id2,id4", "000000008": "id3", "000000009": "id4"}


def test_tidy_rows_come_from_deduplication(spark, tmp_path):
    keys = [1, 13, 17, 187]
    part = {"p_partkey": keys, "p_name": [f"n{k}" for k in keys], "p_size": [1] * 4, "p_type": ["t"] * 4, "p_brand": ["b"] * 4}
    got = rows(spark, tmp_path, "tidy_projection", "part", part)
    assert sorted(r.Title for r in got) == ["n1", "n13", "n187"]  # 17 has only a wrong digit, 187 a valid copy too
    assert all(sum(int(c) * (1, 3)[i % 2] for i, c in enumerate(r.ISBN)) % 10 == 0 for r in got)


def test_records_with_blank_lines_and_without_text_are_split(spark, tmp_path):
    texts = ["one\n\ntwo", "one\n\ntwo\n\nthree", "\n\none", None]
    docs = {"doc_id": [3, 4, 5, 6], "text": texts}
    got = {r.doc_id: (r.isbn, r.license, r.body) for r in rows(spark, tmp_path, "record_split", "documents", docs)}
    assert got == {3: ("i3", None, texts[0]), 4: ("j4", "cc", texts[1]), 5: (None, None, texts[2]), 6: (None, None, None)}


def test_screening_keeps_earlier_verdicts(spark):
    from quillmill.operators import rules, screening

    rule_set = rules.RuleSet(categories=["metal"], text=[{"category": "metal", "confidence": "high", "scope": "all", "pattern": "steel", "exempt": None, "label": "steel"}])
    catalog = [(1, "978-0000000002", "steel box", ""), (2, "9780000000002", "steel box", ""), (3, "9780000000019", "", ""), (4, "9780000000026", "", "x"), (5, "9780000000034", "steel", ""), (6, "9780000000040", " paper  box ", "")]
    rows = spark.createDataFrame(catalog, "input_pos long, isbn13 string, title string, publisher string")
    meta = "title string, publisher string, source string"
    cache = spark.createDataFrame([("9780000000019", 0, None), ("9780000000019", 1, ("Found steel", "pub", "second")), ("9780000000026", 0, ("Plain", "pub", "first")), ("9780000000040", 0, ("other", "pub", "first"))], f"isbn string, source_rank int, meta struct<{meta}>")
    done = screening.screen_catalog(rows, rule_set, cache)
    got = {r.input_pos: (r.elim_category, r.confidence, r.title, r.publisher, r.matched_terms) for r in done.collect()}
    valid = {i: [str(n) for n in range(10) if (sum(int(c) * (1, 3)[j % 2] for j, c in enumerate(f"9780000000{i}")) + n) % 10 == 0][0] for i in ("00", "01", "02", "03", "04")}
    assert valid == {"00": "2", "01": "9", "02": "6", "03": "3", "04": "0"}
    assert got == {
        1: ("metal", "high", "steel box", "", "steel"), 2: ("duplicate", "n/a", "steel box", "", ""), 3: ("metal", "high", "Found steel", "pub", "steel"), 4: (None, None, "Plain", "x", None),
        5: ("invalid_isbn", "n/a", "steel", "", ""), 6: (None, None, "paper box", "", None),
    }
    cleaned, eliminated, bare = screening.outputs(done)
    assert cleaned.count() + eliminated.count() + bare.count() == len(catalog)
    assert [r.input_pos for r in eliminated.collect()] == [2, 5, 1, 3] and [r.input_pos for r in cleaned.collect()] == [4, 6]


def test_what_needs_no_repair_stays_in_the_jvm(spark):
    """Python functions get null for texts that they would not change."""
    from quillmill.functions import textnorm as X

    texts = ["plain", "ünï “quoted” — €5", "日本", "e\u0301", "FranÃ§ois", "a &lt; b &amp;amp; c", "a &eacute; b", "&copy 1", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    odd = rows.where(X.F.col("t").rlike(X.MISREAD) | X.F.col("t").rlike(X.DECOMPOSED)).select("i").collect()
    assert [r.i for r in odd] == [3, 4] and [r.i for r in rows.where(X.F.col("t").rlike(X.OTHER_ENTITY)).collect()] == [6, 7]
    got = [r.x for r in rows.orderBy("i").select(X.unescape(X.fix_chars(X.F.col("t"))).alias("x")).collect()]
    assert got == ["plain", "ünï “quoted” — €5", "日本", "é", "François", "a < b &amp; c", "a é b", "© 1", None]
    plan = rows.select(X.fix_chars(X.F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") < 60 and plan.count("ArrowEvalPython") <= 2


def test_save_downloads(spark):
    from quillmill.operators import audit

    long = "A sentence that is long enough to count as text. " * 12
    rows = [(1, "p/a", "web", long), (2, "p/a", "web", long), (3, "p/b", "web", "short text here"), (4, "p/c", "web", long), (5, "p/d", "web", None)]
    found = spark.createDataFrame(rows, "key long, path string, source string, raw string")
    shares = spark.createDataFrame([(i, "en", 1.0) for i in (1, 2, 3, 5)] + [(4, "xx", 1.0)], "doc_id long, lang string, share double")
    got = {r.key: (r.status, r.detail, r.body is not None) for r in audit.save_downloads(found, shares, "en").collect()}
    assert got == {
        1: ("completed", "downloaded (en 100%)", True), 2: ("completed", "same title and author as ISBN 1; one copy kept", False), 3: ("no usable text", "web: no usable text", False),
        4: ("culled", "Downloaded text in another language (xx 100%)", False), 5: ("no usable text", "web: no usable text", False),
    }


def test_audit_leaves_finished_files_alone(spark):
    from quillmill.functions.textnorm import F
    from quillmill.operators import audit, records

    body = "Some words that make a line.\n\nMore of them here."
    rows = spark.createDataFrame([("t/Ann/One.txt", "9780000000002"), ("t/Bob/Two.txt", "9780000000019")], "path string, isbn string")
    files = rows.select("path", records.wrap_record(F.lit(body), F.lit("w"), F.lit("v"), F.col("isbn"), "en").alias("raw")).unionByName(spark.createDataFrame([("t/Cid/Three.x.txt", body)], "path string, raw string"))
    ledger = spark.createDataFrame([("9780000000002", "completed"), ("9780000000019", "failed")], "key string, status string")
    shares = spark.createDataFrame([(p, "en", 1.0) for p in ("t/Ann/One.txt", "t/Bob/Two.txt", "t/Cid/Three.x.txt")], "doc_id string, lang string, share double")
    kept, culled, entries = audit.audit_files(files, spark.createDataFrame([], "ISBN string, Title string, Author string"), ledger, shares, "en")
    got = {r.path: r.record for r in kept.collect()}
    assert got.keys() == {"t/Bob/Two.txt", "t/Cid/Three.x.txt"} and culled.count() == 0
    assert "<title>Three.x</title>\n<author>Cid</author>" in got["t/Cid/Three.x.txt"] and "<title>w</title>" in got["t/Bob/Two.txt"]
    assert [(r.key, r.status) for r in entries.collect()] == [("9780000000019", "completed")]
