"""Stores that runs share: the compacted ledger and the tree of texts, across runs that fail."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quillmill.operators import audit
from quillmill.operators.ledger import latest
from quillmill.sources import shared
from quillmill.sources.ledger_store import LedgerStore
from quillmill.sources.text_tree import TextTree, saved, write_tree

SCHEMA = "isbn string, source string, status string, updated long, seq long"


def log(spark, n, seed, keys=60):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"k{rng.randrange(keys) if rng.random() < 0.7 else 0}", rng.choice("ab"), f"s{i}-{seed}", rng.randrange(20), seed * 10_000 + i) for i in range(n)], SCHEMA)


def rows(frame):
    return sorted(map(tuple, frame.select("isbn", "source", "status", "updated", "seq").collect()))


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_ledger_over_compactions(spark, tmp_path):
    folder = f"{tmp_path}/ledger"
    ledger = LedgerStore(spark, folder, ["isbn", "source"], buckets=8)
    with pytest.raises(FileNotFoundError):
        ledger.read()
    assert ledger.compact() == []
    logs = [log(spark, 200, 1), log(spark, 150, 2), log(spark, 80, 3)]
    both = logs[0]
    ledger.append(logs[0])
    assert rows(ledger.read()) == rows(latest(both, ["isbn", "source"]))
    assert ledger.compact() == list(range(8))
    for more in logs[1:]:
        both = both.unionByName(more)
        ledger.append(more)
        assert rows(ledger.read()) == rows(latest(both, ["isbn", "source"]))
        ledger.compact()
        assert rows(LedgerStore(spark, folder, ["isbn", "source"]).read()) == rows(latest(both, ["isbn", "source"]))
    ledger.vacuum()
    assert rows(ledger.read()) == rows(latest(both, ["isbn", "source"])) and not [n for n in shared.names(spark, f"{folder}/deltas") if n.startswith("delta=")]
    assert "Exchange" not in ledger.read()._jdf.queryExecution().executedPlan().toString()
    ledger.append(logs[0])  # rows that were folded before, and older ones, change nothing
    ledger.compact()
    assert rows(ledger.read()) == rows(latest(both, ["isbn", "source"]))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    ledger = LedgerStore(spark, str(tmp_path), ["isbn", "source"], buckets=8)
    ledger.append(log(spark, 400, 1))
    ledger.compact()
    before = files(f"{tmp_path}/snapshot")
    ledger.append(spark.createDataFrame([("k1", "a", "new", 99, 99)], SCHEMA))
    (bucket,) = ledger.compact()
    ledger.vacuum()
    after = files(f"{tmp_path}/snapshot")
    assert {f for f in before if f"bucket={bucket}/" not in f} == {f for f in after if f"bucket={bucket}/" not in f}
    assert not {f for f in before if f"bucket={bucket}/" in f} & after and len([f for f in after if f"bucket={bucket}/" in f]) == 1


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    ledger = LedgerStore(spark, str(tmp_path), ["isbn", "source"], buckets=4)
    ledger.append(log(spark, 100, 1))
    want = rows(ledger.read())
    with monkeypatch.context() as m:
        m.setattr(shared, "put_once", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            ledger.compact()
    assert rows(ledger.read()) == want
    other = LedgerStore(spark, str(tmp_path), ["isbn", "source"])
    other.compact()
    with pytest.raises(FileExistsError):
        shared.put_once(spark, f"{tmp_path}/manifests/00000001.json", "{}")
    assert rows(ledger.read()) == want and ledger.compact() == []


def tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), encoding="utf-8", newline="").read() for d, _, names in os.walk(folder) for f in names}


def test_text_tree(spark, tmp_path):
    root = f"{tmp_path}/tree"
    first = spark.createDataFrame([(f"Ann Ö/{i}.txt", f"text {i}\r\n") for i in range(30)] + [("top.txt", ""), ("Bob/none.txt", None)], "path string, record string")
    write_tree(first.repartition(5), root)
    assert tree(root) == {f"Ann Ö/{i}.txt": f"text {i}\r\n" for i in range(30)} | {"top.txt": ""}
    write_tree(spark.createDataFrame([("Ann Ö/1.txt", "again"), ("Cid/é.txt", "<isbn>978</isbn> " + "é" * 9000)], "path string, record string"), f"file://{root}")
    assert tree(root)["Ann Ö/1.txt"] == "again" and len(tree(root)) == 32
    got = {r.path: r.body for r in spark.read.format("text_tree").load(root).collect()}
    assert got == tree(root)
    assert {len(r.body) for r in spark.read.format("text_tree").option("chars", 2000).load(root).where("path like 'Cid/%'").collect()} == {2000}
    assert {r.path: r.isbn for r in saved(spark, root).where("isbn <> ''").collect()} == {"Cid/é.txt": "978"}
    assert saved(spark, f"{tmp_path}/nowhere").collect() == []


def test_a_job_that_fails_leaves_the_tree_as_it_was(spark, tmp_path):
    root = f"{tmp_path}/tree"
    write_tree(spark.createDataFrame([("a/b.txt", "old")], "path string, record string"), root)
    for bad in ("../out.txt", "/abs.txt", "a//b.txt", ""):
        some = spark.createDataFrame([(f"a/{i}.txt", "new") for i in range(20)] + [(bad, "x")], "path string, record string").repartition(3)
        with pytest.raises(Exception, match="not a path within"):
            write_tree(some, root)
        assert tree(root) == {"a/b.txt": "old"} and os.listdir(tmp_path) == ["tree"]


def test_a_second_run_keeps_one_copy(spark, tmp_path):
    long = "A sentence that is long enough to count as text. " * 12

    def run(*keys):
        found = spark.createDataFrame([(k, "Ann/One.txt" if k < 9 else "Ann/Two.txt", "web", "free", "One", "Ann", long) for k in keys], "key long, path string, source string, license string, title string, author string, raw string")
        shares = spark.createDataFrame([(k, "en", 1.0) for k in keys], "doc_id long, lang string, share double")
        out = audit.save_downloads(found, shares, "en", earlier=saved(spark, str(tmp_path)))
        got = {r.key: r.detail for r in out.collect()}
        write_tree(out, str(tmp_path))
        return got

    copy = "same title and author as ISBN 5; one copy kept"
    assert run(5, 6, 9) == {5: "downloaded (en 100%)", 6: copy, 9: "downloaded (en 100%)"}
    before = tree(tmp_path)
    assert before["Ann/One.txt"].startswith("<doc>") and "<license>free</license>" in before["Ann/One.txt"] and "<isbn>5</isbn>" in before["Ann/One.txt"]
    assert run(3, 4) == {3: copy, 4: copy} and tree(tmp_path) == before
    assert run(5) == {5: "downloaded (en 100%)"} and tree(tmp_path) == before
