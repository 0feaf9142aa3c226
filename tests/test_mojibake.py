"""Misread texts and their repair: every damage undone, clean texts left alone."""

import pytest
from pyspark.sql import functions as F

from quillmill.operators import dedup, mojibake

SF = "/root/testdata/sf0.001"


def read(data, page, lost):
    """Bytes as a reader of the page shows them; bytes that it does not define are lost or come through."""
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            out.append("�" if lost else chr(b))
    return "".join(out)


@pytest.fixture(scope="module")
def cost(spark):
    return mojibake.bigrams(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and octet_length(text) <> length(text)").select("text").collect()
    return [r.text for r in rows]


@pytest.mark.parametrize(("page", "lost", "times"), [("cp1252", False, 1), ("latin-1", False, 1), ("cp1254", False, 1), ("cp1252", False, 2), ("cp1252", True, 1), ("cp1254", True, 1)])
def test_damage_is_undone(texts, cost, page, lost, times):
    right = 0
    for t in texts:
        damaged = t
        for _ in range(times):
            damaged = read(damaged.encode(), page, lost)
        right += mojibake.mend(damaged, cost) == t
    assert len(texts) > 30 and right >= 0.97 * len(texts)


def test_clean_texts_stay(texts, cost):
    assert all(mojibake.mend(t, cost) == t for t in texts)
    assert [mojibake.mend(t, cost) for t in ("", "plain", "日本語", "£5 à", "naïve café")] == ["", "plain", "日本語", "£5 à", "naïve café"]


def test_repair_of_a_column(spark, cost):
    rows = [(1, "cafÃ© dÃ©jÃ\xa0"), (2, None), (3, ""), (4, "plain"), (5, "café"), (6, "x" * 300_000 + " Ã©")]
    frame = spark.createDataFrame(rows, "i int, t string").repartition(3)
    got = {r.i: r.x for r in frame.select("i", mojibake.repairer(cost)(F.col("t")).alias("x")).collect()}
    assert got == {1: "café déjà", 2: None, 3: "", 4: "plain", 5: "café", 6: "x" * 300_000 + " é"}
    assert mojibake.bigrams(frame.limit(0), "t") == {"": pytest.approx(1.693, abs=1e-3)}


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    pairs = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "far", 1), (None, "none", 1)], "k int, v string, o int")
    got = {r.x: (r.v, r.d) for r in dedup.lookup(dedup.lookup(rows, pairs, "k", "v", "o"), pairs, "k", "v", default=F.lit("?"), name="d").collect()}
    assert got == {"a": ("new", "old"), "b": ("", "?"), "c": ("", "?")}
