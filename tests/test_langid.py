"""The language classifier: vectors against counting, accuracy on documents that it has not seen, and its place in the audit."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.operators import audit, langid, lid
from quillmill.plans import corpora

SF = "/root/testdata/sf0.001"


def test_vectors_count_ngrams(monkeypatch):
    texts = ["abab", "", "  ", "Öé", "x" * 50, "a\U0001f600b", "ABAB"]
    for size in (1 << 17, 3):
        monkeypatch.setattr(langid, "SLICE", size)
        owner, bucket, value = langid.vectors(texts)
        assert (np.diff(owner) >= 0).all() and set(owner) == {0, 3, 4, 5, 6}
        for i, t in enumerate(texts):
            t = f" {t.lower()} " if t.strip() else ""
            counts = Counter(t[j : j + n] for n in langid.LENGTHS for j in range(len(t) - n + 1))
            mine = np.sort(value[owner == i])
            want = np.sort([math.sqrt(c) for c in counts.values()])
            assert np.allclose(mine, want / (np.linalg.norm(want) if len(want) else 1), atol=1e-9)
    owner, bucket, _ = langid.vectors(texts)
    assert bucket[owner == 0].tolist() == bucket[owner == 6].tolist() and not len(langid.vectors([])[0])


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"), sample=150, rounds=8)


def test_held_out_languages(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("crc32(cast(doc_id as string)) % 3 = 1 and length(text) >= 200")
    shares = lid.vote(langid.label(lid.chunks(docs), model))
    top = shares.groupBy("doc_id").agg(F.max_by("lang", "share").alias("top"))
    got = docs.join(top, "doc_id").select("lang", "top").collect()
    assert len(got) > 30 and sum(r.lang == r.top for r in got) >= 0.95 * len(got)


def test_the_model_does_not_depend_on_partitions(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("crc32(cast(doc_id as string)) % 3 <> 1").repartition(7, "source")
    again = langid.train(docs, sample=150, rounds=2)
    first = langid.train(docs.coalesce(1), sample=150, rounds=2)
    assert np.allclose(again.weights, first.weights, atol=1e-2) and again.languages == first.languages == model.languages


def test_labels_of_odd_texts(spark, model):
    parts = spark.createDataFrame([("",), (None,), (" \n",), ("😀",), ("the " * 90_000,)], "part string")
    got = langid.label(parts.coalesce(1), model).collect()
    assert [r.lang for r in got[:3]] == ["und"] * 3 and [r.prob for r in got[:3]] == [0.0] * 3 and got[4].lang == "en" and all(0 <= r.prob <= 1 for r in got)
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang for r in langid.label(parts.coalesce(1), none).collect()] == ["und"] * 5


def test_audit_with_own_labels(spark, model):
    files, catalog, done = corpora._files(spark, SF)
    want = {r.path: r.lang == "en" for r in files.join(spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 400").select("doc_id", "lang"), "doc_id").collect()}
    files = files.select("path", "raw")
    kept, culled, _ = audit.audit_files(files, catalog, done, audit.language_shares(files, model), "en")
    got = {r.path: True for r in kept.collect()} | {r.path: False for r in culled.collect()}
    both = got.keys() & want.keys()
    assert len(both) > 60 and sum(got[p] == want[p] for p in both) >= 0.95 * len(both)
