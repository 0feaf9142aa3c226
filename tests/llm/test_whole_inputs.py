"""Operators on inputs that a shortcut would get wrong: values of any form, near copies, components by either route."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quillmill.llm import components, pii, queries


def test_secrets_of_either_case_and_any_length(spark):
    secrets = ["9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "9233a8ecf7c5b09fe5949719b6b82bc439e9329b", "9233A8ecF7c5B09fE5949719b6b82BC439e9329B", "0a1B" * 60]
    docs = spark.createDataFrame([(i, f'TOKEN = "{s}".') for i, s in enumerate(secrets)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "key", count_col="n").collect()}
    for i, s in enumerate(secrets):
        new = got[i].text.removeprefix('TOKEN = "').removesuffix('".')
        assert got[i].n == 1 and new != s and [c.isdigit() for c in new] == [c.isdigit() for c in s] and [c.isupper() for c in new] == [c.isupper() for c in s]
        assert set(new.lower()) <= set("0123456789abcdef")


def test_near_copies_share_no_bin(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    docs = {"doc_id": [1, 2, 3, 4], "text": [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words).upper(), "quite another text"], "source": ["a", "b", "c", "d"]}
    pq.write_table(pa.table(docs), f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.bin_id for r in queries.op8_packing(spark, str(tmp_path)).collect()}
    assert len({got[1], got[2], got[3]}) == 3 and got[4] in (got[1], got[2], got[3])


def test_components_that_have_not_settled_are_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        components.components(path, rounds=1, small=0)
    for small in (0, 1000):
        assert {(r.node, r.root) for r in components.components(path, small=small).collect()} == {(i, 0) for i in range(1, 65)}


def test_pseudonyms_leave_other_columns(spark):
    schema = "doc_id long, text string, __pii__ string, `__PII___` int, n long"
    out = pii.pseudonymise(spark.createDataFrame([(1, "on 2020-01-31", "mine", 7, 3), (2, None, None, None, None)], schema), "key", count_col="n_replaced")
    assert out.columns == ["doc_id", "text", "__pii__", "__PII___", "n", "n_replaced"]
    rows = {r[0]: r for r in out.collect()}
    assert rows[1][2:] == ("mine", 7, 3, 1) and rows[1].text != "on 2020-01-31" and rows[2][1:] == (None, None, None, None, 0)
    assert pii.pseudonymise(out.limit(0), "key").collect() == []


def test_many_values_in_a_long_text(spark):
    text = " ".join(f"2001-02-{d % 28 + 1:02d} mail{d}@example.org" for d in range(3000)) + " " + "x" * 1_000_000
    row = pii.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key", count_col="n").first()
    assert row.n >= 5990 and row.text.endswith("x" * 1000) and len(row.text) == len(text)


def test_common_words_are_counted_by_either_route(spark):
    from pyspark.sql import functions as F

    from quillmill.llm import quality_rules

    rows = spark.createDataFrame([("a b a c d a".split(), ["a", "d", "z"]), ([], ["a"]), (["q"], []), (["z", "z"], ["y", "z"])], "w array<string>, common array<string>")
    for known in (None, ["a", "d", "y", "z", "other"]):
        got = [r.n for r in rows.select(quality_rules.common_counts(F.col("w"), F.col("common"), known).alias("n")).collect()]
        assert got == [[3.0, 1.0, 0.0, 2.0], [0.0, 0.0], [1.0], [0.0, 2.0, 0.0]]
