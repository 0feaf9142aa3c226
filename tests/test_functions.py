import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import ids as I
from quillmill.functions import textnorm as X
from quillmill.operators import audit, lid, records


def column(spark, values, make):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", make(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows, key=lambda r: r.i)]


def test_isbn(spark):
    raw = ["9780306406157", "9780306406158", "0-306-40615-2", "080442957x", "03X6406152", "978030640615", "", "٣٧٨٠٣٠٦٤٠٦١٥٧", None]
    assert column(spark, raw, I.valid13) == [True, False, False, False, False, False, False, False, False]
    assert column(spark, raw, I.to13) == ["9780306406157", "9780306406158", "9780306406157", "9780804429573", "", "", "", "", ""]
    assert column(spark, ["9780306406158", "x"], I.invalid_reason) == ["Invalid ISBN-13 check digit (expected 7)", "Invalid ISBN-13 check digit (expected ?)"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789", min_size=12, max_size=12), min_size=1, max_size=50))
def test_check_digit_round_trip(spark, firsts):
    digits = column(spark, firsts, I.check_digit13)
    assert digits == [str(-sum(int(c) * (1, 3)[i % 2] for i, c in enumerate(f)) % 10) for f in firsts]
    assert all(column(spark, [f + d for f, d in zip(firsts, digits, strict=True)], I.valid13))


def test_safe_name(spark):
    names = ["a/b:c", " . dots . ", "", None, "x" * 130]
    assert column(spark, names, lambda c: I.safe_name(c, F.lit("none"))) == ["abc", "dots", "none", "none", "x" * 120]


def test_fold_and_squash(spark):
    assert column(spark, ["İSTANBUL Iğdır", "Çâğ’ı", "Ǻé", None], X.fold) == ["istanbul igdir", "cag'i", "ae", ""]
    assert column(spark, [" a \t\n b ", None], X.squash) == ["a b", ""]


def test_chars(spark):
    raw = ["Ä±ÅŸ", "ýþýk", "ılık ý", "i̇", "soft­hy​phen", "a\r\nb\rc\fd", "\x0bx\x07\ty", "sс", "привет", "Ã©tÃ©"]
    want = ["ış", "ışık", "ılık ý", "i", "softhyphen", "a\nb\nc\nd", "x\ty", "sc", "привет", "été"]
    assert column(spark, raw, X.fix_chars) == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=40), min_size=1, max_size=20))
def test_fold_has_no_marks(spark, texts):
    assert not any(unicodedata.combining(c) for t in column(spark, texts, X.fold) for c in t)


def test_markup(spark):
    few = "<p>a</p>" * 10
    many = "<head><script>x</script>t</head>" + "<p>a&amp;b</p>" * 11 + "<br/>end<unclosed"
    got = column(spark, [few, many, "1 &lt; 2 &eacute;"], X.strip_markup)
    assert got[0] == few and got[2] == "1 < 2 é"
    assert "t" not in got[1].split("end")[0] and got[1].count("a&b") == 11 and "<p>" not in got[1]


def test_first_clean_and_percent(spark):
    assert column(spark, ["wo-\n  rd\n 12 \nx  y \n\n\n\nz"], X.first_clean) == ["word\n\nx y\n\nz\n"]
    assert column(spark, ["0.125", "0.135", "1"], lambda c: X.percent(c.cast("double"))) == ["12%", "14%", "100%"]


def test_the_first_cleaner_keeps_the_dot_and_knows_only_line_feeds(spark):
    texts = ["gi\u0307der", "a\r12\rb", "a\n12\nb", "e\u0301 x", "a\u202812\u2028b", "a\x8512\x85b"]
    assert column(spark, texts, X.first_clean) == ["gi\u0307der\n", "a\r12\rb\n", "a\n\nb\n", "\u00e9 x\n", "a\u202812\u2028b\n", "a\x8512\x85b\n"]
    assert column(spark, ["gi\u0307der", "\u0131\u0307", "e\u0301", None, ""], X.nfc) == ["gider", "i", "\u00e9", None, ""]


def test_characters_are_repaired_in_order(spark):
    texts = ["Ã¼ber", "İstanbul gÃ¼zel", "ýþ ýþ ı", "сat", "é­​", "plain ascii", "Ä±Ä°", None, "cafÃ©", "a\x0bb\r\nc"]
    want = ["über", "İstanbul güzel", "ış ış ı", "cat", "é", "plain ascii", "ıİ", None, "café", "ab\nc"]
    assert column(spark, texts, X.fix_chars) == want


def test_headers_with_odd_line_ends(spark):
    head = "Title: a\u2028b\nISBN: 9780306406157\n\nbody"
    wrapped = "<doc>\n<metadata>\n<title>a\u2028b\x85c\rd</title>\n<isbn>1</isbn>\n</metadata>\n<content>\nx\n</content>\n</doc>"
    blanks = "\u2003 \t\n" + " " * 200
    got = column(spark, [head, wrapped, blanks + wrapped, blanks + "no <doc>", "a\r\nISBN: 1"], records.split_record)
    assert got[0].meta == {"title": "a\u2028b", "isbn": "9780306406157"} and got[0].body == "body"
    assert got[1].meta == got[2].meta == {"title": "a\u2028b\x85c\rd", "isbn": "1"} and got[1].body == got[2].body
    assert got[3].meta == {} and got[3].body == blanks + "no <doc>" and got[4].meta == {"isbn": "1"}


def test_the_last_catalog_row_counts(spark):
    files = spark.createDataFrame([("a/b.txt", "ISBN: 9780306406157\n\ntext")], "path string, raw string")
    rows = [("9780306406157", "old", "x", 1), ("9780306406157", "new", "a", 3), ("9780306406157", "mid", "z", 2)]
    for seed in range(3):
        catalog = spark.createDataFrame(rows[seed:] + rows[:seed], "ISBN string, Title string, Author string, pos int").repartition(3)
        assert audit.with_metadata(files, catalog, "pos").first().title == "new" and audit.with_metadata(files, catalog).first().title == "old"


def test_too_many_languages_are_an_error(spark):
    docs = spark.createDataFrame([(i, f"some text in {c}", c) for i, c in enumerate("abcd")], "doc_id long, text string, lang string")
    assert sorted(lid.profiles(docs, languages=4)) == list("abcd")
    with pytest.raises(ValueError, match="languages"):
        lid.profiles(docs, languages=3)
    parts = spark.createDataFrame([("some text in a",), ("",), (None,), ("\U0001f600\U0001f600\U0001f600",)], "part string")
    assert [r.lang for r in lid.label(parts.coalesce(1), {"a": {"": -9.0, "ome": -1.0}, "b": {"": -9.0, "xyz": -1.0}}).collect()][:3] == ["a", "und", "und"]
    assert [r.lang for r in lid.label(parts.coalesce(1), {}).collect()] == ["und"] * 4
