"""Identifier functions: ISBN arithmetic, file-system names. All are Column to Column and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def isbn_clean(raw: Column) -> Column:
    """Digits and X only."""
    return F.regexp_replace(F.coalesce(raw, F.lit("")), "[^0-9Xx]", "")


def check_digit13(first12: Column) -> Column:
    """Check digit of 12 digits (weights 1 and 3 in turn from the left); null for anything else."""
    weighted = [F.substring(first12, i + 1, 1).try_cast("int") * (3 if i % 2 else 1) for i in range(12)]
    total = weighted[0]
    for w in weighted[1:]:
        total = total + w
    return F.when(first12.rlike("^[0-9]{12}$"), F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def valid13(isbn: Column) -> Column:
    """13 ASCII digits with the right check digit."""
    return F.coalesce(isbn.rlike("^[0-9]{13}$") & (check_digit13(F.substring(isbn, 1, 12)) == F.substring(isbn, 13, 1)), F.lit(False))


def to13(raw: Column) -> Column:
    """ISBN-13 of an ISBN-10 or ISBN-13 in any punctuation, upper case; "" for anything else.

    Check digits are not verified. An X before the last place of an ISBN-10 gives "".
    """
    d = F.upper(isbn_clean(raw))
    core = F.concat(F.lit("978"), F.substring(d, 1, 9))
    return F.when(F.length(d) == 13, d).when(F.length(d) == 10, F.coalesce(F.concat(core, check_digit13(core)), F.lit(""))).otherwise("")


def isbn12(raw: Column) -> Column:
    """First twelve digits as a number; null unless the text is 13 digits."""
    t = F.btrim(raw)
    return F.when(t.rlike("^[0-9]{13}$"), F.substring(t, 1, 12).try_cast("bigint"))


def invalid_reason(isbn: Column) -> Column:
    """Why an ISBN is not valid, with the expected digit, or ? where the first twelve places are not digits."""
    return F.concat(F.lit("Invalid ISBN-13 check digit (expected "), F.coalesce(check_digit13(F.substring(isbn, 1, 12)), F.lit("?")), F.lit(")"))


def safe_name(name: Column, fallback: Column) -> Column:
    """A file-system name: forbidden characters go, then blanks and dots at the ends, then all past 120 characters."""
    kept = F.substring(F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), '[\\\\/:*?"<>|\\x00-\\x1f]', ""), F.lit(" .")), 1, 120)
    return F.coalesce(F.nullif(kept, F.lit("")), fallback)


def text_path(author: Column, title: Column, isbn: Column) -> Column:
    """Author/Title.txt, by the first of several authors."""
    return F.concat(safe_name(F.substring_index(author, ";", 1), F.lit("Unknown author")), F.lit("/"), safe_name(title, isbn), F.lit(".txt"))
