"""Corpus records: splitting headed texts, wrapping bodies, existing-copy checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.expr import let

#: Lines end at LF alone; Java's "." and "$" would also stop at CR, U+0085, U+2028 and U+2029.
TAGGED, KEYED = r"(?U)<(\w+)>([^\n]*?)</\1>", r"(?dmU)^(\w+): ([^\n]*)$"


def split_record(raw: Column) -> Column:
    """Struct (meta map, body) of a text in either header dialect.

    Wrapped: tag pairs before the first <content>, the body up to the last </content>. Key: value lines up to the first
    blank line, keys in lower case, licence as license. Without an isbn key there is no header and the body is all.
    """
    none = F.create_map().cast("map<string,string>")

    def unique(keys: Column, values: Column) -> Column:
        """A map in which the last value of a key wins."""

        def of(pairs: Column) -> Column:
            last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q.k == p.k))
            return F.map_from_entries(F.transform(last, lambda p: F.struct(p.k, p.v)))

        return let(F.arrays_zip(keys.alias("k"), values.alias("v")), of)

    def wrapped(t: Column) -> Column:
        head, after = F.substring_index(t, "<content>", 1), F.substr(t, F.locate("<content>", t) + 9)

        def inside(x: Column) -> Column:
            tail = F.length(F.substring_index(x, "</content>", -1))
            return F.when(F.contains(x, F.lit("</content>")), F.substr(x, F.lit(1), F.length(x) - tail - 10)).otherwise(x)

        pairs = let(head, lambda h: unique(F.regexp_extract_all(h, F.lit(TAGGED), 1), F.regexp_extract_all(h, F.lit(TAGGED), 2)))
        return F.struct(pairs.alias("meta"), let(after, inside).alias("body"))

    def plain(t: Column) -> Column:
        def headed(top: Column) -> Column:
            keys = F.transform(F.regexp_extract_all(top, F.lit(KEYED), 1), lambda k: F.when(F.lower(k) == "licence", "license").otherwise(F.lower(k)))
            return let(keys, lambda k: F.when(F.array_contains(k, "isbn"), unique(k, F.transform(F.regexp_extract_all(top, F.lit(KEYED), 2), lambda v: F.btrim(v)))))

        body = F.when(F.locate("\n\n", t) > 0, F.substr(t, F.locate("\n\n", t) + 2)).otherwise("")
        return let(let(F.substring_index(t, "\n\n", 1), headed), lambda meta: F.when(meta.isNotNull(), F.struct(meta.alias("meta"), body.alias("body"))).otherwise(F.struct(none.alias("meta"), t.alias("body"))))

    return let(raw, lambda t: F.when(is_wrapped(t), wrapped(t)).otherwise(plain(t)))


def is_wrapped(raw: Column) -> Column:
    """Whether the text begins with <doc> after any white space."""
    return raw.rlike(r"(?U)\A[\s\x1c-\x1f]*+<doc>")


def escape(value: Column) -> Column:
    """Without angle brackets and outer blanks."""
    return F.btrim(F.translate(F.coalesce(value, F.lit("")), "<>", ""))


def wrap_record(body: Column, title: Column, author: Column, isbn: Column, language: str, extra: dict[str, Column] | None = None) -> Column:
    """A <doc> record; extra tags only where their value is not empty."""
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), escape(value), F.lit(f"</{name}>"))
    more = [F.when(F.coalesce(v, F.lit("")) != "", tag(k, v)) for k, v in (extra or {}).items()]
    meta = F.concat_ws("\n", tag("title", title), tag("author", author), tag("isbn", isbn), F.lit(f"<language>{language}</language>"), *more)
    return F.concat(F.lit("<doc>\n<metadata>\n"), meta, F.lit("\n</metadata>\n<content>\n"), body, F.lit("\n</content>\n</doc>\n"))


def is_done(raw: Column, completed: Column) -> Column:
    """Already wrapped and in the ledger: cleaning such a text again would eat paragraphs."""
    return is_wrapped(raw) & F.coalesce(completed, F.lit(False))


def one_copy(rows: DataFrame, path: str, order: str, isbn: str = "isbn") -> DataFrame:
    """Adds kept: null for the first row of a path, else the ISBN of the first, if that differs."""
    first = rows.groupBy(path).agg(F.min_by(isbn, order).alias("__isbn"))
    return rows.join(first, path).withColumn("kept", F.when(F.col("__isbn") != F.col(isbn), F.col("__isbn"))).drop("__isbn")
