"""Operator 5: quality rules and distribution divergence, in DataFrame functions only.

Base figures of a text: words (runs other than blanks and 0x09-0x0D), their code points, symbols, repeated lines, and
the words that lie in a 5-word window found twice or more. A text fails the base rules with under 10 words, or with
more than 20 in 100 words in repeated windows.

The verdict on the rest compares two histograms with those of the text's language over the whole table: that of
character classes and that of the language's common words (each at least COMMON of all its words, so 1 / COMMON of
them at most). A text fails on a Jensen-Shannon distance (base 2, 0 to 1) beyond CLASS_LIMIT or WORD_LIMIT. Texts
under MIN_WORDS words and languages under MIN_REFERENCE words are not judged: too short to have a histogram.

Edge cases: null and empty texts have no words and fail the base rules; a null language is a language of its own; rows
that repeat get a row each; other columns, of any name, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.expr import let
from quillmill.llm.store import tidy, written

COMMON, CLASS_LIMIT, WORD_LIMIT = 0.004, 0.27, 0.42
MIN_WORDS, MIN_REFERENCE = 50, 2000
#: Most languages whose references are broadcast (each at most a few hundred words); beyond, an ordinary join is used.
BROADCAST_LANGUAGES = 1000
#: Common words of all languages that a text's words are looked up among at once, by hash; beyond, each word is searched in its language's list.
LOOKED_UP = 4096
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "symbol", "other")


def without(text: Column, characters: str) -> Column:
    """text without the characters of a class; translate would look every character up in a map."""
    return F.regexp_replace(text, f"[{characters}]++", "")


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \x09-\x0D]+"))


def repeat_words(words: Column, k: int = 5) -> Column:
    """How many words lie in a window of k words that the array holds twice or more."""

    def covered(grams: Column) -> Column:
        ranked = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twice(r: Column) -> Column:
            at = F.transform(r, lambda x, j: F.when((x.g == F.get(r, j - 1).g) | (x.g == F.get(r, j + 1).g), x.i))
            return F.sort_array(F.filter(at, lambda i: i.isNotNull()))

        def length(p: Column) -> Column:
            own = F.transform(p, lambda i, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - i, F.lit(k))))
            return F.aggregate(own, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(let(let(ranked, twice), length))

    def grams(hashes: Column) -> Column:
        return F.transform(F.slice(hashes, 1, F.size(hashes) - k + 1), lambda h, i: F.xxhash64(h, *(F.get(hashes, i + d) for d in range(1, k))))

    hashed = F.transform(words, lambda w: F.xxhash64(w))  # each word is hashed once, not once for each of its windows
    return F.when(F.size(words) < k, F.lit(0)).otherwise(let(let(hashed, grams), covered)).cast("long")


def base_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang, words and the base figures, with the counts of character classes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # most characters are lower-case letters: the other classes are counted in what is left without them
    rows = rows.withColumns({"words": words_of(F.col("text")), "chars": F.length("text"), "rest": without(F.col("text"), "a-z")})
    text, rest = F.col("text"), F.col("rest")
    left = F.length(rest)
    solid = F.col("chars") - left + F.length(without(rest, BLANKS))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    rows = rows.select(
        "doc_id", "lang", "words", F.size("words").cast("long").alias("n_words"), solid.cast("long").alias("word_chars"), "chars",
        (left - F.length(without(rest, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        (F.col("chars") - left).alias("lower"),
        (left - F.length(without(rest, "A-Z"))).alias("upper"),
        (left - F.length(without(rest, "0-9"))).alias("digit"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    other = F.col("word_chars") - F.col("lower") - F.col("upper") - F.col("digit") - F.col("n_symbols")
    classes = F.array(*(x.cast("double") for x in (F.col("lower"), F.col("upper"), F.col("digit"), F.col("chars") - F.col("word_chars"), F.col("n_symbols"), other)))
    return rows.withColumns({"base_failed": failed, "classes": classes})


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, ref_words and ref_shares (with that of all other words last) of each language with enough words, written."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = written(rows.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "words")  # read several times
    total = counted.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= MIN_REFERENCE)
    few = total.count() <= BROADCAST_LANGUAGES
    common = counted.join(F.broadcast(total) if few else total, "lang").where(F.col("n") >= COMMON * F.col("total"))
    words = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((F.col("n") / F.col("total")).alias("share"), "word")), asc=False).alias("w"))  # at most 1 / COMMON words each, the commonest first
    words = words.select("lang", F.col("w.word").alias("ref_words"), F.concat(F.col("w.share"), F.array(1 - F.aggregate("w", F.lit(0.0), lambda a, x: a + x.share))).alias("ref_shares"))
    found = total.select("lang").join(words, "lang", "left").select("lang", F.coalesce("ref_words", F.array().cast("array<string>")).alias("ref_words"), F.coalesce("ref_shares", F.array(F.lit(1.0))).alias("ref_shares"))
    return written(found, "references", counted)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length, in any units."""

    def of(a: Column, b: Column) -> Column:
        both = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y"), ((x + y) / 2).alias("m")))

        def part(v: Column, m: Column) -> Column:
            return F.when(v > 0, v * F.log2(v / m)).otherwise(F.lit(0.0))

        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda s, z: s + (part(z.x, z.m) + part(z.y, z.m)) / 2)))

    def share(x: Column) -> Column:
        return let(F.greatest(F.aggregate(x, F.lit(0.0), lambda a, b: a + b), F.lit(1e-9)), lambda total: F.transform(x, lambda v: v / total))

    return let(share(p), lambda a: let(share(q), lambda b: of(a, b)))


def common_counts(words: Column, common: Column, any_common: list[str] | None = None) -> Column:
    """How often words holds each of common, and last how many words are none of them.

    any_common: words that include all of common; the others need no search in it.
    """

    def count(at: Column) -> Column:
        # at holds 1 .. size(common) + 1 once besides the words' own, in order: from where a number starts to where the next does is its count, plus one
        starts = F.filter(F.transform(at, lambda p, i: F.when((i == 0) | (p != F.get(at, i - 1)), i)), lambda i: i.isNotNull())
        gaps = let(starts, lambda s: F.transform(common, lambda w, k: (F.get(s, k + 1) - F.get(s, k) - 1).cast("double")))
        return let(gaps, lambda g: F.concat(g, F.array(F.size(words) - F.aggregate(g, F.lit(0.0), lambda a, b: a + b))))

    some = words if any_common is None else F.filter(words, lambda w: w.isin(any_common))
    found = F.filter(F.transform(some, lambda w: F.array_position(common, w)), lambda p: p > 0)
    places = F.sort_array(F.concat(found, F.transform(F.sequence(F.lit(1), F.size(common) + 1), lambda k: k.cast("bigint"))))
    return F.when(F.size(common) == 0, F.array(F.size(words).cast("double"))).otherwise(let(places, count))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, the base figures, base_failed, kept, and the two distances (null where not judged)."""
    reference = references(docs, text_col, lang_col)
    few = reference.count() <= BROADCAST_LANGUAGES
    small = F.broadcast if few else lambda df: df
    with tidy(docs.sparkSession):
        known = [r.word for r in reference.select(F.explode("ref_words").alias("word")).distinct().limit(LOOKED_UP + 1).collect()]
    known = known if 0 < len(known) <= LOOKED_UP else None
    rows = base_figures(docs, id_col, text_col, lang_col).join(small(reference), "lang", "left")
    judged = ~F.col("base_failed") & (F.col("n_words") >= MIN_WORDS) & F.col("ref_words").isNotNull()
    far = F.when(judged, distance(common_counts(F.col("words"), F.col("ref_words"), known), F.col("ref_shares")))
    figures = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    measured = written(rows.select("lang", *figures, "classes", far.alias("word_distance")), "figures")  # a row of numbers for each text
    sums = measured.groupBy("lang").agg(F.array(*(F.sum(F.get("classes", F.lit(i))) for i in range(len(CLASSES)))).alias("ref_classes"))
    rows = measured.join(small(sums.join(small(reference.select("lang")), "lang")), "lang", "left")
    rows = rows.withColumn("class_distance", F.when(F.col("word_distance").isNotNull(), distance(F.col("classes"), F.col("ref_classes"))))
    far = F.coalesce((F.col("class_distance") > CLASS_LIMIT) | (F.col("word_distance") > WORD_LIMIT), F.lit(False))
    return written(rows.select(*figures, (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance"), "rules", measured, reference)
