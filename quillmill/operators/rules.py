"""Rule screening: rules are rows, compiled to one Column that yields a row's hits; no join, no Python on the rows.

Kinds of rules: text (category, confidence, scope, pattern, exempt, label), subject (category, pattern, exempt, label),
author (category, pattern, require, skip_otherwise, label), class ranges (letters, low, high, category, confidence,
label; first match only) and prefixes (prefix, category, confidence, label; all matches).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import textnorm as X

HIT = "array<struct<category:string,confidence:string,label:string,matched:string,field:string>>"


@dataclass
class RuleSet:
    """All rules of a screening, and how categories rank."""

    categories: list[str]
    text: list[dict] = field(default_factory=list)
    subject: list[dict] = field(default_factory=list)
    author: list[dict] = field(default_factory=list)
    author_high: set[str] = field(default_factory=set)
    ranges: list[dict] = field(default_factory=list)
    prefixes: list[dict] = field(default_factory=list)
    exempt_authors: str | None = None
    exempt_categories: tuple[str, ...] = ()
    context_category: str | None = None
    fiction: str | None = None
    scholarly: str | None = None


def _hit(category: str, confidence: Column | str, label: str, matched: Column, where: str) -> Column:
    conf = F.lit(confidence) if isinstance(confidence, str) else confidence
    return F.struct(F.lit(category).alias("category"), conf.alias("confidence"), F.lit(label).alias("label"), matched.alias("matched"), F.lit(where).alias("field"))


def _search(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 0)


def _some(hits: list[Column]) -> Column:
    """Array of the hits that are not null, in order."""
    return F.array_compact(F.array(*hits)) if hits else F.array().cast(HIT)


def text_hits(rules: RuleSet, title: Column, meta: Column, desc: Column) -> Column:
    everything = F.concat_ws(" | ", title, meta, desc)
    parts = []
    for where, text in (("title", title), ("subjects/genres", meta), ("description", desc)):
        own = [r for r in rules.text if where == "title" or r["scope"] != "title"]
        if not own:
            continue
        hits = []
        for r in own:
            match = text.rlike(r["pattern"]) if not r.get("exempt") else text.rlike(r["pattern"]) & ~everything.rlike(r["exempt"])
            hits.append(F.when(match, _hit(r["category"], r["confidence"] if where == "title" else "review", r["label"], _search(text, r["pattern"]), where)))
        any_rule = "|".join(f"(?:{r['pattern']})" for r in own)  # one search rules out most rows
        parts.append(F.when(text.rlike(any_rule), _some(hits)).otherwise(F.array().cast(HIT)))
    return F.concat(*parts) if parts else F.array().cast(HIT)


def subject_hits(rules: RuleSet, subjects: Column, everything: Column) -> Column:
    """Each entry against each rule, entries first; always for review."""

    def of(entry: Column) -> Column:
        return _some([F.when(entry.rlike(r["pattern"]) & (~everything.rlike(r["exempt"]) if r.get("exempt") else F.lit(True)), _hit(r["category"], "review", r["label"], entry, "subjects")) for r in rules.subject])

    return F.flatten(F.transform(subjects, of)) if rules.subject else F.array().cast(HIT)


def author_hits(rules: RuleSet, authors: Column, topic: Column) -> Column:
    hits = []
    for r in rules.author:
        on_topic = topic.rlike(r["require"]) if r.get("require") else F.lit(True)
        keep = authors.rlike(r["pattern"]) & ((on_topic | F.lit(True)) if not r["skip_otherwise"] else on_topic)
        sure = on_topic & F.lit(r["label"] in rules.author_high)
        hits.append(F.when(keep, _hit(r["category"], F.when(sure, "high").otherwise("review"), r["label"], _search(authors, r["pattern"]), "authors")))
    return _some(hits)


def range_hits(rules: RuleSet, codes: Column) -> Column:
    """The first range that holds a code's letters and number; order tells a nested range from its outer one."""

    def of(code: Column) -> Column:
        letters = F.regexp_extract(code, r"^\s*([a-z]{1,3})\s*(\d+(?:\.\d+)?)", 1)
        number = F.regexp_extract(code, r"^\s*([a-z]{1,3})\s*(\d+(?:\.\d+)?)", 2).try_cast("double")
        first = None
        for r in rules.ranges:
            match, hit = (letters == r["letters"]) & number.between(float(r["low"]), float(r["high"])), _hit(r["category"], r["confidence"], r["label"], F.btrim(code), "lcc")
            first = F.when(match, hit) if first is None else first.when(match, hit)
        return first

    return F.array_compact(F.transform(codes, of)) if rules.ranges else F.array().cast(HIT)


def prefix_hits(rules: RuleSet, codes: Column) -> Column:
    """All prefixes of a code, slashes aside."""

    def of(raw: Column) -> Column:
        code = F.btrim(F.replace(raw, F.lit("/"), F.lit("")))
        return _some([F.when(code.startswith(r["prefix"]), _hit(r["category"], r["confidence"], r["label"], code, "dewey")) for r in rules.prefixes])

    return F.flatten(F.transform(codes, of)) if rules.prefixes else F.array().cast(HIT)


def adjust(rules: RuleSet, hits: Column, authors: Column, topic: Column) -> Column:
    """Exempt authors lose hits of some categories; in one category context drops or weakens hits not by author."""
    if rules.exempt_authors:
        exempt = authors.rlike(rules.exempt_authors)
        hits = F.filter(hits, lambda h: ~(exempt & h.category.isin(*rules.exempt_categories)))
    if rules.context_category:
        mine = lambda h: (h.category == rules.context_category) & ~h.label.startswith("author")
        if rules.scholarly:
            scholarly = topic.rlike(rules.scholarly)
            hits = F.filter(hits, lambda h: ~(mine(h) & (h.confidence == "review") & scholarly))
        if rules.fiction:
            fiction = topic.rlike(rules.fiction)
            weaker = lambda h: F.struct(h.category.alias("category"), F.when(mine(h) & fiction, "review").otherwise(h.confidence).alias("confidence"), h.label.alias("label"), h.matched.alias("matched"), h.field.alias("field"))
            hits = F.transform(hits, weaker)
    return hits


def _entries(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda s: F.btrim(s) != "")


def screen(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """rows with hits (in order of discovery) by their catalog columns, nulls taken as empty.

    Rows that carry an elim_category already are not screened and have no hits.
    """
    c = lambda name: F.coalesce(F.col(name), F.lit("")) if name in rows.columns else F.lit("")
    staged = rows.withColumns(
        {
            "__title": X.fold(F.concat_ws(" | ", c("title"), c("subtitle"), c("series"))),
            "__meta": X.fold(F.concat_ws(" | ", c("genres"), c("subjects"), c("subject_places_people_times"), c("broad_category"), c("fiction_or_type"))),
            "__desc": X.fold(c("description")),
            "__authors": X.fold(X.join_nonempty(c("authors"), c("contributors"))),
            "__subjects": X.fold(c("subjects")),
            "__lcc": X.fold(c("lcc")),
        }
    )
    title, meta, desc, authors = (F.col(f"__{x}") for x in ("title", "meta", "desc", "authors"))
    everything, topic = F.concat_ws(" | ", title, meta, desc), F.concat_ws(" | ", title, meta)
    found = F.concat(
        text_hits(rules, title, meta, desc),
        subject_hits(rules, F.transform(_entries(F.col("__subjects")), lambda s: F.btrim(s)), everything),
        author_hits(rules, authors, topic),
        range_hits(rules, _entries(F.col("__lcc"))),
        prefix_hits(rules, _entries(c("dewey"))),
    )
    if "elim_category" in rows.columns:
        found = F.when(F.col("elim_category").isNull(), found).otherwise(F.array().cast(HIT))
    staged = staged.withColumn("hits", found).withColumn("hits", adjust(rules, F.col("hits"), authors, topic))
    return staged.drop(*(f"__{x}" for x in ("title", "meta", "desc", "authors", "subjects", "lcc")))


def resolve(rows: DataFrame, rules: RuleSet, title_col: str = "title") -> DataFrame:
    """Adds elim_category, confidence, elim_reason, matched_terms from hits; a row without hits or title is no_metadata.

    High confidence first, then the category's rank, then discovery; the head decides, four distinct reasons are given.
    What an earlier stage has set (an elim_category that is not null, with its columns) stays.
    """
    order = F.array(*(F.lit(x) for x in rules.categories))
    ranked = F.array_sort(F.transform("hits", lambda h, i: F.struct((h.confidence != "high").cast("int").alias("a"), F.array_position(order, h.category).alias("b"), i.alias("i"), h.alias("h"))))
    rows = rows.withColumn("__ranked", ranked)
    head = F.get("__ranked", F.lit(0))["h"]
    notes = F.transform("__ranked", lambda x: F.concat(x.h.category, F.lit(": "), x.h.label, F.lit(" ('"), x.h.matched, F.lit("' in "), x.h.field, F.lit(")")))
    terms = F.array_sort(F.array_distinct(F.transform("__ranked", lambda x: x.h.matched)))
    some, untitled = F.size("hits") > 0, F.coalesce(F.col(title_col), F.lit("")) == ""
    made = {
        "elim_category": F.when(some, head.category).when(untitled, "no_metadata"),
        "confidence": F.when(some, head.confidence).when(untitled, "n/a"),
        "elim_reason": F.when(some, F.array_join(F.slice(F.array_distinct(notes), 1, 4), " | ")).when(untitled, "No title or metadata found; cannot be screened"),
        "matched_terms": F.when(some, F.substring(F.array_join(terms, "; "), 1, 300)).when(untitled, ""),
    }
    if "elim_category" in rows.columns:
        old = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
        made = {c: F.when(F.col("elim_category").isNotNull(), old(c)).otherwise(v) for c, v in made.items()}
    return rows.withColumns(made).drop("__ranked")


def histogram(rows: DataFrame) -> DataFrame:
    """How often each label hit, several times in one row included, most first."""
    return rows.select(F.explode("hits.label").alias("label")).groupBy("label").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "label")
