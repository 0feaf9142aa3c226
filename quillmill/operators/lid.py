"""Language identification: evenly spaced chunks, character-trigram naive Bayes, length-weighted vote, audit decision."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import textnorm as X

CHUNKS, CHUNK_CHARS, MIN_LETTERS = 24, 1500, 100
#: Trigrams kept of each language's profile, the most frequent.
PROFILE = 800
#: Languages that are told apart at most.
LANGUAGES = 250


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, chunk, part): all of a short text in pieces, CHUNKS evenly spaced pieces of a long one."""
    text = X.squash(F.col("text"))
    size = F.length("t")
    short = size <= CHUNKS * CHUNK_CHARS
    number = F.when(short, F.ceil(size / CHUNK_CHARS)).otherwise(CHUNKS).cast("int")
    step = F.when(short, CHUNK_CHARS).otherwise(F.floor((size - CHUNK_CHARS) / (CHUNKS - 1))).cast("int")
    rows = docs.select("doc_id", text.alias("t")).select("doc_id", "t", number.alias("n"), step.alias("step")).where("n > 0")
    return rows.select("doc_id", "t", "step", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("chunk")).select("doc_id", "chunk", F.substr("t", F.col("chunk") * F.col("step") + 1, F.lit(CHUNK_CHARS)).alias("part"))


def _trigrams(characters: Column) -> Column:
    """Each three characters in a row, of an array of single ones; a substring would count from the start each time."""
    return F.transform(F.slice(characters, 1, F.greatest(F.size(characters) - 2, F.lit(0))), lambda c, i: F.concat(c, F.get(characters, i + 1), F.get(characters, i + 2)))


def profiles(docs: DataFrame, languages: int = LANGUAGES) -> dict[str, dict[str, float]]:
    """Log probabilities of each language's most frequent trigrams, and under "" that of any other.

    Counted over all rows; what comes to the driver is PROFILE rows for each language. More languages are an error: none
    is left out without a word.
    """
    padded = F.concat(F.lit(" "), F.lower("text"), F.lit(" "))
    rows = docs.where("text is not null and lang is not null and length(text) > 0").select("lang", F.split(padded, "").alias("c"))
    counted = rows.select("lang", F.explode(_trigrams(F.col("c"))).alias("g")).groupBy("lang", "g").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    out: dict[str, dict[str, float]] = {}
    own = counted.withColumns({"rank": rank, "total": total}).where(F.col("rank") <= PROFILE)
    for r in own.orderBy("lang", "rank").limit(languages * PROFILE + 1).collect():
        out.setdefault(r.lang, {"": math.log(0.5 / r.total)})[r.g] = math.log(r.n / r.total)
    if len(out) > languages:
        raise ValueError(f"more than {languages} languages")
    return out


def _code(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def label(parts: DataFrame, known: dict[str, dict[str, float]]) -> DataFrame:
    """Adds lang and prob to (.., part): the likeliest language and its share; und and 0 where there is nothing to tell."""
    langs = sorted(known)
    entries = sorted((_code(g), i, w - known[x][""]) for i, x in enumerate(langs) for g, w in known[x].items() if g)
    grams, first, many = np.unique(np.array([e[0] for e in entries], np.int64), return_index=True, return_counts=True)
    # of each trigram, what each language that keeps it gives beyond what any other trigram gives: PROFILE entries a language
    whose, gain, other = np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries]), np.array([known[x][""] for x in langs])
    shared = parts.sparkSession.sparkContext.broadcast((grams, first, many, whose, gain, other))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, first, many, whose, gain, other = shared.value
        for batch in batches:
            texts = [f" {(t or '').lower()} " if (t or "").strip() else "" for t in batch]
            size = np.array([len(t) for t in texts])
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            n = np.maximum(size - 2, 0)
            at = np.repeat(np.cumsum(size) - size, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            code = (points[at] << 42) | (points[at + 1] << 21) | points[at + 2] if len(at) else np.zeros(0, np.int64)
            near = np.minimum(np.searchsorted(grams, code), max(len(grams) - 1, 0))
            kept = grams[near] == code if len(grams) else np.zeros(len(code), bool)
            doc, some, column = np.repeat(np.arange(len(texts)), n)[kept], (n > 0) & (len(langs) > 0), near[kept]
            each = many[column]
            entry = np.repeat(first[column], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            sums = np.bincount(np.repeat(doc, each) * len(langs) + whose[entry], gain[entry], len(texts) * len(langs)).reshape(len(texts), len(langs))
            means = sums / np.maximum(n, 1)[:, None] + other
            top = means.argmax(1) if len(langs) else np.zeros(len(texts), int)
            share = 1 / np.exp(np.minimum(0.0, means - means.max(1, keepdims=True)) * 20).sum(1) if len(langs) else np.zeros(len(texts))
            yield pd.DataFrame({"lang": [langs[i] if good else "und" for i, good in zip(top, some, strict=True)], "prob": np.where(some, share, 0.0)})

    return parts.withColumn("__l", F.pandas_udf(score, "lang string, prob double")("part")).withColumns({"lang": F.col("__l.lang"), "prob": F.col("__l.prob")}).drop("__l")


def vote(labelled: DataFrame) -> DataFrame:
    """(doc_id, part, lang, prob) to (doc_id, lang, share): letters times probability, of parts with enough letters."""
    weighed = labelled.withColumn("n", X.letters(F.col("part"))).where(F.col("n") >= MIN_LETTERS)
    sums = weighed.groupBy("doc_id", "lang").agg(F.sum(F.col("n") * F.col("prob")).alias("w"))
    total = sums.groupBy("doc_id").agg(F.sum("w").alias("total"))
    return sums.join(total, "doc_id").select("doc_id", "lang", F.when(F.col("total") > 0, F.col("w") / F.col("total")).otherwise(0.0).alias("share"))


def audit(docs: DataFrame, shares: DataFrame, target: str, threshold: float = 0.5) -> DataFrame:
    """Per document keep or cull by the target's share, with the three largest shares in words."""
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("o"), "lang", "share"))), 1, 3)
    summed = shares.groupBy("doc_id").agg(top.alias("top"), F.max(F.when(F.col("lang") == target, F.col("share"))).alias("own"))
    words = F.array_join(F.transform("top", lambda x: F.concat(x.lang, F.lit(" "), X.percent(x.share))), ", ")
    joined = docs.select("doc_id").join(summed, "doc_id", "left")
    keep = F.coalesce(F.col("own") >= F.lit(threshold), F.lit(False))
    return joined.select("doc_id", F.when(keep, "keep").otherwise("cull").alias("decision"), F.coalesce(words, F.lit("")).alias("summary"))
