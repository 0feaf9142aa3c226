"""Language classifier: hashed character n-grams, a linear softmax trained by summed gradients, calibrated probabilities.

Texts are cut into the same pieces as in an audit. Of each language at most SAMPLE pieces are learned from, those with the
least hash of their document and place, so that the model does not depend on how rows are dealt out. Pieces become sparse
vectors once, in a checkpoint; each round, every task adds up the gradient of its pieces, the sums of all tasks meet by
language, and the driver takes one step. What travels is a row for each task and language and round (4 bytes a bucket), and
the model itself: LANGUAGES * BUCKETS numbers at most. A fifth of the sampled documents is kept from the training, and
sets the temperature that the probabilities are calibrated with.

A text without letters or marks of any kind is und with probability 0. Ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.operators import lid
from quillmill.session import checkpointed

#: Buckets of hashed n-grams, their lengths, pieces learned from for each language, and languages at most.
BUCKETS, LENGTHS, SAMPLE, LANGUAGES = 1 << 14, (1, 2, 3, 4), 2000, lid.LANGUAGES
#: Rounds and rate of the training, weight of the penalty, temperatures to choose from, characters hashed at a time.
ROUNDS, RATE, PENALTY, SLICE = 30, 2.0, 1e-5, 1 << 17
TEMPERATURES = np.geomspace(0.05, 20, 49)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def scores(self, owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Linear scores of n texts by their sparse vectors."""
        out = np.empty((n, len(self.languages)))
        for i, w in enumerate(self.weights):
            out[:, i] = np.bincount(owner, value * w[bucket], n) + self.bias[i]
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(1, keepdims=True)) if scores.size else scores
    return out / out.sum(1, keepdims=True) if scores.size else out


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the texts' n-grams: square roots of counts, of length one; nothing for blank texts."""
    owners, buckets, values, first = [], [], [], 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= SLICE):
            size += len(texts[last])
            last += 1
        padded = [f" {t.lower()} " if t.strip() else "" for t in texts[first:last]]
        length = np.array([len(t) for t in padded])
        points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner, left = np.repeat(np.arange(len(padded)), length), np.repeat(np.cumsum(length), length) - np.arange(len(points))
        keys, code = [], np.zeros(len(points), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            shifted = np.concatenate([points[n - 1 :], np.zeros(min(n - 1, len(points)), np.uint64)])
            code = (code ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            if n in LENGTHS:
                whole = left >= n  # the n-gram ends within its text
                keys.append(owner[whole] * BUCKETS + (code[whole] >> np.uint64(64 - 14)).astype(np.int64) % BUCKETS)
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        own, value = key // BUCKETS, np.sqrt(count)
        norm = np.sqrt(np.bincount(own, value**2, len(padded)))
        owners.append(own + first)
        buckets.append(key % BUCKETS)
        values.append(value / norm[own])
        first = last
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *owners]), np.concatenate([empty, *buckets]), np.concatenate([np.zeros(0), *values])


def _sampled(docs: DataFrame, sample: int) -> DataFrame:
    """(lang, held, part): pieces to learn from, and those of the documents that are kept for the temperature."""
    rows = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text")
    parts = lid.chunks(rows).join(rows.select("doc_id", "lang").distinct(), "doc_id")
    order = F.row_number().over(Window.partitionBy("lang").orderBy("__h", "doc_id", "chunk"))
    # hashes below a bound first: the window sees few more rows than it keeps
    hashed = parts.withColumn("__h", F.xxhash64("doc_id", "chunk")).where(F.length(F.btrim("part")) > 0)
    counts = hashed.groupBy("lang").agg(F.count("*").alias("n"))
    near = hashed.join(F.broadcast(counts), "lang").where((F.pmod("__h", F.lit(1 << 20)) < F.lit(float(4 * sample) * (1 << 20)) / F.col("n")))
    held = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(5)) == 0
    return near.withColumn("__rank", order).where(F.col("__rank") <= sample).select("lang", held.alias("held"), "part")


def _vectorised(rows: DataFrame, languages: list[str]) -> DataFrame:
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("part").to_pylist()
            owner, bucket, value = vectors(texts)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            pack = lambda a, kind: pa.array([a[i:j].astype(kind).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            label = pa.array([place[x] for x in batch.column("lang").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([label, batch.column("held"), pack(bucket, np.int32), pack(value, np.float32)], ["label", "held", "buckets", "values"])

    return checkpointed(rows.mapInArrow(run, "label int, held boolean, buckets binary, values binary"))


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buckets = [np.frombuffer(x, np.int32) for x in batch.column("buckets").to_pylist()]
    values = [np.frombuffer(x, np.float32) for x in batch.column("values").to_pylist()]
    owner = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    return owner, np.concatenate([np.zeros(0, np.int32), *buckets]), np.concatenate([np.zeros(0, np.float32), *values]).astype(np.float64), batch.column("label").to_numpy()


def _gradient(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Mean gradient of the weights and the bias over all rows, each language counting alike."""
    shared, n_langs = rows.sparkSession.sparkContext.broadcast(model), len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, np.zeros((n_langs, BUCKETS + 2))
        for batch in batches:
            owner, bucket, value, label = _unpacked(batch)
            p = softmax(model.scores(owner, bucket, value, batch.num_rows))
            p[np.arange(len(label)), label] -= 1
            for i in range(n_langs):
                total[i, :BUCKETS] += np.bincount(bucket, value * p[owner, i], BUCKETS)
                total[i, BUCKETS] += p[:, i].sum()
            total[0, -1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_langs, dtype=np.int32)), pa.array([t.astype(np.float32).tobytes() for t in total], pa.binary())], ["label", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table["sums"].to_pylist())
        return pa.table({"label": table["label"].slice(0, 1), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    sums = np.zeros((n_langs, BUCKETS + 2))
    for r in rows.mapInArrow(run, "label int, sums binary").groupBy("label").applyInArrow(add, "label int, sums binary").collect():
        sums[r.label] = np.frombuffer(r.sums, np.float32)
    shared.destroy()
    n = max(sums[0, -1], 1)
    return sums[:, :BUCKETS] / n, sums[:, BUCKETS] / n


def _temperature(rows: DataFrame, model: Model) -> float:
    """The temperature under which the kept rows are likeliest."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        loss = np.zeros(len(TEMPERATURES))
        for batch in batches:
            owner, bucket, value, label = _unpacked(batch)
            scores = shared.value.scores(owner, bucket, value, batch.num_rows)
            for i, t in enumerate(TEMPERATURES):
                loss[i] -= np.log(np.maximum(softmax(scores / t)[np.arange(len(label)), label], 1e-12)).sum() if len(label) else 0.0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(TEMPERATURES), dtype=np.int32)), pa.array(loss)], ["t", "loss"])

    losses = rows.mapInArrow(run, "t int, loss double").groupBy("t").agg(F.sum("loss").alias("loss")).orderBy("loss", F.abs(F.col("t") - len(TEMPERATURES) // 2)).first()
    return float(TEMPERATURES[losses.t]) if losses is not None and losses.loss else 1.0


def train(docs: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """A model of the languages of docs (doc_id, text, lang)."""
    languages = [r.lang for r in docs.where("text is not null and lang is not null").select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    model = Model(sorted(languages), np.zeros((len(languages), BUCKETS)), np.zeros(len(languages)))
    if len(languages) < 2:
        return model
    rows = _vectorised(_sampled(docs, sample), model.languages)
    seen, squares = rows.where("not held"), (np.full_like(model.weights, 1e-8), np.full_like(model.bias, 1e-8))
    for _ in range(rounds):
        w, b = _gradient(seen, model)
        w += PENALTY * model.weights
        squares = (squares[0] + w**2, squares[1] + b**2)
        model = Model(model.languages, model.weights - RATE * w / np.sqrt(squares[0]), model.bias - 0.1 * b / np.sqrt(squares[1]))
    return Model(model.languages, model.weights, model.bias, _temperature(rows.where("held"), model))


def label(parts: DataFrame, model: Model) -> DataFrame:
    """Adds lang and prob to (.., part), as lid.label does, by the model."""
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch]
            owner, bucket, value = vectors(texts)
            some = np.bincount(owner, minlength=len(texts)) > 0
            p = softmax(model.scores(owner, bucket, value, len(texts)) / model.temperature)
            top = p.argmax(1) if p.size else np.zeros(len(texts), int)
            known = some & (len(model.languages) > 0)
            yield pd.DataFrame({"lang": [model.languages[i] if k else "und" for i, k in zip(top, known, strict=True)], "prob": np.where(known, p[np.arange(len(texts)), top], 0.0) if p.size else np.zeros(len(texts))})

    return parts.withColumn("__l", F.pandas_udf(score, "lang string, prob double")("part")).withColumns({"lang": F.col("__l.lang"), "prob": F.col("__l.prob")}).drop("__l")
