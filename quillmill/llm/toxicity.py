"""Operator 6: toxicity by weak supervision.

Terms are word beginnings of four to six bytes, A-Z in lower case, hashed. Voters: LEXICONS lexicons of terms that are
frequent in texts of label 1 and rare in those of label 0 among the labelled rows learned from. A lexicon votes toxic (2)
where the hits of its terms for each word reach a limit, not toxic (1) where they are below half of it in a text long
enough to tell, else abstains (0); it holds terms of every family of texts (such as a language), with a limit for each.
Pattern voters look for shouting, exclamation and insult frames. All documents vote; the counts of vote patterns (at
most 3 ** voters, however many documents) go to a generative label model: expectation maximisation, begun from the
labelled rows, estimates each voter's accuracy and the class balance, the correlation of each pair of voters beyond what
the label explains is estimated from the same counts, and correlated voters share their weight. Its posteriors train a
linear classifier (logistic regression on rates and log counts of hashed terms) that scores every document.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1, at most SAMPLE_ROWS of them, chosen by a
hash; the classifier is trained on the posteriors of these rows and of at most UNLABELLED_ROWS of all documents, chosen by
a hash too. doc_id, labels, lang and source are never inputs of a score.

Edge cases: null and empty texts have no terms and get a score as others do; without labels of both classes there are
no lexicons, and all scores are the (smoothed) share of label 1; repeated rows get equal scores; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import blocks as B
from quillmill.llm import text as T
from quillmill.llm.linear import adam, sigmoid
from quillmill.llm.quality_classifier import held_out

#: Largest number of labelled rows that are learned from, and of any rows whose posteriors train the classifier too.
SAMPLE_ROWS, UNLABELLED_ROWS = 6_000, 6_000
BEGINNINGS, SPACE = (4, 5, 6), 1 << 40
LEXICONS, FAMILIES, LEXICON_TERMS, LONG_ENOUGH = 4, 8, 512, 8
#: Log odds of rates from which a term marks label 1, a rate that counts as none, and false votes that outweigh a right one.
ODDS, RARE, PRECISION = 2.0, 2e-5, 2
PATTERNS, CLASSIFIER_TERMS, SHORT = 3, 4096, 20
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


@dataclass(frozen=True)
class Bags:
    """Distinct hashed terms of texts and how often each occurs, with offsets, and the words of each text."""

    terms: np.ndarray
    count: np.ndarray
    off: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, buf: np.ndarray, off: np.ndarray, known: np.ndarray | None = None) -> Bags:
        """Of texts; if known is given, of those terms only."""
        low = T.lower_ascii(buf)
        starts, ends, first = T.word_spans(low, off)
        n = np.diff(first)
        doc = np.repeat(np.arange(len(n)), n)
        keys = []
        for k in BEGINNINGS:
            long = ends - starts >= k
            term = T.span_hashes(low, starts[long], starts[long] + k) % T.U64(SPACE)
            key = term.astype(np.int64)
            some = slice(None) if known is None else find(known, key) >= 0
            keys.append(doc[long][some] * SPACE + key[some])
        found, count = np.unique(np.concatenate(keys), return_counts=True)
        return cls(found % SPACE, count, np.searchsorted(found // SPACE, np.arange(len(n) + 1)), n)

    @classmethod
    def joined(cls, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Bags:
        """From (terms, counts, words) of each text."""
        off = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows], dtype=np.int64)]).astype(np.int64)
        terms = np.concatenate([np.zeros(0, np.int64), *(r[0] for r in rows)])
        return cls(terms, np.concatenate([np.zeros(0, np.int32), *(r[1] for r in rows)]), off, np.array([r[2] for r in rows], np.int64))

    def __len__(self) -> int:
        return len(self.words)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.off))

    def only(self, known: np.ndarray) -> Bags:
        """The same texts with those of their terms that are known."""
        kept = find(known, self.terms) >= 0
        return Bags(self.terms[kept], self.count[kept], np.concatenate([[0], np.cumsum(kept)])[self.off], self.words)

    def beside(self, other: Bags) -> Bags:
        """These texts and others behind them."""
        return Bags(np.concatenate([self.terms, other.terms]), np.concatenate([self.count, other.count]), np.concatenate([self.off, self.off[-1] + other.off[1:]]), np.concatenate([self.words, other.words]))

    def rates(self, doc: np.ndarray) -> np.ndarray:
        """Occurrences of each term for each word of its text; a short text counts as of SHORT words."""
        return self.count / np.maximum(self.words[doc], SHORT)


def patterns(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Pattern votes (0 abstains, 1 not toxic, 2 toxic) of each text: shouting, exclamation, a frame such as 'you are a'."""
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (_UPPER[buf], buf == 33, T.IS_WORD[buf])]
    upper, marks, solid = (s[off[1:]] - s[off[:-1]] for s in sums)
    out = np.zeros((len(off) - 1, PATTERNS), np.int8)
    out[:, 0] = np.where(upper > 0.5 * np.maximum(solid, 40), 2, 0)
    out[:, 1] = np.where(marks > 0.02 * np.maximum(solid, 200), 2, 0)
    data = T.lower_ascii(buf).tobytes()
    for i in range(len(off) - 1):
        own = data[off[i] : off[i + 1]]
        if b"you are a" in own or b"you're a" in own or b"shut up" in own:
            out[i, 2] = 2
    return out


def find_sorted(chosen: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Place in chosen (in any order) of each of the given numbers, or -1."""
    order = np.argsort(chosen)
    place = find(chosen[order], at)
    return np.where(place >= 0, order[place], -1) if len(chosen) else place


def find(known: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Place of each term among the sorted known ones, or -1."""
    if not len(known):
        return np.full(len(terms), -1)
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    return np.where(known[at] == terms, at, -1)


@dataclass(frozen=True)
class Voters:
    """Sorted terms, which of them each lexicon counts in each family, and the rates of hits from which it votes toxic."""

    terms: np.ndarray
    member: np.ndarray  # terms x (lexicon, family)
    limit: np.ndarray  # of each (lexicon, family)

    @classmethod
    def learn(cls, bags: Bags, y: np.ndarray) -> Voters:
        """Terms that are frequent in texts of label 1 and rare in those of label 0, dealt out to lexicons.

        What counts is the rate: a word beginning may occur in many texts of both labels and still be far more frequent
        in those of one. Terms that occur in the same texts, as those of one language do, are a family; every lexicon
        gets terms of every family, so that lexicons differ in their words and not in the texts that they can judge.
        """
        known, at = np.unique(bags.terms, return_inverse=True)
        doc = bags.doc()
        rate, label, size = bags.rates(doc), y[doc], [max(1, int((y == c).sum())) for c in (0, 1)]
        mean = [np.bincount(at, rate * (label == c), len(known)) / size[c] for c in (0, 1)]
        spread = [np.bincount(at, rate * rate * (label == c), len(known)) / size[c] - mean[c] ** 2 for c in (0, 1)]
        have = np.bincount(at, label, len(known))
        odds = np.log((mean[1] + RARE) / (mean[0] + RARE))
        z = (mean[1] - mean[0]) / np.sqrt(spread[0] / size[0] + spread[1] / size[1] + 1e-12)
        marks = np.flatnonzero((odds > ODDS) & (z > 2.5) & (have >= max(4, 0.015 * size[1])))
        marks = marks[np.argsort(-(odds * have)[marks], kind="stable")][:LEXICON_TERMS]
        place = find_sorted(marks, at)
        hit = (place >= 0) & (label == 1)
        texts = [set(doc[hit][place[hit] == i].tolist()) for i in range(len(marks))]
        families: list[list[int]] = []
        for i, own in enumerate(texts):
            near = [len(own & texts[f[0]]) / np.sqrt(len(own) * len(texts[f[0]])) for f in families]
            if near and (max(near) > 0.3 or len(families) >= FAMILIES):
                families[int(np.argmax(near))].append(i)
            else:
                families.append([i])
        order = np.argsort(marks)
        member = np.zeros((len(marks), LEXICONS, FAMILIES), bool)
        for f, members in enumerate(families):
            for i in range(max(len(members), LEXICONS)):  # a small family's terms serve several lexicons
                member[members[i % len(members)], i % LEXICONS, f] = True
        made = cls(known[marks[order]], member[order].reshape(len(marks), LEXICONS * FAMILIES), np.full(LEXICONS * FAMILIES, np.inf))
        rates = made.rates(bags)
        for g in range(rates.shape[1]):
            turn = np.argsort(-rates[:, g], kind="stable")
            right, r = np.cumsum(y[turn]), rates[turn, g]
            gain = np.where(np.append(r[1:] < r[:-1], True) & (r > 0), right - PRECISION * (np.arange(1, len(y) + 1) - right), 0)
            if len(gain) and gain.max() > 0:
                best = int(np.argmax(gain))
                made.limit[g] = (r[best] + (r[best + 1] if best + 1 < len(r) else 0.0)) / 2
        return made

    def rates(self, bags: Bags) -> np.ndarray:
        """Hits of each lexicon's terms of each family for each word, of each text."""
        known = bags.only(self.terms)
        m = len(self.terms)
        hits = np.bincount(known.doc() * np.int64(m) + find(self.terms, known.terms), known.count, len(bags) * m).reshape(len(bags), m) if m else np.zeros((len(bags), 0))
        return hits @ self.member / np.maximum(bags.words, SHORT)[:, None]

    def votes(self, bags: Bags) -> np.ndarray:
        """Of each lexicon: toxic where the rate of any family's terms is high, not toxic where all are low, else abstains."""
        rate = self.rates(bags)
        high, low = ((x.reshape(len(bags), LEXICONS, FAMILIES)) for x in (rate >= self.limit, rate < self.limit / 2))
        some = (bags.words >= LONG_ENOUGH)[:, None]
        return np.where(high.any(2), 2, np.where(low.all(2) & some, 1, 0)).astype(np.int8)


class LabelModel:
    """P(label | votes) from counts of vote patterns, by accuracies, class balance and pairwise correlations."""

    def __init__(self, votes: np.ndarray, count: np.ndarray, prior: float, start: np.ndarray | None = None, rounds: int = 50):
        """start: for each voter and label how often it said each of abstain, not toxic and toxic on rows with known labels."""
        m = votes.shape[1]
        self.weight, self.prior = np.ones(m), float(np.clip(prior, 0.005, 0.5))
        table = np.array([[0.0, 0.85, 0.15], [0.0, 0.15, 0.85]])
        self.table = np.repeat(table[None], m, 0) if start is None else (start + 4 * table) / (start[:, :, 1:].sum(2, keepdims=True) + 4)
        self.table[:, :, 0] = 1.0  # abstaining says nothing
        self.table = np.log(self.table)
        if not len(votes):
            self.correlation = np.eye(m)
            return
        for _ in range(rounds):
            p = self.posterior(votes)
            share = np.array([((1 - p) * count).sum(), (p * count).sum()])
            self.prior = float(np.clip(share[1] / share.sum(), 0.005, 0.5))
            for j in range(m):
                for c, q in ((0, 1 - p), (1, p)):
                    n = np.array([(q * count)[votes[:, j] == v].sum() for v in (1, 2)]) + 1.0
                    self.table[j, c, 1:] = np.log(n / n.sum())
            self._correlations(votes, count, p)

    def _correlations(self, votes: np.ndarray, count: np.ndarray, p: np.ndarray) -> None:
        """Correlation of the voters' residuals given the label; a voter's weight is shared with those that echo it."""
        x, total = (votes == 2).astype(float), np.zeros((votes.shape[1],) * 2)
        for q in (1 - p, p):
            w = q * count
            mean = (w @ x) / max(w.sum(), 1e-9)
            total += ((x - mean) * w[:, None]).T @ (x - mean)
        scale = np.sqrt(np.maximum(np.diag(total), 1e-9))
        self.correlation = total / np.outer(scale, scale)
        echo = np.clip(self.correlation, 0, 1)
        np.fill_diagonal(echo, 1)
        self.weight = 1 / echo.sum(1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        j = np.arange(votes.shape[1])
        said = self.table[j, 1, votes] - self.table[j, 0, votes]
        return sigmoid(np.log(self.prior / (1 - self.prior)) + said @ self.weight)


def label_terms(bags: Bags, target: np.ndarray) -> np.ndarray:
    """The terms whose rate differs most between the labels, at most CLASSIFIER_TERMS of them, sorted."""
    known, at = np.unique(bags.terms, return_inverse=True)
    doc = bags.doc()
    rate, p, n = bags.rates(doc), target[doc], len(bags)
    total = np.bincount(at, rate, len(known))
    share = target.mean()
    scale = np.sqrt(share * (1 - share) * np.maximum(np.bincount(at, rate * rate, len(known)) - total * total / n, 1e-12))
    z = (np.bincount(at, rate * p, len(known)) - total * share) / scale
    chosen = np.flatnonzero((np.bincount(at, minlength=len(known)) >= 4) & (np.abs(z) > 4))
    return np.sort(known[chosen[np.argsort(-np.abs(z[chosen]), kind="stable")][:CLASSIFIER_TERMS]])


class Linear:
    """Logistic regression with weight decay on the rates of the given terms and the logarithms of their counts."""

    def __init__(self, terms: np.ndarray, bags: Bags, target: np.ndarray, prior: float, steps: int = 600, decay: float = 1e-5):
        self.terms, self.w, self.b = np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
        if not len(bags) or not len(terms) or np.ptp(target) < 0.1:
            return
        self.terms, m = terms, len(terms)
        known = bags.only(terms)
        doc, at = known.doc(), find(terms, known.terms)
        rate, some = SHORT * known.rates(doc), np.log1p(known.count)

        def gradient(w: list[np.ndarray], _: np.ndarray) -> list[np.ndarray]:
            d = sigmoid(np.bincount(doc, w[0][at] * rate + w[0][m + at] * some, len(bags)) + w[1][0]) - target
            g = np.concatenate([np.bincount(at, d[doc] * rate, m), np.bincount(at, d[doc] * some, m)])
            return [g / len(bags) + decay * w[0], np.array([d.mean()])]

        w, b = adam(gradient, [np.zeros(2 * m), np.array([self.b])], len(bags), steps, len(bags), 0.1)
        self.w, self.b = w, float(b[0])

    def score(self, bags: Bags) -> np.ndarray:
        if not len(self.terms):
            return sigmoid(np.full(len(bags), self.b))
        known = bags.only(self.terms)
        doc, at = known.doc(), find(self.terms, known.terms)
        return sigmoid(np.bincount(doc, self.w[at] * SHORT * known.rates(doc) + self.w[len(self.terms) + at] * np.log1p(known.count), len(bags)) + self.b)


def _scan(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, off = T.utf8(column)
    for i, j in T.slices(off):
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]


def _bag_rows(bags: Bags) -> list[bytes]:
    return [B.squeeze(bags.terms[a:b], bags.count[a:b].astype(np.int32)) for a, b in zip(bags.off[:-1], bags.off[1:], strict=True)]


def _bags_of(blobs: list[bytes], words: list[int]) -> Bags:
    return Bags.joined([(*B.expand(b, np.int64, np.int32), w) for b, w in zip(blobs, words, strict=True)])


def _sampled(text: DataFrame, terms: np.ndarray, voters: Voters, rows: int) -> tuple[Bags, np.ndarray]:
    """The bags and votes of at most so many documents, chosen by a hash of their id, whether labelled or not."""
    total = max(1, text.count())
    shared = text.sparkSession.sparkContext.broadcast((np.union1d(terms, voters.terms), voters))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = shared.value
        for batch in batches:
            for i, j, buf, off in _scan(batch.column(1)):
                bags = Bags.of(buf, off, known)
                cast = np.concatenate([own.votes(bags), patterns(buf, off)], 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(_bag_rows(bags), pa.binary()), pa.array(bags.words, pa.int64()), pa.array([v.tobytes() for v in cast], pa.binary())], ["place", "bag", "words", "votes"])

    place = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30))
    some = text.select(place.alias("place"), "text").where(F.col("place") < int(min(1.0, 1.2 * rows / total) * (1 << 30)))
    got = some.mapInArrow(extract, "place long, bag binary, words long, votes binary").orderBy("place", "bag", "words", "votes").limit(rows).toPandas()
    bags = _bags_of(list(got["bag"]), got["words"].tolist())
    return bags, np.frombuffer(b"".join(got["votes"]), np.int8).reshape(len(got), LEXICONS + PATTERNS)


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, sample_rows: int, unlabelled_rows: int) -> Linear:
    """Lexicons from labels, label model from all documents' votes, classifier from posteriors of labelled and other rows."""
    context = docs.sparkSession.sparkContext
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in _scan(batch.column(2)):
                bags = Bags.of(buf, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(_bag_rows(bags), pa.binary()), pa.array(bags.words, pa.int64()), pa.array([v.tobytes() for v in patterns(buf, off)], pa.binary())],
                    ["place", "y", "bag", "words", "patterns"],
                )

    labelled = text.join(F.broadcast(sample), "doc_id").select(F.xxhash64("doc_id").alias("place"), "y", "text")
    chosen = labelled.mapInArrow(extract, "place long, y int, bag binary, words long, patterns binary").orderBy("place", "y", "bag", "words", "patterns").limit(sample_rows).toPandas()  # ids may repeat
    y = chosen["y"].to_numpy(np.int8)
    prior = float((y.sum(dtype=int) + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        return Linear(np.zeros(0, np.int64), Bags.joined([]), np.zeros(0), prior)
    bags, marks = _bags_of(list(chosen["bag"]), chosen["words"].tolist()), np.frombuffer(b"".join(chosen["patterns"]), np.int8).reshape(len(y), PATTERNS)
    del chosen
    voters = Voters.learn(bags, y)
    shared = context.broadcast(voters)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in _scan(batch.column(0)):
                cast = np.concatenate([shared.value.votes(Bags.of(buf, off, shared.value.terms)), patterns(buf, off)], 1)
                code, n = np.unique(cast.astype(np.int64) @ 3 ** np.arange(LEXICONS + PATTERNS), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    counted = text.select("text").mapInArrow(vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()  # at most 3 ** 7 rows
    counted = counted.sort_values("code")
    votes = (counted["code"].to_numpy()[:, None] // 3 ** np.arange(LEXICONS + PATTERNS)) % 3
    own = np.concatenate([voters.votes(bags), marks], 1)
    start = np.array([[[np.sum(own[y == c][:, j] == v) for v in (0, 1, 2)] for c in (0, 1)] for j in range(own.shape[1])], float)
    model = LabelModel(votes, counted["n"].to_numpy(float), prior, start)
    target = model.posterior(own)
    terms = label_terms(bags, target)
    bags = bags.only(terms)
    others, other_votes = _sampled(text, terms, voters, unlabelled_rows)
    return Linear(terms, bags.beside(others), np.concatenate([target, model.posterior(other_votes)]), model.prior)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS
) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label_col, id_col, text_col, sample_rows, unlabelled_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for i, j, buf, off in _scan(batch.column(1)):
                s[i:j] = model.value.score(Bags.of(buf, off, model.value.terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of docs that score under the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, "toxic", "doc_id", "text", SAMPLE_ROWS, UNLABELLED_ROWS))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for i, j, buf, off in _scan(batch.column(at)):
                s[i:j] = model.value.score(Bags.of(buf, off, model.value.terms))
            yield batch.filter(pa.array(s < threshold))

    return docs.mapInArrow(keep, docs.schema)
