"""Operator 2: token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character; dynamic programming carries the best
score and the number of pieces, and keeps no path. The result is that of a unigram tokenizer over the same pieces
and scores: blanks become U+2581, one is put in front, and at equal scores the piece that starts first wins. A
character without a piece of its own costs the least score less 10; where the vocabulary has all byte pieces it
counts as its UTF-8 bytes, else a run of such characters counts once.

Edge cases: a null or empty text has 0 tokens and score 0; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Units (blank-led words) whose counts a worker remembers, and the longest that it remembers.
CACHE_UNITS, CACHE_CHARS = 1 << 19, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores of a unigram model; small (tens of thousands of entries) and of a size fixed by its file."""

    pieces: tuple[tuple[str, float], ...]

    @classmethod
    def from_sentencepiece(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls(tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())))


@dataclass
class Counter:
    """Counts pieces of texts; holds the automaton and a bounded memory of units."""

    vocabulary: Vocabulary
    memory: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in self.vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        have = {p for p, _ in self.vocabulary.pieces}
        self.unknown = min((s for _, s in self.vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_bytes = all(f"<0x{b:02X}>" in have for b in range(256))
        # No piece spans a boundary before a blank, or a line end, so each unit between them is scored by itself.
        apart = all(BLANK not in p.lstrip(BLANK) for p in have)
        lines = self.by_bytes and not any("\n" in p for p in have)
        self.units = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n" if lines else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+") if apart else re.compile("(?s).+")

    def unit(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        n = len(text)
        score, count, open_end = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found = self.automaton.iter(text)
        ahead = next(found, None)
        for end in range(1, n + 1):
            best, at, single = None, end, False
            while ahead is not None and ahead[0] == end - 1:
                length, value = ahead[1]
                total = score[end - length] + value
                if best is None or total > best or (total == best and end - length < at):
                    best, at = total, end - length
                single = single or length == 1
                ahead = next(found, None)
            pieces, unknown = count[at] + 1, False
            if not single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, unknown = total, True
                    if self.by_bytes:
                        pieces = count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = count[end - 1] + (not open_end[end - 1])
            score[end], count[end], open_end[end] = best, pieces, unknown
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        tokens, total, memory = 0, 0.0, self.memory
        for unit in self.units.findall(BLANK + text.replace(" ", BLANK)):
            known = memory.get(unit)
            if known is None:
                known = self.unit(unit)
                if len(unit) <= CACHE_CHARS:
                    if len(memory) >= CACHE_UNITS:
                        memory.clear()
                    memory[unit] = known
            tokens += known[0]
            total += known[1]
        return tokens, total


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens long and best_score double for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(shared.value)
            found = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())], [id_col, "n_tokens", "best_score"])

    rows = docs.select(id_col, docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(count, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, best_score double")
