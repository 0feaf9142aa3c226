"""Repair of misread encodings by search: which characters are bytes of others, told by how usual the outcome is.

UTF-8 read as cp1252, Latin-1 or cp1254 turns each character beyond ASCII into two to four; read so twice, into more; and
bytes that a code page does not define are lost (U+FFFD). Along each run of characters beyond ASCII a dynamic programme
chooses, for every place, between leaving the character and taking the next two to four as the bytes of one, at the least
cost by a table of character bigrams; the table is counted over a corpus as a Spark job and has PAIRS rows at most. A lost
byte is any that its code page lacks. What was misread twice is repaired twice.

Text without a run that could be misread never leaves the JVM. Characters that are rare but right stay: taking characters
together costs TAKING, and the outcome must be likelier than what stands there.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmill.functions.expr import let

#: Bigrams kept, the most frequent; cost of taking characters together, and of one whose byte was lost; passes.
PAIRS, TAKING, LOST, PASSES = 20_000, 1.0, 3.0, 3
#: Code pages that UTF-8 is misread by.
PAGES = ("cp1252", "latin-1", "cp1254")


def _bytes_of() -> dict[str, set[int]]:
    """The bytes that a character may stand for."""
    found: dict[str, set[int]] = {}
    for page in PAGES:
        for b in range(0x80, 0x100):
            found.setdefault(bytes([b]).decode(page, "replace"), set()).add(b)
    for b in range(0x80, 0xA0):  # undefined bytes also come through as control characters
        found.setdefault(chr(b), set()).add(b)
    return found


BYTES = _bytes_of()
_LEADS = "".join(sorted(c for c, bs in BYTES.items() if c != "�" and any(0xC2 <= b <= 0xF4 for b in bs)))
_FOLLOWS = "".join(sorted(c for c, bs in BYTES.items() if any(b < 0xC0 for b in bs)))
#: A character that can lead a sequence, and one that can follow it.
MISREAD = f"[{re.escape(_LEADS)}][{re.escape(_FOLLOWS)}]"
_RUN = re.compile(r"[^\x00-\x7f]+")


def bigrams(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Cost of each usual bigram with a character beyond ASCII, and under "" that of any other: what comes to the driver is PAIRS rows."""
    characters = F.split(F.concat(F.lit(" "), F.col(text_col), F.lit(" ")), "")
    rows = docs.where(F.col(text_col).rlike(r"[^\x00-\x7f]")).select(characters.alias("c"))
    pairs = rows.select(F.explode(F.transform(F.slice("c", 1, F.size("c") - 1), lambda a, i: F.concat(a, F.get("c", i + 1)))).alias("p"))
    counted = pairs.where(F.col("p").rlike(r"[^\x00-\x7f]")).groupBy("p").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("s")).first().s or 1
    top = counted.orderBy(F.desc("n"), "p").limit(PAIRS).collect()
    return {"": math.log(total + 1) + 1} | {r.p: math.log((total + 1) / r.n) for r in top}


def _taken(run: str, i: int) -> list[tuple[int, str, float]]:
    """(length, character, cost) of the characters that may be encoded at a place."""
    out = []
    for lead in BYTES.get(run[i], ()):
        n = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
        if not n or i + n > len(run) or run[i] == "�":
            continue
        options = [bytes([lead])]
        for c in run[i + 1 : i + n]:
            options = [o + bytes([b]) for o in options for b in BYTES.get(c, ()) if b < 0xC0]
        cost = TAKING + LOST * run.count("�", i, i + n)
        for o in options:
            try:
                c = o.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if unicodedata.category(c) not in ("Cn", "Co", "Cs") and (n, c, cost) not in out:
                out.append((n, c, cost))
    return out


def mend_run(run: str, before: str, after: str, cost: dict[str, float]) -> str:
    """The run with the least cost, between the characters that stand beside it."""
    other = cost[""]
    pair = lambda a, b: cost.get(a + b, other)
    best: list[dict[str, tuple[float, str]]] = [{} for _ in range(len(run) + 1)]
    best[0][before] = (0.0, "")
    for i in range(len(run)):
        steps = [(1, run[i], 0.0), *_taken(run, i)]
        for last, (so_far, text) in best[i].items():
            for n, c, extra in steps:
                total = so_far + pair(last, c) + extra
                have = best[i + n].get(c)
                if have is None or total < have[0]:
                    best[i + n][c] = (total, text + c)
    return min((so_far + pair(last, after), text) for last, (so_far, text) in best[-1].items())[1]


def mend(text: str, cost: dict[str, float]) -> str:
    """The text with every run mended, again while that changes something."""
    misread = re.compile(MISREAD)
    for _ in range(PASSES):
        def one(m: re.Match) -> str:
            run, source = m.group(), m.string
            if not misread.search(run):
                return run
            return mend_run(run, source[m.start() - 1 : m.start()] or " ", source[m.end() : m.end() + 1] or " ", cost)

        done = _RUN.sub(one, text)
        if done == text:
            return text
        text = done
    return text


def repairer(cost: dict[str, float]) -> Callable[[Column], Column]:
    """A function of a text column that mends it; text that cannot be misread is handed to Python as null."""

    @F.pandas_udf(StringType())
    def mended(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else mend(t, cost))

    def repair(text: Column) -> Column:
        odd = let(text, lambda t: F.when((F.octet_length(t) != F.char_length(t)) & t.rlike(MISREAD), t))
        return F.coalesce(mended(odd), text)

    return repair
