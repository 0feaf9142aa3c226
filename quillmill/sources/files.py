"""Files of books: text, EPUB, PDF (where a reader is installed) to (path, raw)."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import textnorm as X

SUFFIXES = ("txt", "epub", "pdf")


def scan_books(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of all files with a known suffix, at any depth."""
    pattern = "*.{" + ",".join(s for x in SUFFIXES for s in (x, x.upper())) + "}"
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")


def _pdf(data: bytes) -> str | None:
    try:
        import fitz
    except ImportError:
        return None
    with fitz.open(stream=data, filetype="pdf") as book:
        return "\n".join(page.get_text() for page in book)


def _members(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [z.read(n).decode("utf-8", "replace") for n in sorted(z.namelist()) if n.lower().endswith((".xhtml", ".html", ".htm"))]


def read_books(files: DataFrame) -> DataFrame:
    """(path, content) to (path, raw, error): text with replacement of bad bytes; an EPUB's pages, each without markup.

    An unreadable archive, or a PDF where no reader is installed, gives a null raw and says why.
    """

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                data, suffix = bytes(content or b""), path.rsplit(".", 1)[-1].lower()
                try:
                    if suffix == "epub":
                        out.append((path, _members(data), True, None))
                    elif suffix == "pdf":
                        text = _pdf(data)
                        out.append((path, None if text is None else [text], False, "no PDF reader" if text is None else None))
                    else:
                        out.append((path, [data.decode("utf-8", "replace")], False, None))
                except (zipfile.BadZipFile, RuntimeError, ValueError) as problem:
                    out.append((path, None, False, f"{type(problem).__name__}: {problem}"[:200]))
            yield pd.DataFrame(out, columns=["path", "parts", "markup", "error"])

    rows = files.mapInPandas(parts, "path string, parts array<string>, markup boolean, error string")
    pages = rows.select("path", "markup", "error", F.posexplode_outer("parts").alias("pos", "part"))
    text = F.when(F.col("markup"), X.strip_markup(F.col("part"))).otherwise(F.col("part"))
    joined = pages.select("path", "error", "pos", text.alias("part")).groupBy("path").agg(F.first("error").alias("error"), F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "part")))).alias("p"), F.count("pos").alias("n"))
    return joined.select("path", F.when((F.col("n") > 0) | F.col("error").isNull(), F.array_join("p.part", "\n")).alias("raw"), "error")
