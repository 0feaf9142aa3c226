"""Data source for a bencoded dictionary of run-length-encoded bitmaps: one partition for each PART_BYTES of a catalog.

spark.dataSource.register(BitmapSource); spark.read.format("bencoded_bitmaps").load(path) gives (catalog, catalog_pos,
pos, run_len). Opening the file walks the keys and seeks past the values; a partition reads its own range only. The
option catalogs names the wanted ones, separated by commas; partBytes sets the size of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

READ_BYTES, PART_BYTES = 1 << 20, 16 << 20


def _length(f: BinaryIO, start: bytes = b"") -> int:
    digits = start
    while (c := f.read(1)) != b":":
        if not c.isdigit():
            raise ValueError("not a bencoded string")
        digits += c
    return int(digits)


def directory(f: BinaryIO) -> dict[str, tuple[int, int]]:
    """Offset and length of each value, in file order."""
    if f.read(1) != b"d":
        raise ValueError("not a bencoded dictionary")
    found = {}
    while (c := f.read(1)) != b"e":
        name = f.read(_length(f, c)).decode()
        size = _length(f)
        found[name] = (f.tell(), size)
        f.seek(size, 1)
    return found


def opened(path: str) -> BinaryIO:
    """A seekable file of the local disk or of any store that Arrow knows by its URI (hdfs, s3, gs, ...)."""
    if path.startswith("file:") or "://" not in path:
        return open(path.removeprefix("file:").replace("//", "/", 1) if path.startswith("file:") else path, "rb")
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


@dataclass
class Range(InputPartition):
    catalog: str
    place: int
    offset: int
    size: int
    first: int


class BitmapReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.part_bytes = max(4, int(options.get("partbytes", options.get("partBytes", PART_BYTES))) // 4 * 4)
        self.wanted = {c.strip() for c in options.get("catalogs", "").split(",") if c.strip()}

    def partitions(self) -> list[Range]:
        with opened(self.path) as f:
            found = [(name, i, at, size) for i, (name, (at, size)) in enumerate(directory(f).items()) if not self.wanted or name in self.wanted]
        # runs are four bytes each, so a part knows its first run's number
        return [Range(name, i, at + start, min(self.part_bytes, size - start), start // 4) for name, i, at, size in found for start in range(0, size, self.part_bytes)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with opened(self.path) as f:
            f.seek(part.offset)
            left, pos = part.size - part.size % 4, part.first
            while left:
                data = f.read(min(READ_BYTES, left))
                left -= len(data)
                runs = np.frombuffer(data, "<u4").astype(np.int64)
                n = len(runs)
                yield pa.RecordBatch.from_arrays([pa.array([part.catalog] * n), pa.array(np.full(n, part.place, np.int32)), pa.array(np.arange(pos, pos + n)), pa.array(runs)], ["catalog", "catalog_pos", "pos", "run_len"])
                pos += n


class BitmapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bencoded_bitmaps"

    def schema(self) -> str:
        return "catalog string, catalog_pos int, pos long, run_len long"

    def reader(self, schema) -> BitmapReader:
        return BitmapReader(self.options)
