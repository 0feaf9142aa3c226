"""A tree of text files, one for each row, that appears whole: a data source with a commit.

    spark.dataSource.register(TextTree)
    rows.select("path", "body").write.format("text_tree").mode("append").save(root)
    spark.read.format("text_tree").option("chars", 2000).load(root)      # path, and the first characters of each body

Tasks write their files beside the tree, each under its own attempt, and list where they belong; the commit moves them, file by file
and each at once, into their places. If the job fails, what was written aside is deleted and the tree is as it was. A row
of another path than a relative one fails the job. Rows should differ in their paths: of equal ones any stays. With mode
append, files of earlier runs stay unless a row has their path; with overwrite the tree is emptied by the commit.

Reading lists the top folders on the driver and the files within on the executors. A null body is an empty file.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Folders that one task reads, moves that the commit makes at a time, and characters of a record's head.
FOLDERS, MOVES, HEAD = 64, 16, 2000
#: Folders beside the tree in which files wait for the commit, and tenths of a second in which killed tasks come to rest.
ASIDE, SETTLE = ".aside-", 20


def store_of(root: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI or a local path, and the path within it."""
    return fs.FileSystem.from_uri(root if "://" in root else "file://" + root.removeprefix("file:"))


def _checked(path: str | None) -> str:
    parts = (path or "").split("/")
    if "" in parts or ".." in parts or "." in parts:
        raise ValueError(f"not a path within the tree: {path!r}")
    return path


@dataclass
class Written(WriterCommitMessage):
    """A task's folder of numbered files and the list of their places, which stays in the store."""

    folder: str
    files: int


class TreeWriter(DataSourceArrowWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite = root.rstrip("/"), overwrite
        above, _, name = self.root.rpartition("/")
        self.aside = f"{above}/{ASIDE}{name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, aside = store_of(self.aside)
        folder, n = f"{aside}/{uuid.uuid4().hex}", 0
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/places", compression=None) as places:
            for batch in iterator:
                for path, body in zip(batch.column("path"), batch.column("body"), strict=True):
                    with store.open_output_stream(f"{folder}/{n}", compression=None) as out:
                        out.write((body.as_py() or "").encode())
                    places.write(_checked(path.as_py()).encode() + b"\n")
                    n += 1
        return Written(folder, n)

    def commit(self, messages: list[Written | None]) -> None:
        (store, aside), (_, root) = store_of(self.aside), store_of(self.root)
        if self.overwrite:
            store.delete_dir_contents(root, missing_dir_ok=True)

        def place(job: tuple[str, str]) -> None:
            source, path = job
            store.create_dir(f"{root}/{path}".rpartition("/")[0], recursive=True)
            store.move(source, f"{root}/{path}")

        def jobs() -> Iterator[tuple[str, str]]:
            for m in messages:
                if m:
                    with store.open_input_stream(f"{m.folder}/places", compression=None) as places:
                        for n, line in enumerate(places.read().decode().split("\n")[:-1]):  # one task's names
                            yield f"{m.folder}/{n}", line

        with ThreadPoolExecutor(MOVES) as pool:
            todo = jobs()
            while some := list(islice(todo, 64 * MOVES)):  # names are never all in memory
                list(pool.map(place, some))
        store.delete_dir(aside)

    def abort(self, messages: list[Written | None]) -> None:
        store, aside = store_of(self.aside)
        for _ in range(SETTLE):  # tasks that are being killed may still write
            if store.get_file_info(aside).type == fs.FileType.Directory:
                store.delete_dir(aside)
            time.sleep(0.1)


@dataclass
class Folders(InputPartition):
    names: list[str]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.chars = options["path"].rstrip("/"), int(options.get("chars", 0))

    def partitions(self) -> list[Folders]:
        store, root = store_of(self.root)
        found = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)))
        return [Folders(found[i : i + FOLDERS]) for i in range(0, len(found), FOLDERS)] or [Folders([])]

    def read(self, part: Folders) -> Iterator[tuple[str, str]]:
        store, root = store_of(self.root)
        for name in part.names:
            top = store.get_file_info(f"{root}/{name}")
            found = [top] if top.type == fs.FileType.File else store.get_file_info(fs.FileSelector(top.path, recursive=True))
            for info in found:
                if info.type == fs.FileType.File:
                    with store.open_input_stream(info.path, compression=None) as f:
                        body = f.read(4 * self.chars if self.chars else None).decode("utf-8", "replace")  # a character has four bytes at most
                    yield info.path.removeprefix(root).lstrip("/"), body[: self.chars] if self.chars else body


class TextTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_tree"

    def schema(self) -> str:
        return "path string, body string"

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options["path"], overwrite)


def write_tree(rows: DataFrame, root: str, path_col: str = "path", body_col: str = "record") -> None:
    """A file for each row with a body, beside those of earlier runs."""
    rows.sparkSession.dataSource.register(TextTree)
    texts = rows.where(F.col(body_col).isNotNull()).select(F.col(path_col).alias("path"), F.col(body_col).alias("body"))
    texts.write.format("text_tree").mode("append").save(root)


def saved(spark: SparkSession, root: str) -> DataFrame:
    """(path, isbn) of the records in a tree, by their heads; an empty isbn where the head has none."""
    spark.dataSource.register(TextTree)
    heads = spark.read.format("text_tree").option("chars", HEAD).load(root)
    return heads.select("path", F.regexp_extract("body", r"<isbn>([^\n]*?)</isbn>", 1).alias("isbn"))
