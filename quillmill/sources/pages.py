"""Already fetched pages of cursor-paged searches, as a stream that goes on where it stopped.

    spark.dataSource.register(PagedSearch)
    spark.readStream.format("paged_search").load(folder)        # query, cursor, identifier, isbns

A page lies in folder/query/cursor.json, the first of a query in start.json; it is an object with items (identifier, and
isbn as a text or a list) and the cursor of the page after it, or none at the end. The offset of the stream is the cursor
that each query is to go on with, so that Spark's checkpoint says which page comes next; a page that has not been fetched
yet ends the batch there, and the next batch looks again. Each page is one partition. A cursor that leads back to a page
read before is an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quillmill.sources.text_tree import store_of

FIRST, DONE = "start", ""


@dataclass
class Page(InputPartition):
    query: str
    cursor: str


class PageReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.after: dict[tuple[str, str], str] = {}

    def _load(self, query: str, cursor: str) -> dict | None:
        store, root = store_of(self.root)
        path = f"{root}/{query}/{cursor}.json"
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path, compression=None) as f:
            return json.loads(f.read())

    def _next(self, query: str, cursor: str) -> str | None:
        """The cursor after a page; null if the page is not there yet."""
        if (query, cursor) not in self.after:
            page = self._load(query, cursor)
            if page is None:
                return None
            self.after[query, cursor] = page.get("cursor") or DONE
        return self.after[query, cursor]

    def _walk(self, query: str, cursor: str, stop: str | None = None) -> Iterator[tuple[str, str]]:
        """Pages from a cursor on, each with the cursor after it, to a stop or as far as there are any."""
        seen = set()
        while cursor not in (DONE, stop) and (after := self._next(query, cursor)) is not None:
            if cursor in seen:
                raise ValueError(f"{query}: cursor {cursor} leads back to itself")
            seen.add(cursor)
            yield cursor, after
            cursor = after

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, root = store_of(self.root)
        queries = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.type == fs.FileType.Directory)
        out = {}
        for q in queries:
            out[q] = FIRST
            for _, after in self._walk(q, FIRST):
                out[q] = after
        return out

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(q, cursor) for q, stop in sorted(end.items()) for cursor, _ in self._walk(q, start.get(q, FIRST), stop)]

    def read(self, part: Page) -> Iterator[tuple[str, str, str, str]]:
        for item in self._load(part.query, part.cursor).get("items", []):
            codes = item.get("isbn") or []
            yield part.query, part.cursor, item.get("identifier"), codes if isinstance(codes, str) else "; ".join(codes)


class PagedSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "query string, cursor string, identifier string, isbns string"

    def streamReader(self, schema) -> PageReader:
        return PageReader(self.options)
