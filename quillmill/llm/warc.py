"""Operator 12: WARC archives, written, normalised from monolithic gzip to a member for each record, and read back.

- write_archives: each task writes its pages as whole-file gzip streams, of at most archive_bytes of records each. Of pages
  with equal payloads that with the least id is a response, the others are revisits that carry the response's record id and,
  in the HTTP headers that are their block, the payload's length.
- normalise: inflates a whole-file stream once, in pieces, copies each record into a gzip member of its own, and writes a
  sidecar index beside the new archive: a JSON line with offset, length, type, id, URI, digest and reference of each record.
  It takes archives of any make: one member, several, or one for each record already. Memory does not grow with archive or record.
- read_archives: ranges of whole members, found by the sidecars, are dealt out to tasks, however large one archive is.

Files are named by the attempt that writes them, and only those that a committed table lists count; what lost or repeated
attempts have left is deleted after. Archives are reached by the URI of any store that Arrow knows.

Edge cases: a null payload is an empty one, and empty payloads are equal like others. A row that repeats another's id and
payload is written again as what the first was. A null id is never the least; among null ids alone all are responses.
A null URI gives no header; blanks and control characters in one are percent-encoded. Further columns are ignored, whatever
their names. An empty table gives no archives and no rows. Payloads have no limit but that of a row.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import join_hubs
from quillmill.llm.store import delete, delete_at_end, delete_path, listed, make_folder, shared_dir, tidy, written

#: Bytes of records in one archive, and of compressed members that one task reads at a time.
ARCHIVE_BYTES, RANGE_BYTES = 64 << 20, 8 << 20
PIECE = 1 << 18
#: Compression of the first stream, which is read once, and of the members that stay.
DRAFT_LEVEL, LEVEL = 1, 4
#: Groups of equal payloads (under 100 bytes each) that are broadcast; more are joined by shuffle, their hubs apart.
BROADCAST_GROUPS = 1 << 16
# Names and words of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary's SHA-1; ten hexadecimal digits are eight of base32."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def opened(uri: str, mode: str = "rb") -> BinaryIO:
    """A file of the local disk or of any store that Arrow knows, to read at any place or to write once."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name) if mode == "rb" else store.open_output_stream(name, compression=None)


def record_id(key: str) -> str:
    return f"<urn:page:{key}>"


def record(kind: str, key: str, uri: str | None, digest: str, payload: bytes, size: int, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", uri))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    block = http + (payload if kind == "response" else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def headers(head: bytes) -> dict[str, str]:
    """Names in lower case and values of a header block; the first line is not one of them."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


_ARCHIVES = "archive string, records long, raw_bytes long, bytes long"


def _archive_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("archive", pa.string()), ("records", pa.int64()), ("raw_bytes", pa.int64()), ("bytes", pa.int64()))
    return _batch({name: ([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def _writer(folder: str, archive_bytes: int, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, zipped, rows = None, None, []
        for batch in batches:
            for key, uri, html, digest, refers in zip(*(batch.column(c) for c in ("key", "uri", "html", "digest", "refers_to")), strict=True):
                refers, payload = refers.as_py(), html.as_py()
                data = record("response" if refers is None else "revisit", key.as_py(), uri.as_py(), digest.as_py(), payload, len(payload), refers)
                if out is not None and rows[-1][2] + len(data) > archive_bytes:
                    _finish(out, zipped, rows)
                    out = None
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, zipped = opened(name, "wb"), zlib.compressobj(level, wbits=31)
                    rows.append([name, 0, 0, 0])
                done = zipped.compress(data)
                out.write(done)
                rows[-1][1:] = rows[-1][1] + 1, rows[-1][2] + len(data), rows[-1][3] + len(done)
        if out is not None:
            _finish(out, zipped, rows)
            yield _archive_batch(rows)

    return write


def _finish(out: BinaryIO, zipped, rows: list[list]) -> None:
    rest = zipped.flush()
    out.write(rest)
    out.close()
    rows[-1][3] += len(rest)


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The pieces of a gzip file of one or more members, inflated once from start to end."""
    stream, fresh = zlib.decompressobj(31), True
    while data := source.read(PIECE):
        while data:
            piece = stream.decompress(data, 4 * PIECE)
            fresh = False
            if piece:
                yield piece
            if stream.eof:
                data, stream, fresh = stream.unused_data.lstrip(b"\0"), zlib.decompressobj(31), True
            else:
                data = stream.unconsumed_tail
    while not fresh and (piece := stream.decompress(b"", 4 * PIECE)):
        yield piece
    if not fresh and not stream.eof:
        raise ValueError("the gzip stream ends too early")


class Pieces:
    """Bytes that arrive in pieces: taken up to a mark or by number, a piece at a time."""

    def __init__(self, source: Iterator[bytes]):
        self.source, self.have = source, b""

    def more(self) -> bool:
        piece = next(self.source, b"")
        self.have += piece
        return bool(piece)

    def until(self, mark: bytes) -> bytes | None:
        """All up to and with the mark; null at the end. Blank lines before it are skipped."""
        while True:
            self.have = self.have.lstrip(b"\r\n") if self.have[:1] in b"\r\n" else self.have
            at = self.have.find(mark) if self.have else -1
            if at >= 0:
                out, self.have = self.have[: at + len(mark)], self.have[at + len(mark) :]
                return out
            if not self.more():
                if self.have:
                    raise ValueError("the archive ends within a record's header")
                return None

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.have and not self.more():
                raise ValueError("the archive ends within a record")
            out, self.have = self.have[:n], self.have[n:]
            n -= len(out)
            yield out


def rewrite(source: BinaryIO, out: BinaryIO, level: int = LEVEL) -> Iterator[dict]:
    """Copy an archive with each record as a gzip member; yields the index entry of each."""
    pieces, offset = Pieces(inflated(source)), 0
    while (head := pieces.until(END)) is not None:
        fields, member, length = headers(head[: -len(END)]), zlib.compressobj(level, wbits=31), 0
        for piece in _whole(head, pieces, int(fields["content-length"])):
            done = member.compress(piece)
            out.write(done)
            length += len(done)
        done = member.flush()
        out.write(done)
        length += len(done)
        yield {"offset": offset, "length": length, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest"), "refers_to": fields.get("warc-refers-to")}
        offset += length


def _whole(head: bytes, pieces: Pieces, size: int) -> Iterator[bytes]:
    yield head
    yield from pieces.take(size)
    yield END


def _normaliser(folder: str, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, raw_bytes in zip(batch.column("archive").to_pylist(), batch.column("raw_bytes").to_pylist(), strict=True):
                name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                with opened(source) as raw, opened(name, "wb") as out, opened(name + ".idx", "wb") as index:
                    for entry in rewrite(raw, out, level):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n, size = n + 1, entry["offset"] + entry["length"]
                yield _archive_batch([(name, n, raw_bytes, size)])

    return run


def spread(archives: DataFrame) -> DataFrame:
    """A task for each few archives: the table itself is a small file or two."""
    with tidy(archives.sparkSession):
        n = archives.count()
    return archives.repartition(max(1, min(n, 1 << 15)))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", text_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, level: int = DRAFT_LEVEL) -> DataFrame:
    """Archives (archive, records, raw_bytes, bytes) in a folder, each one gzip stream. Payloads under min_bytes are never revisits."""
    spark = pages.sparkSession
    html = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").cast("string").alias("uri"), html.alias("html"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("html")), "size": F.octet_length("html")})
    groups = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups, "equal_payloads")  # payloads that are alone need no reference
    with tidy(spark):
        several, total = groups.agg(F.count("*").alias("c"), F.sum("n").alias("s")).first()
    if several <= BROADCAST_GROUPS:
        rows = rows.join(F.broadcast(groups.drop("n")), "digest", "left")
    else:
        rows = join_hubs(rows, groups, "digest", total or 0, how="left")
    refers = F.when((F.col("size") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("least")), F.col("least").cast("string"))
    rows = rows.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), "uri", "html", "digest", refers.alias("refers_to"))
    make_folder(spark, folder)
    return _committed(rows.mapInArrow(_writer(folder, archive_bytes, level), _ARCHIVES), folder, "archives", groups)


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Archives like the given ones, with a member for each record, and an index beside each (its name with .idx)."""
    make_folder(archives.sparkSession, folder)
    return _committed(spread(archives).mapInArrow(_normaliser(folder, level), _ARCHIVES), folder, "normalised")


def _committed(made: DataFrame, folder: str, name: str, *done: DataFrame) -> DataFrame:
    """The written table of what tasks have made; files of the folder that it does not list are deleted."""
    table, spark = written(made, name, *done), made.sparkSession
    with tidy(spark):
        good = {r.archive.rpartition("/")[2] for r in table.select("archive").toLocalIterator()}  # a name for each 64 MB
    for file in listed(spark, folder):
        if file.removesuffix(".idx") not in good and not file.startswith("."):
            delete_path(spark, f"{folder}/{file}")
    return table


_RECORDS = "record_id string, uri string, record_type string, payload_bytes long, payload_digest string, refers_to string"


def _ranges(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, begin, end = [], 0, 0
                with opened(name + ".idx") as index:
                    for line in _lines(index):
                        entry = json.loads(line)
                        if end > begin and entry["offset"] + entry["length"] - begin > limit:
                            rows.append((name, begin, end))
                            begin = end
                        end = entry["offset"] + entry["length"]
                if end > begin:
                    rows.append((name, begin, end))
                yield _batch({"archive": ([r[0] for r in rows], pa.string()), "begin": ([r[1] for r in rows], pa.int64()), "end": ([r[2] for r in rows], pa.int64())})

    return run


def _lines(source: BinaryIO) -> Iterator[bytes]:
    rest = b""
    while data := source.read(PIECE):
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def parsed(data: bytes) -> tuple[dict[str, str], bytes, dict[str, str], bytes]:
    """Headers, and block, HTTP headers and payload of one record."""
    head, _, rest = data.partition(END)
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(END) if block.startswith(b"HTTP/") else (b"", b"", block)
    return fields, block, headers(http), payload


def read_record(archive: str, offset: int, length: int) -> bytes:
    """One record of a normalised archive, by an entry of its index."""
    with opened(archive) as f:
        f.seek(offset)
        return zlib.decompress(f.read(length), 31)


def _reader(with_payload: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin, end in zip(*(batch.column(c).to_pylist() for c in ("archive", "begin", "end")), strict=True):
                rows = []
                with opened(name) as f:
                    f.seek(begin)
                    data = f.read(end - begin)
                while data:
                    member = zlib.decompressobj(31)
                    fields, _, http, payload = parsed(member.decompress(data))
                    data = member.unused_data
                    digest, refers = fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields.get("warc-refers-to")
                    size = len(payload)
                    if fields["warc-type"] == "revisit":
                        size = int(http["content-length"])
                    elif base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode() != digest:
                        raise ValueError(f"{name}: the payload of {fields['warc-record-id']} has another digest")
                    rows.append((fields["warc-record-id"], fields.get("warc-target-uri"), fields["warc-type"], size, digest, refers, payload))
                columns = {n: ([r[i] for r in rows], pa.int64() if n == "payload_bytes" else pa.string()) for i, n in enumerate(("record_id", "uri", "record_type", "payload_bytes", "payload_digest", "refers_to"))}
                yield _batch(columns | ({"payload": ([r[-1] for r in rows], pa.binary())} if with_payload else {}))

    return read


def read_archives(archives: DataFrame, with_payload: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records (record_id, uri, record_type, payload_bytes, payload_digest, refers_to, and payload if asked for) of normalised archives.

    A response's digest is computed anew and must be that of its header; a revisit's length and digest are its headers'.
    """
    ranges = written(spread(archives).mapInArrow(_ranges(range_bytes), "archive string, begin long, end long"), "ranges")
    return spread(ranges).mapInArrow(_reader(with_payload), _RECORDS + ", payload binary" * with_payload)


def key_of(record: Column) -> Column:
    """The key within a record's id."""
    return F.regexp_extract(record, r"^<urn:page:(.*)>$", 1)


def page_records(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", **options) -> DataFrame:
    """Pages through the archives and back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Without a folder the archives go to the session's shared folder and are deleted once they are read.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    own = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    make_folder(spark, own)
    if not folder:
        delete_at_end(spark, own)
    draft = write_archives(pages, f"{own}/draft", id_col, **options)
    final = normalise(draft, f"{own}/archives")
    delete(draft)
    delete_path(spark, f"{own}/draft")
    key = lambda c: F.nullif(key_of(F.col(c)), F.lit("")).cast(kind)
    out = read_archives(final).select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to"))
    out = written(out, "page_records", final)
    if not folder:
        delete_path(spark, own)
    return out
