"""Operator 3, WARC archives and a reader that salvages damaged ones.

Writing: every page is one record, each record its own gzip member. Tasks fill archives up to a
size and put them into the shared checkpoint folder under names of their own; the list of archives
that finished tasks report is what counts, so a repeated task leaves at most an unread file.

Reading: the reader walks member by member (or version line by version line in an archive that is
not compressed) and checks the compressed stream, the record's lengths and its block and payload
digests (md5 and sha, hex or base32; others, and payload digests of revisits, segments and truncated
records, are not checked). After a
failed check it searches for the next member or version line that begins a valid record, goes on
from there and logs the bytes in between as a quarantined gap. An archive is read through a window of
``WINDOW_BYTES`` and may be of any size; a task holds one member, unpacked, at a time.

Equal payloads of ``REVISIT_BYTES`` or more are stored once: the record of the smallest page id is
a response, the others are revisits of it. Only a page id and digest per group of copies is
gathered; Spark sees its size when it chooses the join.

Nulls, ties and odd input: a null page counts as empty; a missing url leaves its header out; rows
that repeat the smallest id and its payload are responses alike; a page without id is a revisit if
its payload has an id elsewhere, else a response; payloads may be empty or very long; an empty
table gives no archive and no rows; other columns are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, stage, staging_path, table

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8_000_000
WINDOW_BYTES = 1 << 20
RECORD_DATE = "2000-01-01T00:00:00Z"  # records carry no clock, so that reruns agree
# Fixed values of the WARC and gzip formats.
VERSION, MAGIC, END = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n"
_MARK = re.compile(re.escape(MAGIC) + b"|" + re.escape(VERSION))
_HEAD_END, _CHUNKED, _CHUNK = re.compile(rb"\r?\n\r?\n"), re.compile(rb"\ntransfer-encoding:[^\n]*chunked"), re.compile(rb"([0-9A-Fa-f]+)[^\n]*\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _header_value(text: str) -> str:
    """Line ends and other control characters would end the header; they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or a revisit that refers to another page's record."""
    block = _HTTP.format(len(payload)).encode() + (b"" if refers_to is not None else payload)
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
              "WARC-Date": RECORD_DATE, "WARC-Target-URI": None if url is None else _header_value(url), "X-Page-Id": page_id,
              "X-Payload-Length": len(payload), "WARC-Payload-Digest": f"sha256:{digest}",
              "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "X-Refers-To-Page": refers_to,
              "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
              "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class ArchiveWindow:
    """An archive of any size as far as the reader needs bytes: slices, ``find``, ``startswith``, ``len``."""

    def __init__(self, file: pa.NativeFile, window: int = WINDOW_BYTES) -> None:
        self.file, self.window, self.size, self.begin, self.held = file, window, file.size(), 0, b""

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        start, stop = part.start, min(part.stop, self.size)
        if stop <= start:
            return b""
        if stop - start > self.window:
            return self.file.read_at(stop - start, start)
        if not self.begin <= start <= stop <= self.begin + len(self.held):
            self.begin, self.held = start, self.file.read_at(self.window, start)
        return self.held[start - self.begin:stop - self.begin]

    def startswith(self, mark: bytes, start: int) -> bool:
        return self[start:start + len(mark)] == mark

    def find(self, mark: bytes, start: int) -> int:
        return self.search(re.compile(re.escape(mark)), start, len(mark))

    def search(self, pattern: re.Pattern[bytes], start: int, longest: int) -> int:
        """Where the first match of at most ``longest`` bytes begins, or -1."""
        while start < self.size:
            held = self.begin + len(self.held)
            stop = held if self.begin <= start <= held - longest else start + self.window
            found = pattern.search(self[start:stop])
            if found:
                return start + found.start()
            start = stop if stop >= self.size else stop - longest + 1
        return -1


def _unpack(data: ArchiveWindow, start: int) -> tuple[bytes, int]:
    """The gzip member at ``start`` and where it ends; ValueError if it is damaged or cut off."""
    unpacker, parts, at = zlib.decompressobj(31), [], start
    while not unpacker.eof:
        piece = data[at:at + 65536]
        if not piece:
            raise ValueError("gzip member is cut off")
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error as error:
            raise ValueError("gzip member is damaged") from error
        at += len(piece)
    return b"".join(parts), at - len(unpacker.unused_data)


def _agrees(label: str | None, data: bytes) -> bool:
    """Whether the digest is that of ``data``, in hex or base32; true for algorithms and encodings not known here."""
    name, _, value = (label or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    digest, value = hashlib.new(name, data, usedforsecurity=False).digest(), value.strip().rstrip("=").lower()
    same = {len(text): text for text in (digest.hex(), base64.b32encode(digest).decode().rstrip("=").lower())}
    return same.get(len(value), value) == value


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP header of an HTTP record's block, and the whole block of others."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    head_end = _HEAD_END.search(block)
    return block[head_end.end():] if head_end else b""


def _payloads(fields: dict[str, str], block: bytes) -> list[bytes]:
    """The payloads that the payload digest may be of: a chunked body counts as sent or put together."""
    payload = _payload(fields, block)
    both = [payload]
    head = block[:len(block) - len(payload)].lower()
    if _CHUNKED.search(head):
        whole, at = [], 0
        while (size := _CHUNK.match(payload, at)) and int(size[1], 16):
            whole.append(payload[size.end():size.end() + int(size[1], 16)])
            at = size.end() + int(size[1], 16) + 2
        both.append(b"".join(whole))
    return both


def _parse(data: bytes | ArchiveWindow, start: int) -> tuple[dict[str, str], bytes, int]:
    """The record at ``start``: its fields, block and end; ValueError where a check fails."""
    head_end = data.find(END, start)
    if not data.startswith(VERSION, start) or head_end < 0:
        raise ValueError("no version line or header")
    try:
        lines = data[start:head_end].decode().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        length = int(fields["content-length"])
    except (ValueError, KeyError) as error:
        raise ValueError("header is damaged") from error
    block_start = head_end + len(END)
    end = block_start + length
    if length < 0 or data[end:end + len(END)] != END:
        raise ValueError("record is cut off")
    block = data[block_start:end]
    if not _agrees(fields.get("warc-block-digest"), block):
        raise ValueError("block digest differs")
    own = fields.get("warc-type") != "revisit" and not {"warc-segment-number", "warc-truncated"} & fields.keys()
    if own and not any(_agrees(fields.get("warc-payload-digest"), payload) for payload in _payloads(fields, block)):
        raise ValueError("payload digest differs")
    return fields, block, end + len(END)


def salvage(archive: bytes | pa.NativeFile, window: int = WINDOW_BYTES):
    """Yields ``("record", offset, end, fields, block)`` and ``("gap", offset, end, reason)`` in order.

    ``archive`` is an open file, or its bytes. A member that unpacks but holds damaged records gives those records' neighbours and one gap of
    the member's own range.
    """
    content = ArchiveWindow(pa.BufferReader(archive) if isinstance(archive, bytes) else archive, window)

    def valid(at: int):
        if content.startswith(MAGIC, at):
            data, end = _unpack(content, at)
            found, inner, reason = [], 0, None
            while inner < len(data):
                try:
                    fields, block, inner = _parse(data, inner)
                    found.append((fields, block))
                except ValueError as error:
                    reason = str(error)
                    inner = data.find(VERSION, inner + 1)
                    if inner < 0:
                        break
            if not found:
                raise ValueError(reason or "member is empty")
            return found, end, reason
        fields, block, end = _parse(content, at)
        return [(fields, block)], end, None

    at, lost, why = 0, None, ""
    while at < len(content):
        try:
            found, end, reason = valid(at)
        except ValueError as error:
            if lost is None:
                lost, why = at, str(error)
            mark = content.search(_MARK, at + 1, len(VERSION))
            at = len(content) if mark < 0 else mark
            continue
        if lost is not None:
            yield "gap", lost, at, why
            lost = None
        for fields, block in found:
            yield "record", at, end, fields, block
        if reason:
            yield "gap", at, end, reason
        at = end
    if lost is not None:
        yield "gap", lost, len(content), why


def _filesystem(uri: str):
    """The file system of a folder and the folder's path in it, from any executor."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:/*)?(/.*|[^:]*)", uri) or re.fullmatch(r"file:/+(.*)", uri)
    if local:
        return fs.LocalFileSystem(), "/" + local[1].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _tasks_reach(folder: str) -> bool:
    """Whether tasks can open files of the folder themselves; some stores are known to Spark alone."""
    try:
        return _filesystem(folder) is not None
    except (ValueError, NotImplementedError, OSError):  # no such kind of store, or no client for it
        return False


def _writer(folder: str):
    def write(batches):
        store, path = _filesystem(folder)
        task, number, parts, size = uuid.uuid4().hex, 0, [], 0

        def close():
            name = f"{task}-{number:05d}.warc.gz"
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(b"".join(parts))
            return pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([len(parts)], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                page_id, url, html, digest, refers_to = (v.as_py() for v in row)
                parts.append(member(record(page_id, url, (html or "").encode(), digest, refers_to)))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield close()

    return write


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """Writes the archives; returns their folder and the list ``(name, records, bytes)`` that counts."""
    spark = pages.sparkSession
    payload = F.coalesce(column(html_col), F.lit(""))
    rows = pages.select(column(id_col).alias("page_id"), column(url_col).alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    copies = (rows.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    rows = rows.join(stage(copies, "copies"), "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first").cast("string")).alias("refers_to"))
    folder = staging_path(spark, "warc")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    return folder, stage(in_arrow(rows, _writer(folder), "name string, records long, bytes long"), "archives")


_TYPES = {"offset": T.LongType(), "end": T.LongType(), "payload_bytes": T.LongType(), "payload": T.BinaryType()}
_READ = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in (
    "archive", "offset", "end", "kind", "reason", "page_id", "url", "record_type", "payload_bytes", "payload_digest",
    "refers_to", "payload")])


def _reader(payloads: bool):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_READ)

    def rows(archive: str, file: pa.NativeFile):
        for kind, start, end, *rest in salvage(file):
            if kind == "gap":
                yield {"archive": archive, "offset": start, "end": end, "kind": kind, "reason": rest[0]}
                continue
            fields, block = rest
            payload = _payload(fields, block)
            full = fields.get("warc-type") != "revisit"
            digest = hashlib.sha256(payload).hexdigest() if full else fields.get("warc-payload-digest", "").removeprefix("sha256:")
            length = len(payload) if full else int(fields.get("x-payload-length", 0))
            yield {"archive": archive, "offset": start, "end": end, "kind": kind, "page_id": fields.get("x-page-id"),
                   "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"), "payload_bytes": length,
                   "payload_digest": digest, "refers_to": fields.get("x-refers-to-page"), "payload": payload if payloads else None}

    def opened(uri: str) -> pa.NativeFile:
        store, path = _filesystem(uri)
        return store.open_input_file(path)

    def read(batches):
        for batch in batches:
            for at, uri in enumerate(batch.column("path").to_pylist()):
                held, size = [], 0
                with opened(uri) if "content" not in batch.schema.names else pa.BufferReader(batch.column("content")[at].as_buffer()) as file:
                    for row in rows(uri.rsplit("/", 1)[-1], file):
                        held.append(row)
                        size += 200 + len(row.get("payload") or b"")
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return read


def read_warc(spark: SparkSession, folder: str, archives: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """Rows of the archives in a folder: ``kind`` is ``record`` or ``gap`` (with ``offset``, ``end``, ``reason``).

    ``archives(name)`` restricts the reading to the archives it lists. Spark lists the files and deals them
    out by size; the tasks read them through a window. In a store that only Spark can read, it hands each
    archive over whole; there one archive may have at most 2 GB.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    files = files.select("path") if _tasks_reach(folder) else files.select("path", "content")
    if archives is not None:
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(archives.select("name"), "name", "left_semi")
    return in_arrow(files.drop("name"), _reader(payloads), _READ)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, archives = write_warc(pages)
    kind = pages.schema["page_id"].dataType
    return read_warc(spark, folder, archives, payloads=False).where("kind = 'record'").select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
     f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
