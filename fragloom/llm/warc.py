"""WARC archives of pages: written with duplicates as revisits, read back by a salvage reader.

Writing: of pages with equal payloads the one with the smallest page_id is a response
that holds the payload, the others are revisits that name it. Every task writes archives of
its own, a compressed member for each record, under a name with its attempt; only files
named in the manifest, which finished tasks return, count, so lost executors leave nothing
half-written behind that is read. Archives roll over at `ARCHIVE_BYTES`.

Reading: a record counts if its member decompresses, its length is as stated and its
digests agree. After a failed check the reader searches byte by byte for the next
member, or version line of an uncompressed archive, that passes all checks, goes on
there, and logs the bytes between as a quarantined gap. It holds one record at a time.

A null html is an empty payload, a null url is left out. Pages of one id and payload are all
responses or all revisits. A null page_id never is the smallest; equal payloads without any
id are all responses. No pages give no archives. Other columns play no part.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, open_folder, qualified, stored, table, tasks, utf8
from fragloom.session import scratch_path

# Parts that the pages of one payload are split into.
SALTS = 64

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 256 << 20
COMPRESSION = 4

_CHUNK = 1 << 18
# Read at a time while a header has not ended.
_HEADER_BYTES = 1 << 16
_URN = "urn:page:"

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
_VERSION_LINE = b"WARC/1."
_NEXT = b"\r\n" + _VERSION_LINE
_MEMBER = b"\x1f\x8b\x08"
_BREAK = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(data: bytes) -> str:
    """SHA-1 in upper-case base32, as archives state it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: object) -> str:
    return f"<{_URN}{'' if page_id is None else quote(str(page_id), safe='')}>"


def _page(urn: str) -> str | None:
    """The page_id as text; None if there is none."""
    return unquote(urn.strip("<> ").removeprefix(_URN)) or None


def build_record(page_id: object, url: str | None, payload: bytes, refers_to: object, revisit: bool) -> bytes:
    """One record. A revisit's block is the HTTP header alone, which tells the payload's length."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}"]
    lines.append(f"WARC-Date: {datetime.datetime.now(datetime.UTC):%Y-%m-%dT%H:%M:%SZ}")
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + _BREAK + block + _BREAK


@dataclass(frozen=True)
class Record:
    """A record that passed all checks, and the bytes of the archive that it takes."""

    start: int
    end: int
    headers: dict[str, str]
    payload: bytes
    http: dict[str, str] = field(default_factory=dict)

    @property
    def payload_bytes(self) -> int:
        return int(self.http.get("content-length", len(self.payload)))

    @property
    def payload_digest(self) -> str:
        return self.headers.get("warc-payload-digest", "").removeprefix("sha1:")


@dataclass(frozen=True)
class Gap:
    """Bytes that hold no record that passes the checks."""

    start: int
    end: int
    reason: str


class Damaged(Exception):
    """What stands here is not a whole, right record."""


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _checked(head: bytes, block: bytes, start: int, end: int) -> Record:
    if not head.startswith(_VERSION_LINE):
        raise Damaged("no version line")
    headers = _headers(head.partition(b"\r\n")[2])
    if not {"warc-type", "warc-record-id", "warc-date"} <= headers.keys():
        raise Damaged("a required header is missing")
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != digest_of(block):
        raise Damaged("block digest differs")
    http, _, payload = block.partition(_BREAK) if "http" in headers.get("content-type", "") else (b"", b"", block)
    stated = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and stated.startswith("sha1:") and stated[5:] != digest_of(payload):
        raise Damaged("payload digest differs")
    return Record(start, end, headers, payload, _headers(http.partition(b"\r\n")[2]))


class SalvageReader:
    """Records and gaps of one archive, in order. `file` can seek; `size` is its length."""

    def __init__(self, file, size: int, compressed: bool):
        self.file, self.size = file, size
        self.read_at = self._member if compressed else self._plain
        self.mark = _MEMBER if compressed else _VERSION_LINE

    def _at(self, position: int, length: int) -> bytes:
        self.file.seek(position)
        return self.file.read(min(length, self.size - position))

    def __iter__(self) -> Iterator[Record | Gap]:
        position, bad, reason = 0, None, ""
        while position < self.size:
            try:
                record = self.read_at(position)
            except Damaged as damage:
                if bad is None:
                    bad, reason = position, str(damage)
                position = self._next_mark(position + 1)
                continue
            if bad is not None:
                yield Gap(bad, position, reason)
                bad = None
            yield record
            position = record.end
        if bad is not None:
            yield Gap(bad, self.size, reason)

    def _next_mark(self, position: int) -> int:
        """Where the next member or version line may begin, or the end of the archive."""
        while position < self.size:
            chunk = self._at(position, _CHUNK)
            found = chunk.find(self.mark)
            if found >= 0:
                return position + found
            if position + len(chunk) >= self.size:
                break
            position += len(chunk) - len(self.mark) + 1
        return self.size

    def _member(self, start: int) -> Record:
        inflate, parts, position = zlib.decompressobj(31), [], start
        while not inflate.eof:
            chunk = self._at(position, _CHUNK)
            if not chunk:
                raise Damaged("member is cut short")
            try:
                parts.append(inflate.decompress(chunk))
            except zlib.error as error:
                raise Damaged(f"member: {error}") from None
            if not parts[0][: len(_VERSION_LINE)] == _VERSION_LINE[: len(parts[0])]:
                raise Damaged("no version line")
            position += len(chunk)
        data = b"".join(parts)
        head, _, rest = data.partition(_BREAK)
        length = _headers(head).get("content-length", "")
        if not length.isdigit() or len(rest) != int(length) + len(_BREAK) or not rest.endswith(_BREAK):
            raise Damaged("length differs")
        return _checked(head, rest[: int(length)], start, position - len(inflate.unused_data))

    def _head(self, start: int) -> bytes:
        """A header of any length: up to its blank line, which comes before a next version line."""
        head = bytearray()
        while chunk := self._at(start + len(head), _HEADER_BYTES):
            seen = max(0, len(head) - len(_NEXT) + 1)
            head += chunk
            end, version = head.find(_BREAK, seen), head.find(_NEXT, seen)
            if end >= 0 and (version < 0 or end < version):
                return bytes(head[:end])
            if version >= 0:
                break
        raise Damaged("no header, or longer than the archive")

    def _plain(self, start: int) -> Record:
        head = self._head(start)
        length = _headers(head).get("content-length", "")
        block_at = start + len(head) + len(_BREAK)
        if not length.isdigit() or block_at + int(length) + len(_BREAK) > self.size:
            raise Damaged("no header, or longer than the archive")
        rest = self._at(block_at, int(length) + len(_BREAK))
        if not rest.endswith(_BREAK):
            raise Damaged("length differs")
        return _checked(head, rest[: int(length)], start, block_at + len(rest))


_MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, payload) with `refers_to` and whether they are a `revisit`.

    The digests that several pages have are few beside the pages: those
    of a payload that a third of all pages share are one row. A page's own digest is computed
    where the page lies and joined with them; a digest of many pages is split by a salt of
    `SALTS` values, with which the rows that it is joined to are multiplied.
    """
    rows = pages.select("page_id", "url", utf8("html").alias("payload"))
    digest = F.unhex(F.sha1("payload")).alias("digest")
    eligible = F.octet_length("payload") >= min_bytes
    # Counted before anything is shuffled, so that a common payload is one row a task.
    firsts = (
        rows.where(eligible).select("page_id", digest).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    firsts = firsts.select("digest", "first", salts)
    # A page that no other can be alike to has a key of its own, so that null is no hot key.
    own = F.unhex(F.sha1(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(" small"))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt")
    keyed = rows.select("*", F.when(eligible, digest).otherwise(own).alias("digest"), salt)
    joined = keyed.join(firsts, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page; returns the manifest (path, records, bytes) of finished tasks."""
    folder = qualified(pages.sparkSession, folder)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archives() -> Iterator[tuple[str, int, int]]:
            system, path = open_folder(folder)
            task = TaskContext.get()
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
            file, at, records, size, number = None, "", 0, 0, 0
            for page_id, url, payload, refers_to, revisit in batch_rows(batches):
                if file is None:
                    at = f"{path}/{name}-{number:04d}.warc.gz"
                    file = system.open_output_stream(at, compression=None)
                squeeze = zlib.compressobj(COMPRESSION, zlib.DEFLATED, 31)
                member = squeeze.compress(build_record(page_id, url, payload, refers_to, revisit)) + squeeze.flush()
                file.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    file.close()
                    yield at, records, size
                    file, records, size, number = None, 0, 0, number + 1
            if file is not None:
                file.close()
                yield at, records, size

        yield from arrow_batches(archives(), _MANIFEST)

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    return stored(with_revisits(pages).mapInArrow(write, _MANIFEST), "archive-manifest")


READ = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("gap", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record and for each quarantined gap, whose `gap` tells what failed.

    page_id and refers_to come as text; a revisit's length and digest are those of the payload it
    refers to.
    """
    folder = qualified(manifest.sparkSession, folder)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            system, _ = open_folder(folder)
            for (path,) in batch_rows(batches):
                with system.open_input_file(path) as file:
                    for found in SalvageReader(file, file.size(), path.endswith(".gz")):
                        if isinstance(found, Gap):
                            yield path, found.start, found.end, found.reason, *[None] * 6
                            continue
                        kind = found.headers.get("warc-type")
                        refers_to = found.headers.get("warc-refers-to")
                        yield (
                            path, found.start, found.end, None,
                            _page(found.headers.get("warc-record-id", "")), kind, refers_to and _page(refers_to),
                            found.payload_bytes, found.payload_digest, found.payload if with_payload else None,
                        )

        yield from arrow_batches(rows(), READ)

    # One file after another in a task; no file is worth more than a task.
    return manifest.select("path").repartition(tasks(manifest)).mapInArrow(read, READ)


def records_of(read: DataFrame) -> DataFrame:
    return read.where("gap IS NULL").drop("gap")


def gaps_of(read: DataFrame) -> DataFrame:
    """The quarantine log: path, start, end and reason of every gap."""
    return read.where("gap IS NOT NULL").select("path", "start", "end", F.col("gap").alias("reason"))


def op9_salvaged_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "archives")
    records = records_of(read_archives(write_archives(pages, folder), folder, with_payload=False))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
