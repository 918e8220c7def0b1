"""WARC archives: a writer, and a sequential reader.

An archive is a row of gzip members, one for each record. Records of equal payloads are
written once as a response; the others are revisits that refer to it. The reader goes through a file from
its start in small blocks: each member is decompressed as it is read, its record is framed by the Content-Length
it states, and the payload is hashed on the way and compared with the digest it states.

Archives lie on a file system that all executors share and that pyarrow can open. A task writes files
with names of its own; only the files of tasks that ended well are in the manifest, so a
lost or repeated task leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch

ARCHIVE_BYTES = 256 << 20
BLOCK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
RECORD = "urn:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = ("archive string, page_id long, url string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long")


def mark_revisits(pages: DataFrame, scratch: Scratch, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to, null for responses.

    Of equal payloads of at least least_bytes the row with the largest page_id is the response;
    repeated rows of that page_id are responses too. Rows without page_id refer to it if there is one.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    repeated = scratch.save(
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1 and original is not null").drop("n"),
        "repeated")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return (rows.join(repeated, "digest", "left")
            .select("page_id", "url", "payload", refers.alias("refers_to")))


def write_archives(records: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Write records (page_id, url, payload, refers_to) below folder; returns the manifest:
    archive, records, bytes."""
    manifest = records.mapInArrow(lambda batches: _write(batches, folder),
                                  "archive string, records long, bytes long")
    return scratch.save(manifest, "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives, verified; a damaged archive is an error that names it."""
    count = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (manifest.select("archive").repartition(count, "archive")
            .mapInArrow(_read, READ))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) into archives and read them back.

    A null html is an empty payload, a null url gives a record without target. Repeated rows
    have a record each. Other columns are ignored; an empty table has no archives.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    records = mark_revisits(pages, scratch, least_bytes)
    return read_archives(write_archives(records, f"{scratch.root}/archives", scratch))


def digest_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as bytes, not yet compressed."""
    digest = digest_text(hashlib.sha1(payload).digest())
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD}{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        # A header is one line: control characters and % itself are escaped.
        safe = "".join(c if c > " " and c != "%" and c.isprintable()
                       else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass"))
                       for c in url)
        header.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        header += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    header += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    out = path = None
    records = size = 0

    def closed() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pydict(
            {"archive": [path], "records": [records], "bytes": [size]})

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
        for row in zip(*columns, strict=True):
            if out is None:
                path, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                system, place = fs.FileSystem.from_uri(path)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(place, compression=None)
            press = zlib.compressobj(6, wbits=31)
            member = press.compress(record(*[value.as_py() for value in row])) + press.flush()
            out.write(member)
            records += 1
            size += len(member)
            if size >= ARCHIVE_BYTES:
                yield closed()
                out = None
    if out is not None:
        yield closed()


class Member:
    """One gzip member, decompressed as it is read."""

    def __init__(self, stream, rest: bytes) -> None:
        self.stream, self.rest = stream, rest
        self.press = zlib.decompressobj(wbits=31)
        self.plain = b""

    def more(self) -> bool:
        """Some further bytes of the record; False at the member's end."""
        before = len(self.plain)
        while not self.press.eof:
            if not self.rest:
                self.rest = self.stream.read(BLOCK)
                if not self.rest:
                    raise ValueError("the archive ends inside a record")
            self.plain += self.press.decompress(self.rest, BLOCK)
            self.rest = self.press.unused_data if self.press.eof else self.press.unconsumed_tail
            if len(self.plain) > before:
                return True
        return False

    def header(self) -> list[str]:
        """Lines up to the next empty line."""
        while (end := self.plain.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("a header without an end")
        head, self.plain = self.plain[:end], self.plain[end + 4:]
        return head.decode("utf-8", "replace").split("\r\n")

    def take(self, count: int) -> Iterator[bytes]:
        """The next count bytes, block by block."""
        while count:
            if not self.plain and not self.more():
                raise ValueError("a record shorter than its Content-Length")
            part, self.plain = self.plain[:count], self.plain[count:]
            count -= len(part)
            yield part

    def finish(self) -> bytes:
        """Check that only the record's two line ends are left; what follows the member."""
        while len(self.plain) <= 4 and self.more():
            pass
        if self.plain != b"\r\n\r\n":
            raise ValueError("a record longer than its Content-Length")
        return self.rest


def _fields(lines: list[str]) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(text: str | None) -> int | None:
    number = (text or "").strip("<>").removeprefix(RECORD)
    return int(number) if number else None


def read_records(stream) -> Iterator[dict]:
    """Records of one archive, in order; ValueError where it is damaged."""
    rest = stream.read(BLOCK)
    while rest:
        member = Member(stream, rest)
        lines = member.header()
        if not lines[0].startswith("WARC/1."):
            raise ValueError("not a WARC record")
        fields = _fields(lines)
        length = int(fields["content-length"])
        http = member.header()
        head = len("\r\n".join(http).encode()) + 4
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        size = int(_fields(http)["content-length"])
        if fields["warc-type"] == "response":
            digest, size_read = hashlib.sha1(), 0
            for part in member.take(length - head):
                digest.update(part)
                size_read += len(part)
            if size_read != size or digest_text(digest.digest()) != stated:
                raise ValueError(f"{fields['warc-record-id']}: the payload is not the one stated")
        elif length != head:
            raise ValueError(f"{fields['warc-record-id']}: a revisit with a payload")
        rest = member.finish() or stream.read(BLOCK)
        yield {
            "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": stated,
            "refers_to": _page(fields.get("warc-refers-to")),
        }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("archive", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64())])
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            system, place = fs.FileSystem.from_uri(path)
            with system.open_input_stream(place, compression=None) as stream:
                rows = []
                try:
                    for row in read_records(stream):
                        rows.append({"archive": path, **row})
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(f"{path}: {error}") from error
                yield pa.RecordBatch.from_pylist(rows, schema)
