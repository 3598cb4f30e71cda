"""Web archives as tables of record chunks."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import importable, slices
from loomwork.operators.bloom import bloom_of
from loomwork.session import scratch_path, stage

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
_SCHEME = "urn:page:"
# A header block beyond this size is an error, not data to hold.
_HEADER_LIMIT = 1 << 20
_READ = 1 << 16
CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20
# Tasks that read archives; a task may read several.
READERS = 20_000

CHUNK_SCHEMA = (
    "archive string, record_id string, record_type string, target_uri string, refers_to string, "
    "stated_digest string, stated_bytes bigint, chunk_no bigint, data binary, bytes_so_far bigint, "
    "digest_so_far string, last boolean"
)
_CHUNK_FIELDS = pa.schema(
    [
        ("archive", pa.string()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("stated_digest", pa.string()),
        ("stated_bytes", pa.int64()),
        ("chunk_no", pa.int64()),
        ("data", pa.binary()),
        ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()),
        ("last", pa.bool_()),
    ]
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file that all executors reach."""
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[len("file:") :]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, sha1, refers_to``: what each record will be.

    Of pages with equal payloads of at least ``least_bytes`` bytes the largest
    ``page_id`` is the response and others refer to it.  Digests combine before
    the shuffle.  A Bloom filter of the repeated ones, of bounded size, tells
    most other rows apart, and these are not moved at all; the rest take part in
    the join, which Spark splits where one payload fills a large share.  A null id never is the one referred
    to while another id exists; rows that repeat the id referred to are
    responses too, and so are all rows of a payload whose ids are all null.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("sha1")
    )
    repeated = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
        .select(F.col("sha1").alias("_sha1"), "_first")
    )
    repeated = stage(repeated, "repeated-digests")
    filter_of = bloom_of(repeated, ["_sha1"], expected=max(1, repeated.count()))
    moved = rows
    if filter_of is not None:
        moved = rows.where(filter_of.may_hold(F.col("sha1")))
    joined = moved.join(repeated, moved["sha1"] == repeated["_sha1"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    found = joined.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))
    if filter_of is None:
        return found
    single = rows.where(~filter_of.may_hold(F.col("sha1")))
    return found.unionByName(single.withColumn("refers_to", F.lit(None).cast(rows.schema["page_id"].dataType)))


class ArchiveWriter:
    """Writes records as gzip members, payloads in pieces, archives of bounded size."""

    def __init__(self, folder: str, date: str, archive_bytes: int = ARCHIVE_BYTES):
        self.files, self.root = _opened(folder)
        self.folder, self.date, self.archive_bytes = folder, date, archive_bytes
        self.files.create_dir(self.root, recursive=True)
        self.out, self.name, self.records, self.size = None, "", 0, 0
        self.closed: list[tuple[str, int, int]] = []

    def write(self, page_id, url, payload: memoryview, sha1: bytes, refers_to) -> None:
        if self.out is None:
            # A retried task writes other names; only those it reports are read.
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
        http = (
            f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        ).encode()
        body = len(http) + (len(payload) if refers_to is None else 0)
        head = [
            "WARC/1.1",
            f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{_SCHEME}{'' if page_id is None else page_id}>",
            f"WARC-Date: {self.date}",
        ]
        if url is not None:
            head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
        head.append(f"WARC-Payload-Digest: sha1:{base32_sha1(sha1)}")
        if refers_to is not None:
            head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_SCHEME}{refers_to}>"]
        head += [f"Content-Type: {RESPONSE_TYPE}", f"Content-Length: {body}", "", ""]
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        self._put(packer.compress("\r\n".join(head).encode() + http))
        if refers_to is None:
            for at in range(0, len(payload), _READ):
                self._put(packer.compress(payload[at : at + _READ]))
        self._put(packer.compress(b"\r\n\r\n"))
        self._put(packer.flush())
        self.records += 1
        if self.size >= self.archive_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.closed.append((f"{self.folder}/{self.name}", self.records, self.size))
            self.out, self.records, self.size = None, 0, 0


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per row of ``pages``; return the archives that count.

    Archives go to ``folder``, by default one below the shared scratch folder.
    The returned table ``archive, records, bytes`` is written by Spark's commit
    of successful tasks, so files of failed attempts are never read.  A null
    html is an empty payload, a null url leaves its header out.
    """
    spark = pages.sparkSession
    folder = (folder or scratch_path(spark, "archives")).rstrip("/")
    importable(spark)

    def run(batches):
        writer = ArchiveWriter(folder, date, archive_bytes)
        for batch in batches:
            for part in slices(batch, 16 << 20):
                ids, urls = part.column(0).to_pylist(), part.column(1).to_pylist()
                digests, refers = part.column(3).to_pylist(), part.column(4).to_pylist()
                for i in range(part.num_rows):
                    payload = memoryview(part.column(2)[i].as_buffer())
                    writer.write(ids[i], urls[i], payload, digests[i], refers[i])
        writer.close()
        if writer.closed:
            names, records, sizes = zip(*writer.closed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                names=["archive", "records", "bytes"],
            )

    written = with_revisits(pages, least_bytes).mapInArrow(run, "archive string, records bigint, bytes bigint")
    return stage(written, "archive-list")


class _Source:
    """Unpacked bytes of an archive, a bounded piece at a time."""

    def __init__(self, stream):
        self.stream = stream
        self.raw = stream.read(_READ)
        self.packed = self.raw[:2] == b"\x1f\x8b"
        self.unpacker = zlib.decompressobj(31) if self.packed else None
        self.buffer = b""

    def _more(self) -> bool:
        """Append to the buffer; false at the end."""
        while True:
            if not self.packed:
                self.buffer += self.raw
                got, self.raw = bool(self.raw), self.stream.read(_READ)
                return got
            if self.unpacker.eof:
                rest = self.unpacker.unused_data or self.raw
                if rest is self.unpacker.unused_data:
                    self.raw = rest
                if not self.raw:
                    self.raw = self.stream.read(_READ)
                if not self.raw:
                    return False
                self.unpacker = zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.stream.read(_READ)
                if not self.raw:
                    raise ValueError("archive ends inside a record")
            data = self.unpacker.decompress(self.raw, _READ)
            self.raw = b"" if self.unpacker.eof else self.unpacker.unconsumed_tail
            if data:
                self.buffer += data
                return True

    def head(self) -> bytes | None:
        """Bytes up to the next empty line; ``None`` at the end of the archive."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if len(self.buffer) > _HEADER_LIMIT:
                raise ValueError("header block too long")
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a header")
                return None
        found, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self._more():
                raise ValueError("archive ends inside a record")
            piece, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_chunks(stream, archive: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Rows of the chunk table of one archive.

    Each chunk carries the bytes and the digest of its payload so far, so the
    last one has those of the whole payload and no record is held in memory.
    """
    source = _Source(stream)
    while (head := source.head()) is not None:
        fields = _fields(head)
        body = int(fields["content-length"])
        row = {
            "archive": archive,
            "record_id": fields["warc-record-id"].strip("<>"),
            "record_type": fields["warc-type"],
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "stated_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "stated_bytes": None,
        }
        if fields.get("content-type", "").startswith("application/http"):
            http = source.head()
            body -= len(http) + 4
            stated = _fields(http).get("content-length")
            row["stated_bytes"] = int(stated) if stated is not None else None
        running, done, number, held = hashlib.sha1(), 0, 0, bytearray()

        def chunk(last: bool) -> dict:
            return row | {
                "chunk_no": number,
                "data": bytes(held),
                "bytes_so_far": done,
                "digest_so_far": base32_sha1(running.copy().digest()),
                "last": last,
            }

        for piece in source.pieces(body):
            at = 0
            while at < len(piece):
                if len(held) == chunk_bytes:
                    yield chunk(False)
                    number, held = number + 1, bytearray()
                part = piece[at : at + chunk_bytes - len(held)]
                held += part
                running.update(part)
                done += len(part)
                at += len(part)
        yield chunk(True)
        for _ in source.pieces(4):
            pass


def chunk_table(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Read archives back as chunks of records, ordered by ``chunk_no`` within a record.

    ``archives`` has ``archive``, a path that all executors reach.  Tasks read
    whole archives, whose size the writer bounds.
    """
    importable(archives.sparkSession)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_CHUNK_FIELDS)

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _opened(path)
                with files.open_input_stream(name, compression=None) as stream:
                    for row in read_chunks(stream, path, chunk_bytes):
                        rows.append(row)
                        held += len(row["data"] or b"") + 200
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    # An archive is the unit of work; a stated number keeps Spark from joining
    # these tiny rows in one task.
    tasks = max(1, min(archives.count(), READERS))
    spread = archives.select("archive").repartition(tasks, "archive")
    return spread.mapInArrow(run, CHUNK_SCHEMA)


def record_table(chunks: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` per record of a chunk table.

    The last chunk of a record has the digest and length of its whole payload,
    so a stored chunk table is read without its data.  A revisit states length and digest of the payload it stands for; a response
    is measured, and is ``intact`` if that agrees with its headers.
    """
    last = chunks.where("last")
    revisit = F.col("record_type") == "revisit"
    number = lambda c: F.regexp_extract(c, f"^{_SCHEME}(-?[0-9]+)$", 1).try_cast("bigint")
    return last.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
        (
            revisit
            | (
                F.col("stated_digest").eqNullSafe(F.col("digest_so_far"))
                & F.col("stated_bytes").eqNullSafe(F.col("bytes_so_far"))
            )
        ).alias("intact"),
    )
