"""WARC archives with dictionary compression (.warc.zst).

``write_archives`` turns rows into WARC/1.1 records, a record a frame: each
task trains a Zstandard dictionary on the first records of an archive,
writes it as the archive's leading skippable frame and compresses every
record by itself with it, so that a reader can start at any record and
needs nothing but the archive. Archives are rolled at a bounded size and
appear under their final name only when whole; a repeated task leaves
other names, of which the manifest returned by the job lists one set.

``read_archives`` reads listed archives record by record, in Spark tasks,
and computes lengths and digests from the payloads it finds.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_batches
from tickwise.session import checkpoint_dir, stored

MIN_REVISIT = 100              # bytes: shorter payloads are always stored
ARCHIVE_BYTES = 64 << 20       # of compressed records after which an archive is closed
SAMPLE_BYTES = 2 << 20         # of records that a dictionary is trained on, at most
MIN_SAMPLES = 16               # fewer pieces of records: a dictionary of their text as it stands
MIN_PIECE = 512                # bytes of a piece, at least
DICTIONARY_BYTES = 32 << 10
LEVEL = 6
SKIPPABLE = 0x184D2A5D         # the frame that holds a dictionary (fixed value of the format)
_STAMP = "2024-01-01T00:00:00Z"   # archives of equal rows are equal


def decide(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Adds payload_digest (SHA-256 of the bytes in ``payload``, lower-case
    hex) and refers_to: of rows with equal payloads of at least
    ``MIN_REVISIT`` bytes those with the smallest key have none, the others
    name it. Nulls come after every key; if all are null, none refers."""
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= MIN_REVISIT
    first = (rows.where(long).groupBy("payload_digest")
             .agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    # Only digests that repeat are joined; hot ones are split by the adaptive skew join.
    other = F.col(key).isNull() | (F.col(key) > F.col("_first"))
    return (rows.join(stored(first, "first_payloads"), "payload_digest", "left")
            .withColumn("refers_to", F.when(long & F.col("_first").isNotNull() & other, F.col("_first")))
            .drop("_first"))


def _header(kind: str, key, url: str | None, digest: str, refers_to, block: bytes, length: int) -> bytes:
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else f"urn:page:{key}"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {uri} {digest}')}>",
             f"WARC-Date: {_STAMP}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}",
             f"X-Payload-Length: {length}"]
    if key is not None:
        lines.append(f"X-Page-ID: {key}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(key, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit holds the HTTP header only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    return _header(kind, key, url, digest, refers_to, block, len(payload)) + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary of these records: trained on pieces of them, so that one
    long record or a few make enough; of what is too short or too alike to
    train on, the records' own beginning."""
    whole = sum(map(len, records))
    piece = max(MIN_PIECE, min(SAMPLE_BYTES, whole) // (4 * MIN_SAMPLES))
    samples, held = [], 0
    for r in records:
        for i in range(0, len(r), piece):
            if held < SAMPLE_BYTES:
                samples.append(r[i:i + piece])
                held += len(samples[-1])
    if len(samples) >= MIN_SAMPLES:
        try:
            # Segment length and frequency are given: no search over them.
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8, level=LEVEL)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES],
                                         dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """One archive being written: under a name of its own until closed."""

    def __init__(self, folder: str, name: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.name, self.path = name, f"{base}/{name}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(f"{self.path}.open", compression=None)
        self.waiting: list[bytes] | None = []
        self.held = self.size = self.records = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.waiting is not None:
            self.waiting.append(data)
            self.held += len(data)
            if self.held >= SAMPLE_BYTES:
                self._begin()
        else:
            self._frame(data)

    def _begin(self) -> None:
        waiting, self.waiting = self.waiting, None
        made = dictionary(waiting) if waiting else None
        if made is not None:
            raw = made.as_bytes()
            self.out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
            self.size += 8 + len(raw)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)
        for d in waiting:
            self._frame(d)

    def _frame(self, data: bytes) -> None:
        frame = self.packer.compress(data)
        self.out.write(frame)
        self.size += len(frame)

    def close(self) -> tuple[str, int, int]:
        if self.waiting is not None:
            self._begin()
        self.out.close()
        self.fs.move(f"{self.path}.open", self.path)
        return self.name, self.records, self.size


def write_archives(spark: SparkSession, rows: DataFrame, folder: str, key: str = "page_id",
                   url: str = "url") -> DataFrame:
    """Write ``rows`` (key, url, payload (binary), payload_digest, refers_to)
    as archives in ``folder``, a URI that all executors share; returns the
    stored manifest: archive, records, bytes. No rows: no archives."""
    arrow_batches(spark, 200)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = [], None
        for b in batches:
            for values in zip(*(b.column(i).to_pylist() for i in range(5))):
                if now is None:
                    now = Archive(folder, f"{uuid.uuid4().hex}.warc.zst")
                now.add(record(*values))
                if now.size >= ARCHIVE_BYTES:
                    done.append(now.close())
                    now = None
        if now is not None:
            done.append(now.close())
        names = ["archive", "records", "bytes"]
        cols = zip(*done) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in
                                          zip(cols, (pa.string(), pa.int64(), pa.int64()))], names)

    picked = rows.select(key, url, "payload", "payload_digest", "refers_to")
    return stored(picked.mapInArrow(write, "archive string, records bigint, bytes bigint"), "manifest")


def records_of(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, a frame at a time; the dictionary is taken
    from a leading skippable frame. Memory: a piece and a record."""
    buffer = stream.read(8)
    made = None
    if len(buffer) == 8 and struct.unpack("<I", buffer[:4])[0] == SKIPPABLE:
        made = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", buffer[4:])[0]))
        buffer = b""
    unpacker = zstandard.ZstdDecompressor(dict_data=made)
    frame, parts, begun = unpacker.decompressobj(), [], False
    while True:
        if not buffer:
            buffer = stream.read(piece)
            if not buffer:
                break
        parts.append(frame.decompress(buffer))
        buffer, begun = b"", True
        if frame.eof:
            yield b"".join(parts)
            buffer = frame.unused_data
            frame, parts, begun = unpacker.decompressobj(), [], False
    if begun:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> dict:
    """Header fields of a record (lower-case names) and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"a record of a wrong length: {fields.get('warc-record-id')}")
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """One row a record of the manifest's archives: page_id, url, record_type,
    payload (null for revisits), payload_bytes, payload_digest, refers_to.
    Lengths and digests of responses are computed from the payload and must
    agree with the header; revisits give those of their header."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        rows: list[tuple] = []
        held = 0

        def batch():
            cols = zip(*rows) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)

        for b in batches:
            for name in b.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in records_of(stream):
                        r = parse(data)
                        key = int(r["x-page-id"]) if "x-page-id" in r else None
                        digest = r["warc-payload-digest"].removeprefix("sha256:")
                        length = int(r["x-payload-length"])
                        if r["warc-type"] == "response":
                            payload = r["payload"]
                            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
                                raise ValueError(f"a payload of {name} differs from its digest")
                            rows.append((key, r["warc-target-uri"], "response", payload, length, digest, None))
                            held += length
                        else:
                            refers = int(r["x-refers-to-page-id"])
                            rows.append((key, r["warc-target-uri"], "revisit", None, length, digest, refers))
                        if held >= 4 << 20 or len(rows) >= 1000:
                            yield batch()
                            rows, held = [], 0
        if rows:
            yield batch()

    # An archive a task.
    many = max(1, manifest.count())
    spread = manifest.select("archive").repartition(many, "archive")
    return spread.mapInArrow(read, "page_id bigint, url string, record_type string, payload binary, "
                                   "payload_bytes bigint, payload_digest string, refers_to bigint")


def new_folder(spark: SparkSession) -> str:
    """A folder for archives below the shared one, as a URI."""
    base = checkpoint_dir(spark)
    if base.startswith(("/", "file:/")):
        base = "file:///" + base.removeprefix("file:").lstrip("/")
    return f"{base}/warc-{uuid.uuid4().hex}"


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and read the archives back:
    the columns of ``read_archives``.

    Null html is an empty payload; null or empty urls get a URN. Payloads of
    any length are whole. Rows that share the smallest page_id of a payload
    are all responses. Further columns are ignored; no rows give no rows.
    """
    folder = folder or new_folder(spark)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    return read_archives(spark, write_archives(spark, decide(rows), folder), folder)
