"""WARC archives in seekable Zstandard bundles.

Pages become WARC records; of pages with equal payloads one is stored and the others
are revisits of it.  A task groups its records into independent Zstandard frames and
appends a seek table as a skippable footer frame, so a frame can be read without
those before it.  An index maps every record identifier to its bundle, its frame and
its offset inside the frame.

Bundles are files in a folder that all executors reach (any file system known to
pyarrow).  Their names carry the task attempt: a repeated task writes files of its
own, and only those named in the committed index count.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import pick, written

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
WARC_DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the formats: seekable Zstandard, WARC revisits.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:netpulse:page")


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder or file URI."""
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{page_id}/{digest}')}>"


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One record: the HTTP head and, unless it is a revisit, the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", WARC_DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
        if refers_to is not None:
            head.append(("X-Refers-To-Page-ID", str(refers_to)))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], int, bytes | None, int]:
    """Headers, payload bytes, payload (None for a revisit) and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines)
    start, size = end + 4, int(head["Content-Length"])
    block = data[start:start + size]
    http, _, body = block.partition(b"\r\n\r\n")
    n = int(http.rsplit(b"Content-Length: ", 1)[1])
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and (len(body) != n or payload_digest(body) != head["WARC-Payload-Digest"][5:]):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    return head, n, None if revisit else body, start + size + 4


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: a skippable frame of (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """``(position, compressed size, plain size)`` of every frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8  # with checksums a third word per frame
    file.seek(size - 9 - n * entry)
    table, frames, at = file.read(n * entry), [], 0
    for i in range(n):
        c, d = struct.unpack_from("<II", table, i * entry)
        frames.append((at, c, d))
        at += c
    return frames


def read_frame(file, position: int, size: int, plain: int) -> bytes:
    file.seek(position)
    return zstandard.ZstdDecompressor().decompress(file.read(size), max_output_size=plain)


def read_record(bundle: str, frame: int, offset: int) -> tuple[dict[str, str], int, bytes | None]:
    """One record by its index entry; only its frame is read."""
    fs, path = file_system(bundle)
    with fs.open_input_file(path) as file:
        data = read_frame(file, *read_seek_table(file)[frame])
    return parse_record(data, offset)[:3]


class _BundleWriter:
    """Writes records to bundles of bounded size and keeps their places."""

    def __init__(self, folder: str, stem: str):
        self.folder, self.stem, self.count = folder, stem, 0
        self.fs, self.path = file_system(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.out = None
        self.frame = bytearray()
        self.frames: list[tuple[int, int]] = []
        self.bytes = 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        if self.out is None:
            self.name = f"{self.stem}-{self.count:05d}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.frames, self.bytes, self.count = [], 0, self.count + 1
        place = (f"{self.folder}/{self.name}", len(self.frames), len(self.frame), len(record))
        self.frame += record
        if len(self.frame) >= FRAME_BYTES:
            self._end_frame()
            if self.bytes >= BUNDLE_BYTES:
                self.close()
        return place

    def _end_frame(self) -> None:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(bytes(self.frame))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.frame)))
        self.bytes += len(self.frame)
        self.frame = bytearray()

    def close(self) -> None:
        if self.out is not None:
            if self.frame:
                self._end_frame()
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None


def revisits(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages whose payload a page with a smaller id holds."""
    first = digests.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # a payload that many pages share is a skewed key here; only ids and digests are dealt, and the join may be split
    return digests.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))) \
        .select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, html_col: str = "html",
                   url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Write a WARC record per row into bundles under ``folder``; returns the index.

    The index holds ``record_id, bundle, frame, offset, length`` per record.  Null
    html counts as empty.  Of records with equal payloads of at least ``min_bytes``
    the one with the smallest id is the response (null ids aside), the others revisit
    it; rows that repeat id and payload are the same capture and get the same type.
    """
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col) \
        .withColumn("html", F.coalesce("html", F.lit("")).cast("binary"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("html")))
    digests = written(rows.select("page_id", "digest", F.octet_length("html").alias("n_bytes")), "payloads")
    again = revisits(digests, min_bytes).withColumn("revisit", F.lit(True))
    dealt = rows.alias("p").join(again.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id"))
                                 & (F.col("p.digest") == F.col("r.digest")), "left") \
        .select("p.page_id", "url", "html", "p.digest", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = _BundleWriter(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}")
        for b in batches:
            ids, places = [], []
            for page_id, url, html, digest, refers_to, revisit in zip(*[c.to_pylist() for c in b.columns]):
                name = base64.b32encode(digest).decode()
                ids.append(record_id(page_id, name))
                places.append(writer.add(warc_record(page_id, url, html, name, refers_to, revisit)))
            if ids:
                bundle, frame, offset, length = zip(*places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(bundle), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()),
                     pa.array(length, pa.int64())], names=["record_id", "bundle", "frame", "offset", "length"])
        writer.close()

    return written(dealt.mapInArrow(write, "record_id string, bundle string, frame int, offset long, length long"), "index")


def read_archives(index: DataFrame, id_type: T.DataType, with_payload: bool = True) -> DataFrame:
    """Read every record of the bundles named in ``index``, frame by frame, and check its digest.

    Returns ``page_id, record_id, url, payload_bytes, payload_digest, record_type,
    refers_to`` and, on request, the ``payload`` (null for a revisit).
    """
    spark = index.sparkSession
    bundles = index.select("bundle").distinct()
    width = min(max(1, bundles.count()), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [T.StructField(c, T.StringType()) for c in ("page_id", "record_id", "url")] + \
        [T.StructField("payload_bytes", T.LongType())] + \
        [T.StructField(c, T.StringType()) for c in ("payload_digest", "record_type", "refers_to")] + \
        [T.StructField("payload", T.BinaryType())] * with_payload
    kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 3 + [pa.binary()] * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bundle in b.column(0).to_pylist():
                fs, path = file_system(bundle)
                with fs.open_input_file(path) as file:
                    for frame in read_seek_table(file):
                        data, at, rows = read_frame(file, *frame), 0, []
                        while at < len(data):
                            head, n, payload, at = parse_record(data, at)
                            rows.append((head.get("X-Page-ID"), head["WARC-Record-ID"], head.get("WARC-Target-URI"), n,
                                         head["WARC-Payload-Digest"][5:], head["WARC-Type"],
                                         head.get("X-Refers-To-Page-ID"), payload)[:len(fields)])
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                         names=[f.name for f in fields])

    found = bundles.repartition(width).mapInArrow(read, T.StructType(fields))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, a row per page."""
    index = write_archives(pages, scratch_path(pages.sparkSession, "llm", "warc"), min_bytes)
    return read_archives(index, pages.schema["page_id"].dataType, with_payload=False)
