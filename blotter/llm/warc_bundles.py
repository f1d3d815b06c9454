"""WARC records in seekable Zstandard bundles.

A bundle is a ``.zst`` file of independent frames, each holding whole WARC
records, and a seek table in a skippable frame at its end (the public seekable
format): any frame can be read alone.  The index maps a record identifier to
bundle, frame and the record's offset inside the decompressed frame.

Bundles are written by Spark's own file writer, one row a file: the row holds
the bundle up to the last four bytes, and the writer's record separator is the
seek table's closing magic number.  So files appear through the commit
protocol, on any file system Spark can write, and a lost executor leaves no
half-written bundle.  They are read back with the ``binaryFile`` source.

A payload that several pages share is stored once: the page with the largest
id is the response, the others are revisit records that refer to it.  The join
that finds them is salted by row, since one payload may belong to a third of
all pages.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import Scratch

# Fixed values of the seekable format.
_SKIPPABLE = struct.pack("<I", 0x184D2A5E)
_MAGIC = struct.pack("<I", 0x8F92EAB1)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NONE = -(1 << 63)


def record_id(page_id: int | None, copy: int) -> str:
    """The record URI of the copy-th row with that page id; both can be read back from it."""
    low = 0 if page_id is None else page_id & (1 << 64) - 1
    return f"<urn:uuid:{uuid.UUID(int=(1 if page_id is None else 0) << 127 | copy << 64 | low)}>"


def page_of(uri: str) -> int | None:
    n = uuid.UUID(uri[10:-1]).int
    low = n & (1 << 64) - 1
    return None if n >> 127 else low - (1 << 64) if low >> 63 else low


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, copy, url, payload: bytes, head_id, head_copy, date: str) -> bytes:
    """A response record with the payload, or a revisit record of ``head`` that keeps its HTTP headers."""
    revisit = head_copy is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, copy)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {quote(url or '', safe='%/:=&?~#+!$,;@()*[]')}",
            f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(head_id, head_copy)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def bundle(frames: list[tuple[bytes, int]]) -> bytes:
    """The frames and their seek table, without the closing magic number."""
    table = b"".join(struct.pack("<II", len(f), size) for f, size in frames)
    body = table + struct.pack("<IB", len(frames), 0)
    return b"".join(f for f, _ in frames) + _SKIPPABLE + struct.pack("<I", len(body) + 4) + body


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the footer."""
    count, flags = struct.unpack_from("<IB", data, len(data) - 9)
    if data[-4:] != _MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    at, out = len(data) - 9 - width * count, []
    start = 0
    for k in range(count):
        packed, size = struct.unpack_from("<II", data, at + width * k)
        out.append((start, packed, size))
        start += packed
    return out


def read_frame(data: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(data[start:start + packed], max_output_size=max(1, size))


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at an offset of a decompressed frame."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record at this offset")
    head = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    body = end + 4
    size = int(head["Content-Length"])
    return head, raw[body:body + size], body + size + 4


def _bundles(frame_bytes: int, bundle_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]):
        press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        frames, held, pending, size = [], 0, [], 0

        def row(data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["bundle"])

        for batch in batches:
            for page in zip(*(c.to_pylist() for c in batch.columns)):
                pending.append(record(*page, date))
                size += len(pending[-1])
                if size >= frame_bytes:
                    frames.append((press.compress(b"".join(pending)), size))
                    held, pending, size = held + len(frames[-1][0]), [], 0
                    if held >= bundle_bytes:
                        yield row(bundle(frames))
                        frames, held = [], 0
        if pending:
            frames.append((press.compress(b"".join(pending)), size))
        if frames:
            yield row(bundle(frames))

    return run


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit_bytes: int = 0, frame_bytes: int = 256 << 10,
                  bundle_bytes: int = 16 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z",
                  salts: int = 16) -> None:
    """Write one record per row of ``pages`` as bundles under ``path``.

    Null payloads count as empty, null urls too.  Of rows with equal payloads
    of at least ``min_revisit_bytes`` bytes the one with the largest id is the
    response (of rows repeated under that id, one); a null id is the smallest.
    An empty table writes no bundle; other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = scratch.stage(pages.select(
        F.monotonically_increasing_id().alias("copy"), F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("key")), "rows")
    head = (rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("key")
            .agg(F.count("*").alias("n"), F.max(F.struct(F.coalesce("id", F.lit(_NONE)), "id", "copy")).alias("h"))
            .filter("n > 1").select("key", F.col("h.id").alias("head_id"), F.col("h.copy").alias("head_copy"),
                                    F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    dealt = rows.withColumn("salt", F.pmod(F.hash("copy"), F.lit(salts))).join(head, ["key", "salt"], "left")
    other = F.col("copy") != F.col("head_copy")
    (dealt.select("id", "copy", "url", "payload", F.when(other, F.col("head_id")).alias("head_id"),
                  F.when(other, F.col("head_copy")).alias("head_copy"))
     .mapInArrow(_bundles(frame_bytes, bundle_bytes, level, date), "bundle binary")
     .select(F.col("bundle").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", _MAGIC.decode("latin-1")).text(path))
    scratch.drop("rows")


_RECORD = ("record_id string, bundle string, frame int, offset long, record_type string, page_id long, "
           "refers_to long, url string, payload_bytes long, payload_digest string, payload binary")


def _read(only: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for path, data, *wanted in zip(*(c.to_pylist() for c in batch.columns)):
                table = seek_table(data)
                places: dict[int, list[int] | None] = {k: None for k in range(len(table))}
                if only:
                    places = {}
                    for w in wanted[0]:
                        places.setdefault(w["frame"], []).append(w["offset"])
                for k, offsets in sorted(places.items()):
                    raw, out = read_frame(data, table[k]), []
                    at = 0
                    while offsets is None and at < len(raw):
                        out.append((at, *parse(raw, at)))
                        at = out[-1][3]
                    out += [(o, *parse(raw, o)) for o in offsets or ()]
                    yield _rows(path, k, out)

    return run


def _rows(path: str, frame: int, records: list) -> pa.RecordBatch:
    rows = []
    for at, head, block, _ in records:
        http, payload = block.split(b"\r\n\r\n", 1)
        stated = int(http.rsplit(b"Content-Length: ", 1)[1])
        revisit = head["WARC-Type"] == "revisit"
        own = head["WARC-Payload-Digest"][5:] if revisit else digest(payload)
        if not revisit and (own != head["WARC-Payload-Digest"][5:] or len(payload) != stated):
            raise ValueError(f"{head['WARC-Record-ID']}: payload and header differ")
        refers = page_of(head["WARC-Refers-To"]) if revisit else None
        rows.append((head["WARC-Record-ID"], path, frame, at, head["WARC-Type"], page_of(head["WARC-Record-ID"]), refers,
                     head.get("WARC-Target-URI"), stated, own, None if revisit else payload))
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(),
             pa.int64(), pa.string(), pa.binary()]
    cols = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=[f.split(" ")[0] for f in _RECORD.split(", ")])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles under ``path``; a revisit has no payload of its own (null).

    ``record_id, bundle, frame, offset`` are the index; payloads are checked
    against their digests.
    """
    return _files(spark, path).mapInArrow(_read(False), _RECORD)


def fetch(spark: SparkSession, path: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``ids``: only their frames are decompressed."""
    wanted = (index.join(ids.select("record_id").distinct(), "record_id", "left_semi")
              .groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset")).alias("wanted")))
    files = _files(spark, path)
    return (files.join(wanted, files.path == wanted.bundle).select("path", "content", "wanted")
            .mapInArrow(_read(True), _RECORD))
