"""WARC archives of Zstandard frames with a dictionary (operator 2).

File layout (the public ``.warc.zst`` convention): a leading skippable frame 0x184D2A5D holds the Zstandard dictionary;
then every WARC record is one frame compressed with it.  Empty skippable frames may stand between records and are
passed over.

Writing: each task trains a dictionary on the first pages it sees and turns its rows into frames; Spark's text writer
puts them into one file per task on any file system it can reach.  The line separator of that writer is an empty
skippable frame, so the bytes between records are valid Zstandard as well.

Reading: Spark's binaryFile source; each task walks the frames of its files (block headers give a frame's length), loads
the dictionary, decodes one frame per record and validates the record: WARC/1.1 version line, mandatory headers, known
type, Content-Length equal to the block, payload digest of responses equal to the payload.

Records with equal payloads of at least ``min_bytes`` bytes: the one with the smallest page_id is a response, the others
are revisit records that refer to it and carry no payload (its length and digest stand in the headers).

Defined results: a null html is an empty payload; null page_id is written as such, sorts after all others and comes back
as null; rows that share the smallest page_id of a payload are all responses; null or missing urls become an empty
target; other columns are not read; an empty table gives archives without records and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens.llm.shared import written
from wagelens.session import scratch_path

# Fixed values of the formats.
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode()
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
TYPES = ("response", "revisit")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

DICTIONARY_BYTES = 16_384
SAMPLES, SAMPLE_BYTES = 256, 4_096
LEVEL = 3
MIN_BYTES = 0


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    inner = name.removeprefix("<urn:page:").removesuffix(">")
    return None if inner == "null" else int(inner)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; refers_to makes it a revisit without payload."""
    target = "".join(c for c in (url or "") if c >= " ").strip()
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = status + payload if refers_to is None else status
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", "sha1:" + digest_of(payload)), ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        head += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises ValueError if anything does not hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:80]!r}")
        headers[name.strip()] = value.strip()
    missing = [h for h in REQUIRED if h not in headers]
    if missing:
        raise ValueError(f"missing headers {missing}")
    if headers["WARC-Type"] not in TYPES:
        raise ValueError(f"unknown record type {headers['WARC-Type']}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    return headers, rest[:length]


def train_dictionary(samples: list[bytes]) -> bytes | None:
    """A Zstandard dictionary, or None where the samples are too few or too small for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def frame_end(data: memoryview, at: int) -> int:
    """End of the Zstandard frame that begins at ``at``, by its header and block headers."""
    parameters = zstandard.get_frame_parameters(data[at: at + 18])
    at += zstandard.frame_header_size(data[at: at + 18])
    while True:
        if at + 3 > len(data):
            raise ValueError("truncated frame")
        header = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        if kind == 3:
            raise ValueError("bad block type")
        at += 3 + (1 if kind == 1 else size)
        if last:
            break
    at += 4 * bool(parameters.has_checksum)
    if at > len(data):
        raise ValueError("truncated frame")
    return at


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Validated headers and block of every record of one archive."""
    data, at, decoder = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("trailing bytes")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if at + 8 + size > len(data):
                raise ValueError("truncated skippable frame")
            if magic == DICTIONARY_MAGIC and at == 0 and size:
                own = bytes(data[8: 8 + size])
                if own[:4] == struct.pack("<I", FRAME_MAGIC):
                    own = zstandard.ZstdDecompressor().decompress(own)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield parse_record(decoder.decompressobj().decompress(data[at:end]))
            at = end
        else:
            raise ValueError(f"unknown frame magic {magic:#x}")


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = None
    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True)
        records = (record(*row) for row in rows)
        if compressor is None and batch.num_rows:
            heads = zip(*(batch.column(c).slice(0, SAMPLES).to_pylist() for c in ("page_id", "url", "payload")), strict=True)
            own = train_dictionary([record(p, u, x[:SAMPLE_BYTES], None) for p, u, x in heads])
            out.append(skippable(DICTIONARY_MAGIC, own or b""))
            compressor = zstandard.ZstdCompressor(
                level=LEVEL, write_checksum=True, write_content_size=True, dict_data=zstandard.ZstdCompressionDict(own) if own else None)
        out.extend(compressor.compress(r) for r in records)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write one record per row of page_id, url, html; one archive per task under ``path``."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    # payloads met twice or more, with their smallest page; one row per payload and task before the shuffle
    first = written(own.filter(F.length("payload") >= min_bytes).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"), "payloads")
    joined = own.join(first, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= min_bytes), F.col("first"))
    frames = joined.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(_frames, "frame binary")
    # the bytes go through the text writer as they are: a string column is a byte array to it
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows: list[tuple] = []
            for headers, block in read_archive(content.as_py()):
                revisit = headers["WARC-Type"] == "revisit"
                stated, payload = headers["WARC-Payload-Digest"].removeprefix("sha1:"), None
                size = int(headers["WARC-Payload-Length"])
                if not revisit:
                    payload = block.partition(b"\r\n\r\n")[2]
                    if len(payload) != size or digest_of(payload) != stated:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its headers")
                rows.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI", ""), size, stated, headers["WARC-Type"],
                             _page(headers["WARC-Refers-To"]) if revisit else None, payload))
                if len(rows) >= 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_records, SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write archives of ``pages`` in the shared folder and return the records read back, without payloads."""
    path = scratch_path(pages.sparkSession, f"llm-warc-{uuid.uuid4().hex}")
    write_archives(pages, path, min_bytes)
    return read_archives(pages.sparkSession, path).drop("payload")
