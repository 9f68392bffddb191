"""WARC archives compressed with Zstandard: one frame per record, dictionary in front.

An archive starts with a skippable frame holding the dictionary (itself maybe
compressed), then has one frame per record. ``write_archives`` packs rows into
archives of bounded size, one row of the result each; ``read_archives`` takes such
rows, or those of Spark's ``binaryFile`` source (``path``, ``content``), and returns
one row per record, with what is wrong with it in ``problem`` instead of failing.

Of pages with equal payloads the one with the largest id is a response, the others
are revisits that refer to it; payloads shorter than ``least_bytes`` are always
responses. Defined cases: a NULL payload is empty; a NULL id is below all others and
is referred to by none; rows with the responding row's own id are responses too.
NULL urls are written without a target. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
ARCHIVE_BYTES = 4 << 20
#: Bytes handed to the decoder at first, and at most, per step within a frame.
FRAME_STEP = 4096
MOST_STEP = 1 << 20
RECORD_SCHEMA = (
    "record_id string, record_type string, target string, refers_to string, payload_bytes long, "
    "payload_digest string, payload binary, problem string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(pages: DataFrame, *, payload_col: str = "html", rows: int = 500, size: int = 16 << 10) -> bytes:
    """Dictionary from the payloads of at most ``rows`` rows, of 16 KB each at most; empty if there are too few."""
    sample = [bytes(r[0]) for r in pages.select(F.col(payload_col).cast("binary").substr(1, 16 << 10)).limit(rows).collect() if r[0]]
    try:
        return zstandard.train_dictionary(size, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def resolve_duplicates(
    pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least_bytes: int = 0
) -> DataFrame:
    """``id``, ``url``, ``payload``, ``record_type`` and ``refers_to`` of each row.

    Only digests are grouped, with partial maxima before the shuffle; the join back
    is a plain sort-merge join, whose hot digests adaptive execution splits.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = (
        rows.groupBy("digest")
        .agg(F.max("id").alias("last"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("last").isNotNull())
        .select("digest", "last")
    )
    revisit = (F.octet_length("payload") >= least_bytes) & F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    return rows.join(groups, "digest", "left").select(
        "id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def _headers(lines: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines).encode()


def record(row_id: str, url: str | None, payload: bytes, kind: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the full length, and no payload."""
    head = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = head if kind == "revisit" else head + payload
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{row_id}>")]
    if url is not None:
        lines.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        lines.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    lines += [
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + _headers(lines) + b"\r\n" + block + b"\r\n\r\n"


def write_archives(resolved: DataFrame, dictionary: bytes, *, archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Archives (``content``) with the records of ``resolve_duplicates``; a task closes one at ``archive_bytes``."""
    shared = resolved.sparkSession.sparkContext.broadcast(dictionary)
    rows = resolved.select(
        F.col("id").cast("string"), "url", "payload", "record_type", F.col("refers_to").cast("string")
    )

    def make():
        raw = shared.value
        given = zstandard.ZstdCompressionDict(raw) if raw else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=given, write_checksum=True, write_content_size=True)
        front = struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw if raw else b""
        frames: list[bytes] = []

        def close():
            if frames:
                yield pa.RecordBatch.from_arrays([pa.array([front + b"".join(frames)], pa.binary())], ["content"])
                frames.clear()

        def step(batch: pa.RecordBatch):
            size = sum(map(len, frames))
            for r in batch.to_pylist():
                made = record(r["id"] or "", r["url"], r["payload"], r["record_type"], r["refers_to"])
                frames.append(compressor.compress(made))
                size += len(frames[-1])
                if size >= archive_bytes:
                    yield from close()
                    size = 0

        step.end = close
        return step

    return arrow_stage(rows, make, "content binary")


def leading_dictionary(content: bytes) -> tuple[bytes, int]:
    """Dictionary in the leading skippable frame, and where the frames of records begin."""
    if len(content) < 8 or struct.unpack_from("<I", content)[0] != DICTIONARY_MAGIC:
        return b"", 0
    end = 8 + struct.unpack_from("<I", content, 4)[0]
    if end > len(content):
        raise ValueError("the dictionary frame is cut off")
    found = content[8:end]
    return (zstandard.ZstdDecompressor().decompress(found) if found[:4] == FRAME_MAGIC else found), end


def parse_record(raw: bytes) -> dict:
    """Fields of one record; raises ``ValueError`` where headers, lengths or digests disagree."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {k.lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}
    length = int(fields.get("content-length", "-1"))
    if length < 0 or length != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not fit the record")
    block = rest[:-4]
    if fields.get("warc-block-digest") not in (None, f"sha1:{base32_sha1(block)}"):
        raise ValueError("the block's digest differs")
    http, sep, payload = block.partition(b"\r\n\r\n")
    if not sep or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    stated = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("utf-8").split("\r\n")[1:])}
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = int(stated.get("content-length", len(payload)))
    if kind == "response" and (size != len(payload) or digest != base32_sha1(payload)):
        raise ValueError("the payload's length or digest differs")
    if kind == "revisit" and (payload or not digest or "warc-refers-to" not in fields):
        raise ValueError("a revisit has a payload, or no digest or reference")

    def name(field: str) -> str | None:
        return fields[field].removeprefix("<urn:page:").removesuffix(">") if field in fields else None

    return {
        "record_id": name("warc-record-id"), "record_type": kind, "target": fields.get("warc-target-uri"),
        "refers_to": name("warc-refers-to"), "payload_bytes": size, "payload_digest": digest,
        "payload": payload if kind == "response" else None, "problem": None,
    }


def next_frame(decoder: zstandard.ZstdDecompressor, content: memoryview, at: int) -> tuple[bytes, int]:
    """The frame at ``at`` and where the next begins; what is read does not grow with the rest of the archive."""
    one = decoder.decompressobj()
    parts, step = [], FRAME_STEP
    while at < len(content) and not one.eof:
        piece = content[at : at + step]
        parts.append(one.decompress(piece))
        at += len(piece)
        step = min(2 * step, MOST_STEP)
    if not one.eof:
        raise ValueError("the last frame is cut off")
    return b"".join(parts), at - len(one.unused_data)


def records_of(content: bytes):
    """Parsed records of one archive, a broken one as a row with ``problem``; reading ends at a broken frame."""
    empty = dict.fromkeys(x.split()[0] for x in RECORD_SCHEMA.split(", "))
    try:
        raw, at = leading_dictionary(content)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
        view = memoryview(content)
        while at < len(content):
            whole, at = next_frame(decoder, view, at)
            try:
                yield parse_record(whole)
            except ValueError as e:
                yield empty | {"problem": str(e)}
    except (ValueError, zstandard.ZstdError) as e:
        yield empty | {"problem": str(e)}


def read_archives(archives: DataFrame, *, content_col: str = "content", payloads: bool = True) -> DataFrame:
    """One row per record (see ``RECORD_SCHEMA``); ``payloads=False`` validates payloads but leaves them out."""
    schema = pa.schema(
        [(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in RECORD_SCHEMA.split(", "))]
    )

    def make():
        def step(batch: pa.RecordBatch):
            for content in batch.column(0).to_pylist():
                rows: list[dict] = []
                size = 0
                for r in records_of(content or b""):
                    size += len(r["payload"] or b"")
                    rows.append(r if payloads else r | {"payload": None})
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

        return step

    return arrow_stage(archives.select(F.col(content_col).alias("content")), make, RECORD_SCHEMA)
