"""WARC archives compressed with Zstandard: writer and reader.

An archive begins with a skippable frame that holds a dictionary, followed by one
frame for each record, compressed with that dictionary. The dictionary is trained on
the archive's first ``SAMPLES`` records. Archives are rows (path, content), as Spark's
``binaryFile`` source gives them, so archives from elsewhere are read the same way and no
task opens a file by itself.

The reader loads the dictionary from the leading frame, finds the bounds of each frame
from its block headers, decompresses one frame for each record, and checks each record:
version line, headers, Content-Length against the block, the two line ends after it, the
block digest, and for responses the HTTP length and the payload digest. A violation
raises ValueError that names archive and place.

Of pages with equal payloads of at least ``min_revisit_bytes``, the one with the least id
is a ``response``; the others are ``revisit`` records that refer to it and carry the HTTP
header alone, whose length field is that of the full payload. Smaller pages are all
responses. A null payload is an empty one. A null id comes last, is never referred to and
always a response; rows that repeat the least id are responses too. A null URL has no
header. Control characters in a URL are percent-encoded. No page moves between tasks
unless the table of revisits outgrows Spark's own broadcast threshold.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import col, write_cut

ARCHIVE_BYTES = 4 << 20  # of records in an archive; a longer record forms one of its own
SAMPLES, DICT_BYTES, SAMPLE_BYTES = 64, 16 << 10, 32 << 10
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, ident: str, url: str | None, payload: bytes, digest: str,
           refers_to: str | None) -> bytes:
    """One record: headers, an empty line, the block, two line ends."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(
            r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The dictionary's skippable frame and a frame for each record."""
    try:
        trained = zstandard.train_dictionary(
            DICT_BYTES, [r[:SAMPLE_BYTES] for r in records[:SAMPLES]], k=512, d=8)
    except zstandard.ZstdError:  # too few or too small records to learn from
        trained = None
    raw = trained.as_bytes() if trained else b""
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True,
                                      write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(raw)) + raw + b"".join(map(packer.compress, records))


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and block headers."""
    if len(data) < at + 5 or struct.unpack_from("<I", data, at)[0] != FRAME:
        raise ValueError("no frame")
    flags = data[at + 4]
    single, size_flag = flags >> 5 & 1, flags >> 6
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((single, 2, 4, 8)[size_flag])
    while True:
        if len(data) < at + 3:
            raise ValueError("a frame breaks off")
        head = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * (flags >> 2 & 1)
    if at > len(data):
        raise ValueError("a frame breaks off")
    return at


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of every record of an archive."""
    data, at, trained = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data, 0)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        at = 8 + size
        if at > len(data):
            raise ValueError("the dictionary breaks off")
        raw = bytes(data[8:at])
        if raw[:4] == struct.pack("<I", FRAME):  # a dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        trained = zstandard.ZstdCompressionDict(raw) if raw else None
    unpacker = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(data):
        end = frame_end(data, at)
        try:
            yield at, unpacker.decompressobj().decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise ValueError(f"at {at}: {e}") from e
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of a record, checked."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.strip() != name:
            raise ValueError(f"bad header {line[:80]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"{name} is missing")
    size = headers["content-length"]
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block does not have the length that its header gives")
    block = rest[:-4]
    digest = headers.get("warc-block-digest")
    if digest and digest.lower().startswith("sha1:") and digest[5:].upper() != sha1_base32(block):
        raise ValueError("the block does not have the digest that its header gives")
    return headers, block


def http_payload(headers: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """(payload, length of the full payload) of an HTTP record, checked."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    field = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", head)
    size = int(field[1]) if field else len(payload)
    if headers["warc-type"] == "response":
        if size != len(payload):
            raise ValueError("the payload does not have the length that its HTTP header gives")
        digest = headers.get("warc-payload-digest", "")
        if digest.lower().startswith("sha1:") and digest[5:].upper() != sha1_base32(payload):
            raise ValueError("the payload does not have the digest that its header gives")
    return payload, size


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                   payload: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """(path, content): the archives of a table of pages."""
    text = F.coalesce(col(payload).cast("string"), F.lit(""))
    own = pages.select(col(page_id).cast("string").alias("_id"), col(page_id).alias("_order"),
                       col(url).cast("string").alias("_url"), text.alias("_payload"),
                       F.sha1(text).alias("_sha1"))
    narrow = own.where(F.octet_length("_payload") >= min_revisit_bytes).select("_order", "_id", "_sha1")
    first = narrow.groupBy("_sha1").agg(
        F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # Written, so that Spark knows its size and broadcasts it only when it is small.
    again = write_cut(narrow.join(first, "_sha1").where("_order > _first").select(
        "_id", "_sha1", F.col("_first").cast("string").alias("_refers")).dropDuplicates(), "revisits")
    rows = own.drop("_order").join(again, ["_id", "_sha1"], "left").select(
        "_id", "_url", "_payload", "_sha1", "_refers")

    def run(batches):
        part, done = TaskContext.get().partitionId(), 0
        records: list[bytes] = []
        size = unnamed = 0

        def close():
            nonlocal done, size
            name, done = f"part-{part:06d}-{done:06d}.warc.zst", done + 1
            packed = archive(records)
            records.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([packed], pa.binary())], names=["path", "content"])

        for batch in batches:
            for i in range(batch.num_rows):
                ident, link, body, sha1, refers = (batch.column(k)[i].as_py() for k in range(5))
                if ident is None:
                    ident, unnamed = f"null:{part}.{unnamed}", unnamed + 1
                data = record("response" if refers is None else "revisit", RECORD_ID + ident, link,
                              body.encode(), base64.b32encode(bytes.fromhex(sha1)).decode(),
                              None if refers is None else RECORD_ID + refers)
                if records and size + len(data) > ARCHIVE_BYTES:
                    yield close()
                records.append(data)
                size += len(data)
        if records:
            yield close()

    return rows.mapInArrow(run, "path string, content binary")


FIELDS = [("record_id", T.StringType()), ("url", T.StringType()), ("record_type", T.StringType()),
          ("refers_to", T.StringType()), ("payload_bytes", T.LongType()),
          ("payload_digest", T.StringType())]


def read_archives(archives: DataFrame, path: str = "path", content: str = "content",
                  with_payload: bool = True) -> DataFrame:
    """The records of archives (path, content): their ids, URL, type, what a revisit
    refers to, length and digest of the full payload, and unless ``with_payload`` is
    off the payload (empty for a revisit). A null or empty archive has no records."""
    fields = FIELDS + [("payload", T.BinaryType())] * with_payload
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def bare(uri: str | None) -> str | None:
        return uri[1:-1] if uri and uri[0] == "<" and uri[-1] == ">" else uri

    def run(batches):
        for batch in batches:
            for name, packed in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                try:
                    for at, data in frames(packed.as_py() or b""):
                        headers, block = parse(data)
                        payload, full = http_payload(headers, block)
                        digest = headers.get("warc-payload-digest", "")
                        row = (bare(headers["warc-record-id"]), headers.get("warc-target-uri"),
                               headers["warc-type"], bare(headers.get("warc-refers-to")), full,
                               digest.partition(":")[2] or sha1_base32(payload))
                        rows.append(row + (payload,) * with_payload)
                        size += len(payload)
                        if size > ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pylist(
                                [dict(zip(schema.names, r)) for r in rows], arrow_schema)
                            rows, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{name.as_py()}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(schema.names, r)) for r in rows], arrow_schema)

    arrow_schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
                               [t.simpleString()]) for n, t in fields])
    return archives.select(col(path), col(content)).mapInArrow(run, schema)
