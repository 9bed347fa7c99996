"""WARC archives: written in segments, read back by reassembling them.

A payload becomes an HTTP response with chunked transfer framing. A response longer than one
segment is cut: the first record keeps its type, the rest are ``continuation`` records that name
the first one's id, their number and, in the last one, the total length. Reading groups the
segments by origin id, orders them by number, checks the total and removes the framing.
Records of equal payloads refer to the one with the smallest key.

Spark writes and reads the files, so the folder may be in any store and lost tasks are repeated.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import kept

END = b"\r\n\r\n"
SEGMENT_BYTES = 1 << 18
CHUNK_BYTES = 1 << 14
FILE_BYTES = 1 << 25
# Further copies of a record that one row makes.
COPIES = 4096
# Characters of a header value that stay as they are.
PLAIN = "".join(chr(code) for code in range(0x21, 0x7F) if chr(code) not in '%<>"')


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing."""
    parts = []
    for start in range(0, len(payload), size):
        chunk = payload[start : start + size]
        parts.append(b"%X\r\n%b\r\n" % (len(chunk), chunk))
    parts.append(b"0\r\n\r\n")
    return b"".join(parts)


def unchunked(body: bytes) -> bytes:
    """The payload in a chunked body; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        start = line + 2
        if size == 0:
            return b"".join(parts)
        if body[start + size : start + size + 2] != b"\r\n":
            raise ValueError("a chunk has not the length it names")
        parts.append(body[start : start + size])
        at = start + size + 2


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key, url: str | None, digest: str, copy: int = 1) -> str:
    """The id of a record, and of further copies of it."""
    parts = (key, url, digest) if copy == 1 else (key, url, digest, copy)
    name = hashlib.sha1(repr(parts).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record without the blank lines that end it."""
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode()]
    head += [f"{name}: {value}".encode() for name, value in fields if value is not None]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + END + block


def response_records(fields, block: bytes, segment_bytes: int) -> Iterator[bytes]:
    """The response, or its segments."""
    identity = dict(fields)["WARC-Record-ID"]
    if len(block) <= segment_bytes:
        yield record("response", fields, block)
        return
    starts = range(0, len(block), segment_bytes)
    for number, start in enumerate(starts, 1):
        segment = block[start : start + segment_bytes]
        if number == 1:
            yield record("response", [*fields, ("WARC-Segment-Number", 1)], segment)
            continue
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{identity}/{number}')}>"
        more = [("WARC-Record-ID", own), ("WARC-Segment-Origin-ID", identity), ("WARC-Segment-Number", number)]
        if number == len(starts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        yield record("continuation", more, segment)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of every record."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = end + len(END)
        size = int(head["Content-Length"])
        if start + size > len(data):
            raise ValueError("a record is cut off")
        yield head, view[start : start + size]
        at = start + size + len(END)


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write one record per page, payloads in UTF-8, as gzip-compressed files of bounded size.

    Equal payloads of ``min_revisit_bytes`` or more are stored once, in the record with the
    smallest key (NULL keys last, then the smallest URL); the others are ``revisit`` records.
    A NULL payload is empty. Of rows equal in key, URL and payload one is the response and the
    others revisit it, each under an id of its own; smaller payloads are all responses, copies with
    the same id, and reading returns each of them.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    alike = rows.groupBy("sha1", "size", "page_id", "url").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url"), F.col("copies"))
    firsts = alike.groupBy("sha1", "size").agg(F.min(order).alias("first"))
    firsts = kept(firsts.select(
        "sha1", "size", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
        F.when(F.col("size") >= min_revisit_bytes, F.col("first.copies")).otherwise(1).alias("copies"),
    ), "firsts")
    own = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    columns = ("page_id", "url", "payload", "sha1", "first_id", "first_url", "copy")
    single = rows.join(firsts, ["sha1", "size"]).filter(~own | (F.col("copies") == 1))
    single = single.withColumn("copy", F.lit(1).cast("long")).select(*columns)
    # Copies of a response are counted, not numbered: one of them is written, the rest are made of the count.
    # They are mostly few, or none: known beforehand, they cost no second shuffle of the payloads.
    repeated = kept(firsts.filter("copies > 1"), "repeated")
    one = rows.join(repeated, ["sha1", "size"]).filter(own).dropDuplicates(["sha1", "size"])
    one = one.withColumn("copy", F.lit(1).cast("long")).select(*columns)
    more = repeated.withColumn("run", F.explode(F.sequence(F.lit(2).cast("long"), "copies", F.lit(COPIES).cast("long"))))
    more = more.repartition("sha1", "run").withColumn(
        "copy", F.explode(F.sequence("run", F.least(F.col("run") + (COPIES - 1), F.col("copies"))))
    )
    more = more.select(
        F.col("first_id").alias("page_id"), F.col("first_url").alias("url"), F.lit(None).cast("binary").alias("payload"), *columns[3:]
    )
    rows = single if repeated.isEmpty() else single.unionByName(one).unionByName(more)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = record("warcinfo", [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        blob, held = [info], 0

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array([END.join(blob)], pa.binary())], ["value"])

        for batch in batches:
            for page in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for one in _page_records(*page):
                    blob.append(one)
                    held += len(one)
                    if held >= file_bytes:
                        yield flushed()
                        blob, held = [info], 0
        if held:
            yield flushed()

    def _page_records(page_id, address, payload, sha1, first_id, first_url, copy):
        digest = base64.b32encode(bytes.fromhex(sha1)).decode()
        identity = record_id(page_id, address, digest, copy)
        fields = [
            ("WARC-Record-ID", identity),
            ("Page-ID", page_id),
            ("WARC-Target-URI", None if address is None else quote(address, safe=PLAIN)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
        ]
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
        if copy > 1 or (len(payload) >= min_revisit_bytes and (page_id, address) != (first_id, first_url)):
            refers = ("WARC-Refers-To", record_id(first_id, first_url, digest))
            yield record("revisit", [*fields, refers], http)
        else:
            yield from response_records(fields, http + chunked(payload, chunk_bytes), segment_bytes)

    files = rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = files.write.option("lineSep", END.decode()).option("maxRecordsPerFile", 1)
    writer.option("compression", "gzip").text(path)


RECORD = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("kind", pa.string()),
    ("digest", pa.string()), ("refers", pa.string()), ("origin", pa.string()), ("number", pa.int64()),
    ("total", pa.int64()), ("block", pa.binary()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "record_id string, page_id long, url string, kind string, digest string, refers string, origin string, "
    "number long, total long, block binary, payload binary"
)


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            data = unpacked(content.as_py())
            held, size = [], 0
            for head, block in parse_records(data):
                if head["WARC-Type"] == "warcinfo":
                    continue
                number = head.get("WARC-Segment-Number")
                whole = number is None and head["WARC-Type"] == "response"
                page_id, address = head.get("Page-ID"), head.get("WARC-Target-URI")
                held.append({
                    "record_id": head["WARC-Record-ID"],
                    "page_id": None if page_id is None else int(page_id),
                    "url": None if address is None else unquote(address),
                    "kind": head["WARC-Type"],
                    "digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
                    "refers": head.get("WARC-Refers-To"),
                    "origin": head.get("WARC-Segment-Origin-ID") or (number and head["WARC-Record-ID"]),
                    "number": None if number is None else int(number),
                    "total": int(head["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in head else None,
                    "block": bytes(block) if number is not None else None,
                    "payload": http_payload(bytes(block)) if whole else None,
                })
                size += len(block)
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(held, schema=RECORD)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=RECORD)


def unpacked(content: bytes) -> bytes:
    """The records of a file: all members of a gzip file, or the bytes of a plain one."""
    if content[:2] != b"\x1f\x8b":
        return content
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as members:
        return members.read()


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(END)
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _join_segments(segments: pd.DataFrame) -> pd.DataFrame:
    """One record from its segments; the payload is NULL if a segment or a byte is missing."""
    # Copies of a record have the same id, hence equal segments: one of each number is enough.
    segments = segments.sort_values("number")
    once = segments.drop_duplicates("number")
    block = b"".join(once["block"])
    first = segments[segments["number"] == 1]
    whole = (
        len(first) > 0
        and list(once["number"]) == list(range(1, len(once) + 1))
        and once["total"].iloc[-1] == len(block)
    )
    first = first.copy()
    first["payload"] = [http_payload(block) if whole else None] * len(first)
    first["block"] = None
    return first


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Page records of the archives below ``path``.

    Columns: ``record_id, page_id, url, record_type, payload_digest, refers_to`` (a record id) and
    ``payload``, which is NULL for revisits and for responses with missing segments or bytes.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(_parse_files, RECORD_DDL)
    whole = records.filter(F.col("origin").isNull())
    parts = records.filter(F.col("origin").isNotNull())
    joined = parts.groupBy("origin").applyInPandas(_join_segments, RECORD_DDL)
    return whole.unionByName(joined).select(
        "record_id",
        "page_id",
        "url",
        F.col("kind").alias("record_type"),
        F.col("digest").alias("payload_digest"),
        F.col("refers").alias("refers_to"),
        "payload",
    )


def archive_index(records: DataFrame) -> DataFrame:
    """One row per page: size and digest of the full payload, and whom a revisit refers to.

    The digest is that of the stored payload, so a record whose header names another one shows.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            sizes = pa.array([None if p is None else len(p) for p in payloads], pa.int64())
            digests = pa.array([None if p is None else payload_digest(p) for p in payloads], pa.string())
            rest = [batch.column(name) for name in ("record_id", "page_id", "url", "record_type", "refers_to")]
            yield pa.RecordBatch.from_arrays(
                [*rest, sizes, digests],
                ["record_id", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"],
            )

    sizes = records.drop("payload_digest").mapInArrow(
        measure,
        "record_id string, page_id long, url string, record_type string, refers_to string, "
        "payload_bytes long, payload_digest string",
    )
    responses = sizes.filter("record_type = 'response'")
    originals = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("origin_id"),
        F.min("payload_bytes").alias("origin_bytes"),
        F.min("payload_digest").alias("origin_digest"),
    )
    revisits = sizes.filter("record_type = 'revisit'").join(originals, "refers_to", "left")
    revisits = revisits.select(
        "page_id", "url", F.col("origin_bytes").alias("payload_bytes"), F.col("origin_digest").alias("payload_digest"),
        "record_type", F.col("origin_id").alias("refers_to"),
    )
    return revisits.unionByName(
        responses.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    )
