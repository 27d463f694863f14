"""WARC archives: write one request, response and metadata record per page, and read them back as captures.

Records are rows of text files whose line separator is the end of a record, written with gzip, so that a
file is read by one task, in order, with one record in memory at a time; the number of records per file is
bounded. The separator may also occur inside a payload: the reader goes by Content-Length and puts such
pieces together again.

Of pages with equal payloads of at least `least` bytes the one with the largest id holds the payload; the others
are revisit records that refer to it. Transactions are assembled by joining requests and metadata to
the response or revisit that their WARC-Concurrent-To names, by way of each other where they name one
another.

Null payloads are empty. A page without an id or without a url is written with an empty one and read back with
null. Rows that repeat an id and a payload are both written as the response. Empty tables give an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
_READ = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, refers_to_page long, uri string, date string, page_id long, "
    "payload_digest string, payload_bytes long, content_type string, status int, payload binary"
)
_FIELDS = [
    ("record_id", pa.string()),
    ("record_type", pa.string()),
    ("concurrent_to", pa.list_(pa.string())),
    ("refers_to", pa.string()),
    ("refers_to_page", pa.int64()),
    ("uri", pa.string()),
    ("date", pa.string()),
    ("page_id", pa.int64()),
    ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()),
    ("content_type", pa.string()),
    ("status", pa.int32()),
    ("payload", pa.binary()),
]
_DATE = "2024-01-01T00:00:00Z"


def _urn(kind: str, key: str) -> str:
    h = hashlib.sha1(f"{kind}\n{key}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the separator that ends it."""
    lines = [VERSION.decode(), *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def transaction(page_id: int | None, url: str, payload: bytes, hexes: str, refers: int | None) -> Iterator[bytes]:
    """Request, response or revisit, and metadata of a page."""
    key = f"{'' if page_id is None else page_id}\n{hexes}"
    capture, request, about = (_urn(kind, key) for kind in ("capture", "request", "metadata"))
    uri = [("WARC-Target-URI", url)] if url else []
    name = [] if page_id is None else [("X-Page-Id", str(page_id))]
    b32 = base64.b32encode(bytes.fromhex(hexes)).decode()
    path = "/" + url.split("://", 1)[-1].partition("/")[2]
    host = url.split("://", 1)[-1].partition("/")[0]
    asked = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    yield record(
        [("WARC-Type", "request"), ("WARC-Record-ID", request), ("WARC-Date", _DATE), *uri, ("WARC-Concurrent-To", capture), ("Content-Type", "application/http; msgtype=request")],
        asked,
    )
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Record-ID", capture), ("WARC-Date", _DATE), *uri, *name, ("WARC-Payload-Digest", f"sha1:{b32}"), ("X-Payload-Length", str(len(payload)))]
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers is None:
        yield record([("WARC-Type", "response"), *common, kind], head + payload)
    else:
        to = _urn("capture", f"{refers}\n{hexes}")
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        yield record([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", to), ("X-Refers-To-Page-Id", str(refers)), profile, kind], head)
    yield record(
        # Names the request, which names the capture: readers must follow the chain.
        [("WARC-Type", "metadata"), ("WARC-Record-ID", about), ("WARC-Date", _DATE), *uri, ("WARC-Concurrent-To", request), ("Content-Type", "application/warc-fields")],
        f"payload-bytes: {len(payload)}\r\n".encode(),
    )


def write_archives(pages: DataFrame, path: str, least: int = 0, records_per_file: int = 300_000) -> None:
    """Write the archives of `pages` (page_id, url, html) to the folder `path`."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("hexes", F.sha1("payload"))
    long = F.octet_length("payload") >= least
    # Only payloads that several pages share need an entry.
    shared = rows.where(long).groupBy("hexes").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n")
    judged = rows.join(shared, "hexes", "left").withColumn("refers", F.when(long & (F.coalesce("page_id", F.lit(-(2**63))) < F.col("holder")), F.col("holder")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time: a record is as long as its payload.
            for low in range(0, len(batch), 256):
                out = []
                for page_id, url, payload, hexes, refers in zip(*(c.to_pylist() for c in batch.slice(low, 256).columns), strict=True):
                    out += transaction(page_id, (url or "").replace("\r", "").replace("\n", ""), payload, hexes, refers)
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["record"])

    records = judged.select("page_id", "url", "payload", "hexes", "refers").mapInArrow(run, "record binary")
    # The text writer puts out the bytes of a string as they are.
    writer = records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path)


def _parse(header: bytes, block: bytes) -> tuple:
    lines = header.decode("utf-8", "replace").split("\r\n")
    fields: dict[str, list[str]] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), []).append(value.strip())
    one = lambda name: fields.get(name, [None])[0]
    kind, payload, status = one("warc-type"), block, None
    if (one("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(END)
        if kind in ("response", "revisit"):
            status = int(head.split(b" ", 2)[1])
    if kind == "revisit":
        payload = None
    declared = (one("warc-payload-digest") or "").partition(":")[2] or None
    # The digest of a payload at hand is taken anew; a revisit has only the stated one.
    found = digest(payload) if kind == "response" else declared
    if kind == "response" and declared not in (None, found):
        raise ValueError(f"payload of {one('warc-record-id')} does not match its digest")
    size = len(payload) if kind == "response" else one("x-payload-length")
    number = lambda x: None if x is None else int(x)
    return (one("warc-record-id"), kind, fields.get("warc-concurrent-to", []), one("warc-refers-to"), number(one("x-refers-to-page-id")), one("warc-target-uri"), one("warc-date"), number(one("x-page-id")), found, number(size), one("content-type"), status, payload)


def records_of(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple]:
    """Records from the pieces of files, in order, that lie between separators."""
    file, stream, header, length = None, bytearray(), None, 0

    def ended() -> None:
        # The reader cannot tell whether a separator follows the last piece.
        if header is not None or bytes(stream) not in (b"", END):
            raise ValueError(f"{file} ends inside a record")

    for name, piece in pieces:
        if name != file:
            ended()
            file, header = name, None
            stream.clear()
        stream += piece
        stream += END
        while True:
            if header is None:
                if not stream.startswith(VERSION) or (at := stream.find(END)) < 0:
                    break
                header = bytes(stream[:at])
                del stream[: at + len(END)]
                length = next(int(x.partition(b":")[2]) for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            if len(stream) < length + len(END):
                break
            if stream[length : length + len(END)] != END:
                raise ValueError(f"{file}: a record does not end where its length says")
            yield _parse(header, bytes(stream[:length]))
            del stream[: length + len(END)]
            header = None
    ended()


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in the folder `path`. Digest and length are those of the whole payload
    read; without `payloads` the payload itself is left behind."""
    lines = spark.read.option("lineSep", END.decode()).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        rows, size = [], 0
        for row in records_of(pieces):
            rows.append(row if payloads else (*row[:-1], None))
            size += len(row[-1] or b"") if payloads else 1 << 10
            if size > 4 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    return lines.mapInArrow(run, _READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=pa.schema(_FIELDS))


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit, with its request and its metadata records nested. Records that name no
    capture, directly or by way of one other record, are left out."""
    main = records.where(F.col("record_type").isin("response", "revisit"))
    side = records.where(F.col("record_type").isin("request", "metadata")).select("record_id", "record_type", F.explode("concurrent_to").alias("to"), "uri", "date", "content_type", "payload")
    names = records.select(F.col("record_id").alias("to"), F.col("concurrent_to").alias("next"), F.col("record_type").isin("response", "revisit").alias("is_capture"))
    # What a record names is a capture, or names one itself.
    targets = names.select("to", F.explode(F.when(F.col("is_capture"), F.array("to")).otherwise(F.col("next"))).alias("capture"))
    nested = F.struct("record_id", "uri", "date", "content_type", "payload")
    found = side.join(targets, "to").groupBy("capture").agg(
        F.min(F.when(F.col("record_type") == "request", nested)).alias("request"),
        F.array_sort(F.collect_set(F.when(F.col("record_type") == "metadata", nested))).alias("metadata"),
    )
    return main.join(found, main["record_id"] == found["capture"], "left").drop("capture", "concurrent_to")
