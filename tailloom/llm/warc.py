"""WARC archives: segmented, chunk-framed records written and reassembled.

``write`` puts each page into an archive as an HTTP response whose body is
framed in chunks; responses over ``segment_bytes`` are cut into a first record
and continuation records.  Of pages with equal payloads of at least
``dedup_bytes`` the one with the smallest page_id is a response, others are
revisit records that refer to it.  ``read`` splits archives at record starts, so
they are read in parallel; ``reassemble`` groups continuation records by their
origin, orders them by segment number, verifies numbers and total length, and
decodes the chunked framing.

The writer ends a chunk within any text that looks like a record start, so the
separator never occurs inside a record of its own.  In a foreign archive (of WARC/1.0
or 1.1, read by one separator each) a record that holds one is cut there: its first part
and the rest are rows with an ``error``, as are truncated records, missing segments,
continuations without an origin, records of another type and broken framing; nothing is
dropped silently.

Defined results: null html counts as empty; a null page_id is kept, never
referred to, and a revisit if a payload's smallest page_id isn't null; wholly
repeated rows of the smallest page_id are responses each; a null url is empty;
empty tables give an empty archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, scratch, small_batches, written

VERSION = b"WARC/1.1"
SEGMENT_BYTES, CHUNK_BYTES, DEDUP_BYTES = 1 << 12, 1 << 13, 100
_DATE = "2020-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def _cuts(data: bytes, size: int) -> list[int]:
    """Ends of pieces of about that size which don't split a character."""
    cuts, at = [], size
    while at < len(data):
        while data[at] & 0xC0 == 0x80:
            at -= 1
        cuts.append(at)
        at += size
    return [*cuts, len(data)]


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    ends = {*_cuts(payload, size), *(m.start() + 4 for m in re.finditer(re.escape(VERSION), payload))}
    framed, begin = [], 0
    for end in sorted(ends):
        if end > begin:
            framed.append(b"%x\r\n%b\r\n" % (end - begin, payload[begin:end]))
        begin = end
    return b"".join(framed) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload in a chunked transfer framing."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(body[at : at + size])
        at += size + 2


def _record(headers: dict[str, object], block: bytes = b"") -> bytes:
    """One record, without the last line end, which the writer of lines adds."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + b"\r\n" + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r"


def records_of(page_id: int | None, url: str | None, html: str | None, origin: int | None, unique: str, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of a page; origin: the page that it revisits."""
    payload = (html or "").encode()
    common = {"WARC-Date": _DATE, "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~"), "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}", "X-Page-Id": page_id}
    name = f"<urn:page:{unique}>"
    if origin is not None:
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": name, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page-Id": origin, **common})
        return
    block = _HTTP + chunked(payload)
    kind = {"Content-Type": "application/http;msgtype=response"}
    if len(block) <= segment_bytes:
        yield _record({"WARC-Type": "response", "WARC-Record-ID": name, **common, **kind}, block)
        return
    begin, ends = 0, _cuts(block, segment_bytes)
    for k, end in enumerate(ends, 1):
        part, begin = block[begin:end], end
        if k == 1:
            yield _record({"WARC-Type": "response", "WARC-Record-ID": name, **common, **kind, "WARC-Segment-Number": 1}, part)
        else:
            total = len(block) if k == len(ends) else None
            yield _record({"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:page:{unique}:{k}>", "WARC-Date": _DATE, "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": k, "WARC-Segment-Total-Length": total}, part)


def write(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, dedup_bytes: int = DEDUP_BYTES) -> None:
    """Archives of pages (page_id, url, html) under path, one for each partition."""
    small_batches(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    long = F.octet_length(html) >= dedup_bytes
    pages = pages.select("page_id", "url", html.alias("html"), F.when(long, F.sha2(html, 256)).alias("digest"))
    # only digests that occur more than once; written, so that Spark knows their size and need not shuffle
    # the pages where it is under the broadcast threshold
    firsts = pages.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    firsts = written(firsts)
    origin = F.when(F.col("first") == F.col("page_id"), F.lit(None)).otherwise(F.col("first"))
    with_origin = pages.join(firsts, "digest", "left").select("page_id", "url", "html", origin.alias("origin"))
    schema = pa.schema([("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            task, n = TaskContext.get().partitionId(), 0
            for batch in batches:
                for page_id, url, html, origin in zip(*(c.to_pylist() for c in batch.columns)):
                    n += 1
                    for record in records_of(page_id, url, html, origin, f"{page_id}:{task}:{n}", segment_bytes):
                        yield (record,)

        yield from arrow_rows(schema, rows(), block=1024)

    records = with_origin.mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


RECORD = pa.schema([("type", pa.string()), ("id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("segment", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary()), ("error", pa.string())])
RECORD_SQL = "type string, id string, page_id long, url string, refers_to long, digest string, segment int, origin string, total long, block binary, error string"


def parse(raw: bytes) -> tuple:
    """Fields of a record from what follows its version line."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    of = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n"))}
    number = lambda name: int(of[name]) if re.fullmatch(r"-?\d{1,18}", of.get(name, "")) else None
    length = number("content-length")
    error = None if length is not None and rest[length:] == b"\r\n\r\n" else "content length"
    block = rest[: length or 0]
    return of.get("warc-type"), of.get("warc-record-id"), number("x-page-id"), of.get("warc-target-uri"), number("x-refers-to-page-id"), of.get("warc-payload-digest", "").rpartition(":")[2], number("warc-segment-number"), of.get("warc-segment-origin-id"), number("warc-segment-total-length"), block, error


def read(spark: SparkSession, path: str, version: str = VERSION.decode()) -> DataFrame:
    """Records of the archives under path, whose records begin with that version line."""
    small_batches(spark)
    lines = spark.read.option("lineSep", version + "\r\n").text(path).where(F.length("value") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from arrow_rows(RECORD, map(parse, batch.column(0).to_pylist()))

    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORD_SQL)


PAGE = pa.schema([("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])
PAGE_SQL = "type string, page_id long, url string, refers_to long, digest string, payload binary, error string"


def _whole(total: int | None, segments: list[dict]) -> tuple[bytes, str | None]:
    block = b"".join(s["block"] for s in segments)
    if [s["segment"] for s in segments] != list(range(1, len(segments) + 1)):
        return block, "segments missing"
    return block, None if total == len(block) else "total length"


def _payload(block: bytes) -> tuple[bytes, str | None]:
    head, _, body = block.partition(b"\r\n\r\n")
    try:
        return (dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body), None
    except ValueError:
        return b"", "chunked framing"


def reassemble(records: DataFrame) -> DataFrame:
    """A row for each whole record and each group of segments: type, page_id, url, refers_to, digest, payload, error.

    Only segmented records are shuffled; a group is one response's records.  Continuations without a first
    record are a row of type continuation with an error; so is any record that is neither response nor revisit.
    """
    small_batches(records.sparkSession)
    meta = ("type", "page_id", "url", "refers_to", "digest")
    whole = records.where("segment is null").select(*meta, F.lit(None).cast("long").alias("total"), F.array(F.struct(F.lit(1).alias("segment"), "block")).alias("segments"), "error")
    parts = records.where("segment is not null").groupBy(F.coalesce("origin", "id").alias("of"))
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = parts.agg(F.coalesce(F.max(F.when(F.col("segment") == 1, F.col("type"))), F.lit("continuation")).alias("type"), *map(first, meta[1:]), F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("segments"), F.max("error").alias("error"))
    parted = grouped.select(*meta, F.coalesce("total", F.lit(-1)).alias("total"), "segments", "error")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for type_, page_id, url, refers_to, digest, total, segments, error in zip(*(c.to_pylist() for c in batch.columns)):
                    block, wrong = (segments[0]["block"], None) if total is None else _whole(total, segments)
                    payload, broken = _payload(block) if type_ == "response" else (None, None)
                    if type_ not in ("response", "revisit"):
                        broken = "origin missing" if type_ == "continuation" else "record type"
                    if payload is not None and not (error or wrong or broken) and hashlib.sha256(payload).hexdigest() != digest:
                        broken = "digest"
                    yield type_, page_id, url, refers_to, digest, payload, error or wrong or broken

        yield from arrow_rows(PAGE, rows(), block=1024)

    return whole.union(parted).mapInArrow(run, PAGE_SQL)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and error of every record, from archives written and read back.

    The archives are parsed once.  A revisit's bytes are those of the response that it refers to.
    """
    spark, path = pages.sparkSession, scratch(pages.sparkSession)
    write(pages, path)
    found = reassemble(read(spark, path)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    found = written(found.withColumn("payload_digest", F.coalesce(F.sha2("payload", 256), "digest")).drop("payload", "url", "digest"))
    revisits = found.where("type = 'revisit'").drop("payload_bytes")
    origins = revisits.select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    stored = found.where("type = 'response'").join(origins, ["page_id", "payload_digest"]).groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = revisits.join(stored.withColumnRenamed("page_id", "refers_to"), ["refers_to", "payload_digest"], "left")
    columns = lambda df, error: df.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", error.alias("error"))
    missing = F.coalesce("error", F.when(F.col("payload_bytes").isNull(), "origin missing"))
    return columns(found.where("type is null or type <> 'revisit'"), F.col("error")).union(columns(revisits, missing))
