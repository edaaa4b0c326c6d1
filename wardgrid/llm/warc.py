"""Web captures as WARC archives, and assembly of their records into one row per capture.

A capture is written as three records: the request, the response (or, for a payload that another capture
answers for, a revisit without a body), and metadata. The last two name the response in WARC-Concurrent-To.
Archives are written by Spark's own text writer with the record terminator between records, so tasks commit
as for any table and the files may lie in any store that Spark writes to; they are read whole, cut at the
stated Content-Length, never at marks that a payload may contain. `RECORDS_TOGETHER` bounds a file. Assembly
joins request, response and metadata records by the identifiers they carry; payload sizes of revisits come
from the responses they refer to.

Of captures with equal payloads of at least `LEAST_SHARED` bytes, that with the largest page_id is the
response; if several rows have that id, each is a response, and revisits refer to that id. A null payload is
empty, a null url is written as an empty target. A row without page_id is written too and comes back without
one; it never answers for others unless none of its copies has an id. Line breaks in a url are dropped from
the header. Repeated rows are alike in their identifiers too and come back as often as they occur. Payloads that contain
WARC records, of any length, come back as they were. Empty tables make empty archives. Other columns do not
pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import common
from wardgrid.session import shared_folder

LEAST_SHARED = 1000
RECORDS_TOGETHER = 6000
END = "\r\n\r\n"
RECORD = "record_id string, record_type string, page_id long, concurrent_to string, refers_to string, target string, digest string, length long, payload binary"


def plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, capture, record_type, answer, request, metadata) for each capture, its
    records' identifiers among them; `answer` is the response that a revisit refers to."""
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    named = named.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "check": F.xxhash64("html")})
    # of each large payload the row with the largest id; rows without an id come last
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url")).alias("best")
    large = named.filter(F.octet_length("html") >= LEAST_SHARED).groupBy("digest", "check").agg(best, F.count("*").alias("copies"))
    shared = common.stored(large.filter("copies > 1").select("digest", "check", "best"), "shared")
    joined = named.join(shared, ["digest", "check"], "left")
    answers = F.when(F.col("best.known"), F.col("page_id").eqNullSafe(F.col("best.page_id"))).otherwise(F.col("url") == F.col("best.url"))
    revisit = F.col("best").isNotNull() & ~answers
    return joined.select(
        "page_id",
        "url",
        "html",
        "digest",
        identifier("response", F.col("page_id"), F.col("url"), F.col("digest")).alias("capture"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, identifier("response", F.col("best.page_id"), F.col("best.url"), F.col("digest"))).alias("answer"),
        identifier("request", F.col("page_id"), F.col("url"), F.col("digest")).alias("request"),
        identifier("metadata", F.col("page_id"), F.col("url"), F.col("digest")).alias("metadata"),
    )


def identifier(kind: str, page_id: Column, url: Column, digest: Column) -> Column:
    """A record id from what the record holds, the same whenever it is computed."""
    named = F.md5(F.concat_ws(" ", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("none")), digest, url).cast("binary"))
    parts = [F.substring(named, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, record_id: Column, target: Column, block: Column, more: list[tuple[str, Column]]) -> Column:
    lines = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit("2024-01-01T00:00:00Z")), ("WARC-Target-URI", target), *more, ("Content-Length", F.octet_length(block).cast("string"))]
    header = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in lines])
    return F.concat(header, F.lit(END), block)


def write(captures: DataFrame, path: str) -> None:
    """The captures' records in files under `path`."""
    target = F.regexp_replace("url", r"[\r\n]+", "")
    digest = F.concat(F.lit("sha1:"), F.upper("digest"))
    page = ("WARC-Page-Id", F.col("page_id").cast("string"))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), "html")
    response = _record("response", F.col("capture"), target, answer, [page, ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http; msgtype=response"))])
    revisit = _record("revisit", F.col("capture"), target, F.lit("HTTP/1.1 200 OK\r\n\r\n"), [page, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.col("answer")), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))])
    request = _record("request", F.col("request"), target, F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\n\r\n")), [("WARC-Concurrent-To", F.col("capture")), ("Content-Type", F.lit("application/http; msgtype=request"))])
    metadata = _record("metadata", F.col("metadata"), target, F.concat(F.lit("via: "), target), [("WARC-Concurrent-To", F.col("capture")), ("Content-Type", F.lit("application/warc-fields"))])
    records = captures.select(F.explode(F.array(request, F.when(F.col("record_type") == "response", response).otherwise(revisit), metadata)).alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_TOGETHER).option("compression", "gzip").text(path)


def _unpacked(content: bytes) -> bytes:
    """A file's bytes; gzip files may have one member for all records or one each."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest:
        member = zlib.decompressobj(31)
        out.append(member.decompress(rest))
        rest = member.unused_data
    return b"".join(out)


def parsed(content: bytes, keep_payload: bool = True) -> Iterator[tuple]:
    """The records of an archive, as rows of `RECORD`. Cut at Content-Length; what follows a broken header
    is skipped up to the next record."""
    at = 0
    while (at := content.find(b"WARC/1.", at)) >= 0:
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].split(b"\r\n")[1:] if end > 0 else []
        fields = {k.strip().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines)}
        if not fields.get(b"content-length", "").isdigit():
            at += 7
            continue
        begin = end + 4
        block = content[begin : begin + int(fields[b"content-length"])]
        at = begin + len(block)
        payload = block
        if fields.get(b"warc-type") in ("response", "revisit"):
            payload = block[block.find(b"\r\n\r\n") + 4 :]
        whole = fields.get(b"warc-type") == "response"
        digest = hashlib.sha1(payload).hexdigest() if whole else fields.get(b"warc-payload-digest", "").removeprefix("sha1:").lower() or None
        page = fields.get(b"warc-page-id")
        yield (fields.get(b"warc-record-id"), fields.get(b"warc-type"), int(page) if page else None, fields.get(b"warc-concurrent-to"), fields.get(b"warc-refers-to"), fields.get(b"warc-target-uri"), digest, len(payload), payload if keep_payload else None)


def read(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The records of all archives under `path`, as `RECORD`."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for row in parsed(_unpacked(content.as_py()), keep_payload):
                    rows.append(row)
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(records, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit with the request and metadata that are concurrent to it,
    nested, and for a revisit the page and size of the response it refers to. A capture without a request or
    metadata record has null there; request or metadata records of no capture are left out."""
    captures = records.filter(F.col("record_type").isin("response", "revisit"))
    beside = records.filter("concurrent_to is not null")
    one = F.struct("record_id", "target", "length")
    nested = beside.groupBy("concurrent_to").agg(
        F.min(F.when(F.col("record_type") == "request", one)).alias("request"),
        F.min(F.when(F.col("record_type") == "metadata", one)).alias("metadata"),
    )
    answers = captures.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(F.max("page_id").alias("refers_to_page"), F.max("length").alias("answer_length"))
    joined = captures.drop("concurrent_to").join(nested.withColumnRenamed("concurrent_to", "record_id"), "record_id", "left")
    whole = joined.filter("refers_to is null").withColumns({"refers_to_page": F.lit(None).cast("long"), "answer_length": F.lit(None).cast("long")})
    referring = joined.filter("refers_to is not null").join(answers, "refers_to", "left")
    return whole.unionByName(referring).select(
        "record_id", "record_type", "page_id", "target", "digest", F.coalesce("answer_length", "length").alias("payload_bytes"), "refers_to_page", "request", "metadata", "payload"
    )


def archive(pages: DataFrame) -> str:
    """Write the captures of `pages` as archives in the shared folder; the folder's path."""
    path = shared_folder(pages.sparkSession, "warc")
    write(plan(pages), path)
    return path
