"""WARC archives without repeated payloads.

Headers are shuffled by payload digest to find the original of each payload; a
record whose payload has another original becomes a revisit record without
payload. Archives are written by Spark's own writer (committed per task, on any
file system) and read back by a parser that follows Content-Length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.session import scratch_path

#: Fixed values of WARC/1.1.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BETWEEN = "\r\n\r\n"

DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1: 20 bits (five hex digits, four base32 digits) at a time."""
    sha = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def resolve(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of ``least_bytes`` or more the largest id is the response,
    the others revisit it; rows that share the largest id are all responses.
    Only headers (id, digest, length) are aggregated; payloads meet the originals
    in one join on the digest, whose hot keys adaptive execution splits. A null
    page is an empty payload. Rows without an id stand behind all others; if no
    row with a payload has one, all are responses.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                         payload_digest(payload).alias("payload_digest"))
    originals = (pages.where(F.col("payload_bytes") >= least_bytes)
                 .groupBy("payload_digest", "payload_bytes")
                 .agg(F.max("page_id").alias("_original"), F.count(F.lit(1)).alias("_copies"))
                 .where((F.col("_copies") > 1) & F.col("_original").isNotNull())
                 .select("payload_digest", "payload_bytes", "_original"))
    revisit = F.col("_original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_original"))
    return (pages.join(originals, ["payload_digest", "payload_bytes"], "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_original"))).drop("_original"))


def records(resolved: DataFrame, date: str) -> DataFrame:
    """One text per record: fresh headers and, of responses, the HTTP block."""
    end = "\r\n"

    def record_id(page: Column, digest: Column) -> Column:
        h = F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("-")), digest))
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                                                         F.substring(h, 13, 4), F.substring(h, 17, 4),
                                                         F.substring(h, 21, 12)), F.lit(">"))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(end))).otherwise(F.lit(""))

    revisit = F.col("record_type") == "revisit"
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(end + end))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(VERSION + end), field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))), field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", url), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to"), F.col("payload_digest")))),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("X-Page-ID", F.col("page_id").cast("string")), field("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length("_block").cast("string")), F.lit(end))
    return resolved.withColumn("_block", block).select(F.concat(head, F.col("_block")).alias("value"))


def write(resolved: DataFrame, path: str, date: str, records_per_file: int = 4000) -> None:
    """Gzip-compressed archives of at most ``records_per_file`` records.

    A record ends in two empty lines, which are the writer's line separator.
    """
    (records(resolved, date).write.option("lineSep", BETWEEN).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream; only one record is held at a time."""
    held = bytearray()
    chunks = iter(chunks)

    def fill(until) -> bool:
        while not until():
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    mark = BETWEEN.encode()
    while fill(lambda: mark in held):
        head = bytes(held[:held.index(mark)])
        first, *lines = head.decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"not a record: {first[:40]}")
        fields = dict(x.split(": ", 1) for x in lines)
        start = len(head) + 4
        stop = start + int(fields["Content-Length"])
        if not fill(lambda: len(held) >= stop + 4) or held[stop:stop + 4] != mark:
            raise ValueError(f"record {fields['WARC-Record-ID']} is cut off")
        yield fields, bytes(held[start:stop])
        del held[:stop + 4]
    if held:
        raise ValueError("bytes behind the last record")


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row per record of the archives under ``path``.

    page_id, payload_bytes, payload_digest, record_type, refers_to and, of
    responses, the payload; digest and length of a response are checked against
    its payload. Files are split among tasks, and unpacked as a stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        from hashlib import sha1

        def unpacked(data: pa.Buffer) -> Iterator[bytes]:
            z = zlib.decompressobj(31)
            for i in range(0, len(data), 1 << 16):
                yield z.decompress(data[i:i + (1 << 16)])
            yield z.flush()

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              names=names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in parse(unpacked(content.as_buffer())):
                    http, _, payload = block.partition(BETWEEN.encode())
                    n = int(http.rpartition(b"Content-Length: ")[2])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = fields["WARC-Type"] == "response"
                    if response and (n != len(payload) or base64.b32encode(sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
                    rows.append((fields.get("X-Page-ID"), n, digest, fields["WARC-Type"], fields.get("X-Refers-To-Page-ID"),
                                 payload.decode() if response else None))
                    size += len(payload)
                    if size > 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    out = files.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, "
                                "refers_to string, payload string")
    return out.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive(spark: SparkSession, pages: DataFrame, date: str, least_bytes: int = 0) -> DataFrame:
    """Writes the pages' archives into the shared folder and reads them back (see :func:`resolve`, :func:`read`)."""
    path = scratch_path(spark, "llm-warc")
    write(resolve(pages, least_bytes), path, date)
    return read(spark, path, pages.schema["page_id"].dataType.simpleString())
