"""WARC archives with revisit records.

``write_raw`` writes one response record per page; ``resolve`` reads archives,
shuffles record headers by payload digest, joins records to the original
response of their digest and writes deduplicated archives with fresh headers;
``read`` turns archives into a table of records.  Of records with equal payloads
of at least ``min_bytes`` bytes the one of smallest id is the original; the
others become revisit records without payload that name it.

Cases: a null payload is an empty one; payloads below the limit, empty ones
included, are all responses; a null id or URL is written as an empty field and
read back as null; rows that repeat id and payload are told apart by their place
in the archives, and one of them is the response; payloads of any length and
content are framed by their length, so they may hold anything that looks like a
header; an empty table gives an empty archive; extra columns are not archived.

Archives are written by Spark's text writer with the record separator as line
end, and read as whole files that a task parses in turn.  Their size is bounded:
a task starts a new one after as many records as make up ``file_bytes`` on
average, so nothing is moved for it.  Archives are gzip files.  Headers only, never payloads, are shuffled by digest.
A digest that many records share is resolved by a broadcast of the hot digests,
of which there are ``1 / HOT_SHARE`` at most; all other digests meet in a
shuffle join.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postwright.llm.common import small_side, stage
from postwright.session import work_path

#: Payloads shorter than this are never revisits.
MIN_BYTES = 100
#: Payload bytes of an archive on average.
FILE_BYTES = 32 << 20
#: A digest with this share of all records is hot.
HOT_SHARE = 1 / 1024

END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

FIELDS = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint"
)


def _line(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit("\r\n"))


def _urn(page) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def record_text() -> F.Column:
    """A whole record, but for the separator, from the columns of a record table and ``payload``.

    Lengths are bytes.  A revisit carries the HTTP head only.
    """
    revisit = F.col("record_type") == "revisit"
    head = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("X-Payload-Length", F.col("payload_bytes")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Refers-To", _urn(F.col("refers_to"))),
                _line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def write(records: DataFrame, path: str, file_records: int) -> None:
    """Write a table of records as archives; the text writer ends each with the separator."""
    (
        records.select(record_text().alias("value"))
        .write.option("lineSep", END).option("compression", "gzip")
        .option("maxRecordsPerFile", file_records).mode("overwrite").text(path)
    )


def records_per_file(sizes: DataFrame, column: str, file_bytes: int) -> int:
    """How many records make up ``file_bytes`` on average."""
    mean = sizes.agg(F.avg(F.coalesce(F.col(column), F.lit(0))).alias("m")).first()["m"] or 0
    return max(1, int(file_bytes // (mean + 400)))


def write_raw(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    file_bytes: int = FILE_BYTES,
) -> None:
    """One response record per page."""
    payload = F.coalesce(F.col(html), F.lit(""))
    source = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        payload.alias("payload"),
    )
    records = source.select(
        "*", F.lit("response").alias("record_type"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    sizes = pages.select(F.octet_length(html).alias("b"))
    write(records, path, records_per_file(sizes, "b", file_bytes))


def _number(urn: bytes) -> int | None:
    digits = urn.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits else None


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes, int]]:
    """(header fields, payload, offset) of each record of an archive, framed by lengths."""
    at, size = 0, len(data)
    while at < size:
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].split(b"\r\n")[1:]
        fields = dict(x.split(b": ", 1) for x in lines)
        start = stop + 4
        end = start + int(fields[b"Content-Length"])
        body = data.index(b"\r\n\r\n", start, end) + 4
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[body:end], at
        at = end + 4


def read(spark: SparkSession, path: str, payload: bool = True, check: bool = True) -> DataFrame:
    """Records of the archives under a path: FIELDS, file, offset and, if asked for, payload.

    The payload of each response is held against its digest and length.
    """
    schema = T.StructType.fromDDL(
        FIELDS + ", file string, offset bigint" + (", payload string" if payload else "")
    )
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for place in range(batch.num_rows):
                name = batch.column(0)[place].as_py()
                data = zlib.decompress(batch.column(1)[place].as_py(), 31)
                rows, held = [], 0
                for row in _rows(data, name, payload, check):
                    rows.append(row)
                    held += len(row.get("payload", "")) + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=target)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=target)

    return files.mapInArrow(run, schema)


def _rows(data: bytes, name: str, payload: bool, check: bool) -> Iterator[dict]:
    for fields, body, offset in parse(data):
        kind = fields[b"WARC-Type"].decode()
        digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
        length = int(fields[b"X-Payload-Length"])
        if check and kind == "response":
            if hashlib.sha256(body).hexdigest() != digest or len(body) != length:
                raise ValueError(f"{name}: the record at byte {offset} is damaged")
        row = {
            "page_id": _number(fields[b"WARC-Record-ID"]),
            "url": fields[b"WARC-Target-URI"].decode("utf-8", "replace") or None,
            "record_type": kind,
            "payload_bytes": length,
            "payload_digest": digest,
            "refers_to": _number(fields[b"WARC-Refers-To"]) if kind == "revisit" else None,
            "file": name,
            "offset": offset,
        }
        if payload:
            row["payload"] = body.decode("utf-8")
        yield row


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The original of each digest that several records share, with their number."""
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "file", "offset"))
    return (
        headers.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest").agg(first.alias("o"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            F.col("payload_digest").alias("o_digest"), F.col("o.page_id").alias("o_page"),
            F.col("o.file").alias("o_file"), F.col("o.offset").alias("o_offset"), "n",
        )
    )


def resolve(
    spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write the archives under ``source`` anew, repeated payloads as revisit records."""
    headers = stage(
        read(spark, source, payload=False).select(
            "page_id", "payload_digest", "payload_bytes", "file", "offset"
        ),
        "headers",
    )
    found = stage(originals(headers, min_bytes), "originals")
    hot = found.filter(F.col("n") >= F.lit(max(2.0, headers.count() * HOT_SHARE)))
    cold = found.join(F.broadcast(hot.select("o_digest")), "o_digest", "left_anti")
    is_hot = F.col("h_digest").isNotNull()
    marked = headers.join(
        F.broadcast(hot.select(
            F.col("o_digest").alias("h_digest"), F.col("o_page").alias("h_page"),
            F.col("o_file").alias("h_file"), F.col("o_offset").alias("h_offset"),
        )),
        F.col("payload_digest") == F.col("h_digest"), "left",
    )
    by_hot = marked.filter(is_hot).select(
        "file", "offset", "h_page", "h_file", "h_offset"
    )
    by_cold = marked.filter(~is_hot).join(
        cold, F.col("payload_digest") == F.col("o_digest")
    ).select("file", "offset", "o_page", "o_file", "o_offset")
    again = by_hot.union(by_cold).toDF("file", "offset", "o_page", "o_file", "o_offset").filter(
        (F.col("file") != F.col("o_file")) | (F.col("offset") != F.col("o_offset"))
    )
    # back to the archives: which record, named by file and offset, revisits which page
    listed = stage(again.select("file", "offset", "o_page", F.lit(True).alias("again")), "revisits")
    records = read(spark, source, check=False).drop("refers_to", "record_type")
    width = 24 + (listed.agg(F.max(F.length("file")).alias("w")).first()["w"] or 0)
    joined = records.join(small_side(listed, width), ["file", "offset"], "left")
    write(
        joined.withColumn(
            "record_type", F.when(F.col("again"), "revisit").otherwise("response")
        ).withColumn("refers_to", F.col("o_page")),
        target,
        records_per_file(headers, "payload_bytes", file_bytes),
    )


def archive(
    pages: DataFrame, raw: str | None = None, target: str | None = None,
    min_bytes: int = MIN_BYTES, **names: str,
) -> DataFrame:
    """Write pages as raw and as deduplicated archives and return the records read back."""
    spark = pages.sparkSession
    base = work_path(spark, f"warc-{uuid.uuid4().hex}")
    raw, target = raw or f"{base}/raw", target or f"{base}/deduplicated"
    write_raw(pages, raw, **names)
    resolve(spark, raw, target, min_bytes)
    return read(spark, target, payload=False)
