"""WARC archives: writing records, resolving revisits by payload digest, reading archives back.

Only headers are grouped by digest (with partial sums before the shuffle); a digest that holds a third of all records
is looked up by broadcast, see runtime.lookup. Archives are written by Spark's text writer, so the commit protocol
covers lost executors; a gzip file holds whole records, at most RECORDS_PER_FILE.

A null payload is an empty one. Records with equal payloads of at least `least` bytes share one response, that with
the largest page_id; the others become revisit records. Rows with that same largest page_id are the same page and all
stay responses; a null page_id never becomes a group's response unless all of them are null. Repeated rows are records
of their own, each with its own id. URLs lose control characters; a null URL writes no WARC-Target-URI. An empty table
gives archives without records.

Archives are deduplicated by joining what they hold: revisit records of a source join the responses of their payload
digest, like records with that payload. Every source record stays: a revisit whose response isn't in the source keeps the
reference it has. Payloads are written byte by byte, whether or not they are UTF-8.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import lookup, scratch_path, written

RECORDS_PER_FILE = 1000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: five hex digits at a time make four letters."""
    letters = []
    for k in range(8):
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_id of every row."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    url = F.regexp_replace(url_col, r"[\x00-\x20\x7f]+", "%20").alias("url")
    out = pages.select(F.col(id_col).alias("page_id"), url, payload.alias("payload"), F.monotonically_increasing_id().alias("__row"))
    # The hash is a column of its own: as a part of the digest's expression it would be made once for each letter.
    out = out.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "__sha1": F.sha1("payload")})
    out = out.withColumn("payload_digest", base32_of_hex(F.col("__sha1"))).drop("__sha1")
    return out.withColumn("record_id", _record_id()).drop("__row")


def _record_id() -> Column:
    name = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), "url", "payload_digest", F.col("__row").cast("string")))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def resolved(recs: DataFrame, least: int = 0) -> DataFrame:
    """recs with refers_to, refers_to_id and refers_to_url: of revisits the response's, else null. Records whose payload
    is null (revisits of a source) aren't a response."""
    head = F.when(F.col("page_id").isNotNull() & F.col("payload").isNotNull(), F.struct("page_id", "record_id", "url"))
    first = (
        recs.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max(head).alias("first"), F.count("*").alias("records"))
        .where("records > 1 AND first IS NOT NULL")
    )
    first = written(first, "responses")
    out = lookup(recs, "payload_digest", first, "records", F.col("record_id"))
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= least) & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    for name, of in (("refers_to", "page_id"), ("refers_to_id", "record_id"), ("refers_to_url", "url")):
        out = out.withColumn(name, F.when(revisit, F.col(f"first.{of}")))
    return out.drop("first")


def _field(name: str, value: Column, around: tuple[str, str] = ("", "")) -> Column:
    """A header line, or nothing where the value is null."""
    line = F.concat(F.lit(f"{name}: {around[0]}"), value.cast("string"), F.lit(around[1] + EOL))
    return F.coalesce(line, F.lit(""))


def record_text(date: str) -> Column:
    """The record without its last line end, which the writer adds."""
    revisit = F.col("revisit")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL * 2))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))  # the same bytes
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.col("record_id"), ("<", ">")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.col("payload_digest"), ("sha1:", "")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.col("refers_to_id")), ("<", ">")),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_url"))),
        _field("X-Page-ID", F.col("page_id")),
        _field("X-Refers-To-Page-ID", F.col("refers_to")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(http) + F.octet_length(body)),
        F.lit(EOL),
        http,
        body,
        F.lit(EOL),
    )


def write(recs: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes resolved records as gzipped archives with fresh headers."""
    recs = recs if "revisit" in recs.columns else recs.withColumn("revisit", F.col("refers_to").isNotNull())
    writer = recs.select(record_text(date).alias("value")).write
    writer.option("lineSep", EOL).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers and block of every record of an archive's bytes."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:end].decode().split(EOL)[1:] if ": " in x)
        start = end + 4
        at = start + int(fields["Content-Length"])
        yield fields, data[start:at]


def _rows(content: bytes, with_payload: bool) -> Iterator[dict]:
    for fields, block in parse(gzip.decompress(content)):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = dict(x.split(": ", 1) for x in head.decode().split(EOL)[1:])
        response = fields["WARC-Type"] == "response"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else fields["WARC-Payload-Digest"].removeprefix("sha1:")
        yield {
            "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
            "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"],
            "record_id": fields["WARC-Record-ID"].strip("<>"),
            "payload_digest": digest,
            "payload_bytes": len(payload) if response else int(http["Content-Length"]),
            "refers_to": int(fields["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in fields else None,
            "refers_to_id": fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None,
            "payload": payload if response and with_payload else None,
        }


READ_SCHEMA = "page_id long, url string, record_type string, record_id string, payload_digest string, payload_bytes long, refers_to long, refers_to_id string, payload binary"
ARROW_SCHEMA = pa.schema(
    [("page_id", pa.int64()), *((c, pa.string()) for c in ("url", "record_type", "record_id", "payload_digest"))]
    + [("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()), ("payload", pa.binary())]
)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record. A response's digest and size are those of the bytes read, a revisit's are its headers'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in _rows(content.as_py(), with_payload):
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, READ_SCHEMA)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes pages to deduplicated archives under path (the shared folder by default) and reads them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(resolved(records(pages)), path)
    return read(spark, path, with_payload=False)


def deduplicated(spark: SparkSession, source: str, target: str) -> None:
    """Archives at source, rewritten to target with fresh headers, one record for each of theirs: equal payloads are there once."""
    found = read(spark, source).withColumn("__row", F.monotonically_increasing_id())
    # Written once: the records' new ids must be the same wherever they are used.
    recs = written(found.withColumn("old_id", F.col("record_id")).withColumn("record_id", _record_id()).drop("__row"), "source")
    old = recs.select("old_id", F.col("refers_to").alias("its_page"), F.col("refers_to_id").alias("its_id"), "record_id")
    out = resolved(recs.drop("refers_to", "refers_to_id", "old_id", "record_type"))
    # Revisits that found no response keep the reference they had.
    lost = F.col("payload").isNull() & F.col("refers_to_id").isNull()
    out = out.join(old.where("its_id IS NOT NULL").select("record_id", "its_page", "its_id"), "record_id", "left")
    out = out.withColumn("revisit", F.col("refers_to_id").isNotNull() | F.col("payload").isNull())
    out = out.withColumns({"refers_to": F.when(lost, F.col("its_page")).otherwise(F.col("refers_to")), "refers_to_id": F.when(lost, F.col("its_id")).otherwise(F.col("refers_to_id"))})
    write(out.drop("its_page", "its_id"), target)
