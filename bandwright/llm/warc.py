"""WARC archives: write pages as transactions, read records back, and put the transactions together again.

A page becomes three records: a request, a response (or a revisit, where another page has the same payload) and a
metadata record. Request and metadata name the response in WARC-Concurrent-To; by that identifier reading joins them.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import BROADCAST_BYTES, package_on_workers, shielded, staged

LEAST_SHARED = 1000
#: Text bytes per archive file aimed at; a file is decompressed record by record.
FILE_BYTES = 32 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
END = CRLF + CRLF
_BATCH_ROWS, _BATCH_BYTES = 512, 4 * 1024 * 1024

RECORD = (
    "record_id string, type string, target_uri string, date string, concurrent_to string, refers_to string, "
    "declared_digest string, payload_bytes long, payload_digest string, payload binary"
)


def _bytes(text: Column) -> Column:
    return F.octet_length(text)


def _record(kind: Column | str, record_id: Column, uri: Column, date: str, extra: list[Column], block: Column) -> Column:
    """One record without the two line ends that close it. A header whose value is NULL is left out."""
    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.lit(f"WARC-Date: {date}"),
        *extra,
        F.concat(F.lit("Content-Length: "), _bytes(block).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *head), F.lit(END), block)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, *cut) for cut in cuts)), F.lit(">"))


def shared_payloads(
    pages: DataFrame, html: str, page_id: str, least: int = LEAST_SHARED, url: str | None = None
) -> DataFrame:
    """Stored table of the payloads of at least `least` bytes that more than one page has: digest, and the page that stands
    for them: largest id (`first`), of several the largest url (`first_url`), and how many rows have both (`firsts`)."""
    inner, names = shielded(pages, html, page_id)
    body = F.coalesce(names[html], F.lit(""))
    sums = inner.select(
        F.sha1(body.cast("binary")).alias("digest"),
        _bytes(body).alias("n"),
        F.col(names[page_id]).alias("id"),
        (F.col(names[url]) if url else F.lit(None).cast("string")).alias("url"),
    )
    alike = sums.where(F.col("n") >= least).groupBy("digest", "id", "url").agg(F.count(F.lit(1)).alias("rows"))
    groups = alike.groupBy("digest").agg(
        F.max(F.struct("id", "url", "rows")).alias("top"), F.sum("rows").alias("pages")
    )
    facts = ("digest", F.col("top.id").alias("first"), F.col("top.url").alias("first_url"), F.col("top.rows").alias("firsts"))
    return staged(groups.where("pages > 1").select(*facts), "warc-shared")


def write_archives(
    pages: DataFrame,
    path: str,
    html: str = "html",
    url: str = "url",
    page_id: str = "page_id",
    date: str = DATE,
    least: int = LEAST_SHARED,
) -> None:
    """Write three records per page to gzip-compressed archives in the folder `path`.

    * Pages with equal payloads of at least `least` bytes: that with the largest id is the response, all others are
      revisits of it, without payload, and name its record and target URI. Rows that share that id and payload are responses all; rows without id are
      revisits if a page with an id has their payload, else responses.
    * A NULL html is an empty payload. The url may be NULL or hold any characters: the target URI has line ends and
      blanks percent-encoded, and the metadata record holds id and url as JSON.
    * Files end after as many records as fit `FILE_BYTES` on average. Pages are not shuffled; the join with the shared
      payloads is a broadcast if those fit its bound, else a shuffle join that adaptive execution can split.
    """
    shared = shared_payloads(pages, html, page_id, least, url)
    inner, names = shielded(pages, html, url, page_id)
    body = F.coalesce(names[html], F.lit(""))
    size = inner.agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes(body)).alias("bytes")).first()
    per_file = 3 * max(1, int(FILE_BYTES * size.n / ((size.bytes or 0) + 1024 * size.n))) if size.n else 3
    if shared.count() * 200 <= BROADCAST_BYTES:
        shared = F.broadcast(shared)
    rows = inner.select(
        body.alias("html"),
        F.col(names[url]).alias("url"),
        F.col(names[page_id]).alias("id"),
        F.sha1(body.cast("binary")).alias("digest"),
    ).join(shared, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    number = F.monotonically_increasing_id().cast("string")
    rows = rows.select("*", again.alias("again"), number.alias("number"))

    def identity(role: str) -> Column:
        return _uuid(F.lit(role), F.col("digest"), F.col("number"))

    def plain(column: str) -> Column:
        return F.regexp_replace(F.coalesce(column, F.lit("about:blank")), "[\r\n\t ]+", "%20")

    # The response that others repeat is known by its payload alone, so that they can name it; unless it is there twice.
    named, original = F.col("firsts") == 1, _uuid(F.lit("original"), F.col("digest"))
    stands = named & F.col("id").eqNullSafe(F.col("first")) & F.col("url").eqNullSafe(F.col("first_url"))
    capture = F.when(stands, original).otherwise(identity("response"))
    rows = rows.select("*", plain("url").alias("uri"), capture.alias("capture"))
    uri, capture = F.col("uri"), F.col("capture")
    host = F.regexp_extract(uri, "^[a-zA-Z]+://([^/?#]+)", 1)
    target = F.regexp_extract(uri, "^[a-zA-Z]+://[^/?#]+([^#]*)", 1)
    line = F.concat(F.lit("GET "), F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target)))
    ask = F.concat(line, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(END))
    with_capture = F.concat(F.lit("WARC-Concurrent-To: "), capture)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    answer = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        _bytes(F.col("html")).cast("string"),
        F.lit(END),
        F.when(F.col("again"), F.lit("")).otherwise(F.col("html")),
    )
    again, profile = F.col("again"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    same = [
        F.when(again, F.lit(f"WARC-Profile: {profile}")),
        F.when(again & named, F.concat(F.lit("WARC-Refers-To: "), original)),
        F.when(again, F.concat(F.lit("WARC-Refers-To-Target-URI: "), plain("first_url"))),
        F.when(again, F.lit(f"WARC-Refers-To-Date: {date}")),
    ]
    facts = F.concat(F.lit("page: "), F.to_json(F.struct("id", "url")), F.lit(CRLF))
    http = "Content-Type: application/http; msgtype="
    records = F.array(
        _record("request", identity("request"), uri, date, [with_capture, F.lit(f"{http}request")], ask),
        _record(
            F.when(F.col("again"), "revisit").otherwise("response"),
            capture,
            uri,
            date,
            [digest, *same, F.lit(f"{http}response")],
            answer,
        ),
        _record(
            "metadata", identity("metadata"), uri, date, [with_capture, F.lit("Content-Type: application/warc-fields")], facts
        ),
    )
    rows.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", per_file
    ).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive, one at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", 0))
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {headers.get('warc-record-id')} ends after {len(block)} of {length} bytes")
        yield headers, block


def _row(headers: dict[str, str], block: bytes, payload: bool) -> dict:
    body = block
    if headers.get("content-type", "").startswith("application/http"):
        body = block.partition(END.encode())[2]
    kind = headers.get("warc-type")
    return {
        "record_id": headers.get("warc-record-id"),
        "type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "declared_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": len(body),
        "payload_digest": hashlib.sha1(body).hexdigest(),
        "payload": body if payload or kind == "metadata" else None,
    }


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of all `.gz` archives in a folder, with the size and digest of its payload as read.

    The payload of a request or response is what follows its HTTP head. Without `payload`, only metadata records keep
    theirs. A file's compressed bytes are held by one task, its text never: records are decompressed one by one.
    """
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (column.split() for column in RECORD.split(", "))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held_bytes = [], 0
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_buffer()), "rb") as stream:
                    for headers, block in parse_records(stream):
                        rows.append(_row(headers, block, payload))
                        held_bytes += len(rows[-1]["payload"] or b"")
                        if len(rows) >= _BATCH_ROWS or held_bytes >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held_bytes = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    package_on_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: `capture_id` and the structs `request`, `response` and `metadata`.

    A capture is a response or revisit record with the records that are concurrent to it; of several of one kind that
    with the smallest record id is taken, a missing one is NULL, and records concurrent to nothing that was read are left out. All meet by
    the identifier in one shuffle.
    """
    parts = [F.struct(*records.columns).alias("record")]
    keyed = records.select(F.coalesce("concurrent_to", "record_id").alias("capture_id"), *parts)
    kind = F.col("record.type")

    def one(name: str, *kinds: str) -> Column:
        return F.min(F.when(kind.isin(*kinds), F.struct("record.record_id", "record")))["record"].alias(name)

    whole = keyed.groupBy("capture_id").agg(
        one("request", "request"), one("response", "response", "revisit"), one("metadata", "metadata")
    )
    return whole.where("response IS NOT NULL")


def page_captures(records: DataFrame, id_type: str = "long") -> DataFrame:
    """Captures with `page_id` and `url` from their metadata, and the full payload's size and digest; for a revisit
    those of the response it repeats, and `refers_to`, that response's page.

    Revisits are resolved by payload digest, as their profile says; a response repeated by many is one row of a join
    whose other side adaptive execution can split.
    """
    fields = F.from_json(
        F.regexp_extract(F.col("metadata.payload").cast("string"), "(?s)page: (.*)\r\n", 1), f"id {id_type}, url string"
    )
    captures = staged(
        assemble(records).select(
            "capture_id",
            fields["id"].alias("page_id"),
            fields["url"].alias("url"),
            F.col("response.type").alias("record_type"),
            F.col("response.declared_digest").alias("declared"),
            F.col("response.payload_bytes").alias("bytes"),
            F.col("response.payload_digest").alias("digest"),
        ),
        "warc-captures",
    )
    originals = captures.where("record_type = 'response'").groupBy("digest")
    originals = originals.agg(F.max("page_id").alias("original"), F.max("bytes").alias("whole"))
    again = captures.where("record_type = 'revisit'").drop("digest", "bytes").withColumnRenamed("declared", "digest")
    found = again.join(originals, "digest", "left").select(
        "page_id", "url", F.col("whole").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("original").alias("refers_to"),
    )
    first = captures.where("record_type = 'response'").select(
        "page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast(id_type).alias("refers_to"),
    )
    return first.unionByName(found)
