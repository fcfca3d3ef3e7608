"""Web archives: write records with revisits and segments, read and reassemble them.

Writing is Spark's text writer with the record end as its line end, so archives
go wherever Spark writes. A block above ``segment_bytes`` is cut into a first
record and continuation records, as the format has it; the payload travels in
chunked transfer framing. Reading parses each file on its own, groups the
segments by their origin's identifier, orders them by number, verifies the
total length, and only then undoes the framing.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text

#: Payloads below this many bytes are never written as revisits.
MIN_REVISIT_BYTES = 100
SEGMENT_CHARS = 16 * 1024
CHUNK_CHARS = 8 * 1024
#: With segments of at most 64 KiB of UTF-8, no archive is larger than 256 MiB, unzipped.
RECORDS_PER_FILE = 4_000
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def _pieces(text: Column, size: int) -> Column:
    """A text cut every ``size`` code points; the empty text has no piece."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))


def chunked(text: Column, size: int = CHUNK_CHARS) -> Column:
    """Chunked transfer framing of a text's UTF-8 bytes."""
    chunks = F.transform(
        _pieces(text, size),
        lambda c: F.concat(F.lower(F.hex(F.octet_length(c).cast("long"))), F.lit("\r\n"), c, F.lit("\r\n")),
    )
    return F.concat(F.array_join(chunks, ""), F.lit("0\r\n\r\n"))


def placed_rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, payload, place``, the place being the row's number in the input."""
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        clean_text(html_col).alias("payload"),
        F.monotonically_increasing_id().alias("place"),
    )


def decide_records(rows: DataFrame, work: Workspace) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes, record_id, refers_id``.

    Of equal payloads of enough bytes the row with the smallest id is written
    whole, the others refer to it. Rows that repeat an id are told apart by
    their place, so ``rows`` must have the same places whenever they are looked at.
    """
    digest, size = F.sha2(F.col("payload"), 256), F.octet_length("payload").cast("long")
    rows = rows.withColumn("payload_digest", digest).withColumn("payload_bytes", size)
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "place")
    # decided without the payloads, and written, so that a hot one can be split when it is joined
    firsts = work.save(
        rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.min(first).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("payload_digest").alias("digest"), "first"),
        "firsts",
    )
    # payloads of too few bytes have nothing to look up, and are dealt evenly
    digest = F.when(F.col("payload_bytes") >= MIN_REVISIT_BYTES, F.col("payload_digest")).otherwise(
        F.hex("place")
    )
    name = lambda page, place: F.concat(
        F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), place.cast("string"), F.lit(">")
    )
    again = F.col("first").isNotNull() & (F.col("first.place") != F.col("place"))
    return rows.withColumn("digest", digest).join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        name(F.col("page_id"), F.col("place")).alias("record_id"),
        F.when(again, name(F.col("first.page_id"), F.col("first.place"))).alias("refers_id"),
    )


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its end; fields whose value is null are left out."""
    lines = [F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{key}: "), value, F.lit("\r\n")))
             for key, value in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"), block)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    segment_chars: int = SEGMENT_CHARS,
    settled: bool = False,
) -> None:
    """Write a record for every page, as gzipped archives below ``path``.

    Null html: an empty payload. Line ends in a url are taken out; a null url
    leaves the field out. Repeated rows are records of their own; very long pages
    are cut into segments; an empty table gives no record; other columns are not
    looked at. ``settled`` says that the pages come straight from files; others
    are written once first, for a row must keep its number if an executor is lost.
    """
    work = Workspace(pages.sparkSession, "warc")
    rows = placed_rows(pages, id_col, url_col, html_col)
    if not settled:
        rows = work.save(rows, "rows")
    decided = decide_records(rows, work)
    work.let_go(lambda: _write(decided, path, segment_chars))
    if not settled:
        work.drop(rows)


def _write(rows: DataFrame, path: str, segment_chars: int) -> None:
    revisit = F.col("refers_id").isNotNull()
    url = F.regexp_replace("url", r"[\r\n]", "")
    framing = F.when(
        revisit,
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")),
    ).otherwise(F.lit("Transfer-Encoding: chunked"))
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), framing, F.lit(_END),
        F.when(revisit, F.lit("")).otherwise(chunked(F.col("payload"))),
    )
    rows = rows.select(
        "page_id", "url", "payload_digest", "record_id", "refers_id",
        F.octet_length(block).alias("total"), _pieces(block, segment_chars).alias("parts"),
    )
    rows = rows.select("*", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "part"))
    cut = F.col("n") > 1
    leads = F.col("at") == 0
    number = (F.col("at") + 1).cast("string")
    fields = [
        ("WARC-Type", F.when(~leads, F.lit("continuation")).when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.when(leads, F.col("record_id")).otherwise(F.concat(F.expr("left(record_id, length(record_id) - 1)"), F.lit(":"), number, F.lit(">")))),
        ("WARC-Date", F.lit(_DATE)),
        ("WARC-Target-URI", url),
        ("Content-Type", F.when(leads, F.lit("application/http; msgtype=response"))),
        ("WARC-Payload-Digest", F.when(leads, F.concat(F.lit("sha256:"), F.col("payload_digest")))),
        ("WARC-Refers-To", F.when(leads, F.col("refers_id"))),
        ("WARC-Profile", F.when(leads & revisit, F.lit(_PROFILE))),
        ("WARC-Segment-Number", F.when(cut, number)),
        ("WARC-Segment-Origin-ID", F.when(~leads, F.col("record_id"))),
        ("WARC-Segment-Total-Length", F.when(cut & (F.col("at") == F.col("n") - 1), F.col("total").cast("string"))),
        ("Content-Length", F.octet_length("part").cast("string")),
    ]
    (
        rows.select(_record(fields, F.col("part")).alias("value"))
        .write.option("lineSep", _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive: their fields (names in lower case) and blocks."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            fields[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        start = end + 4
        if start + size > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, data[start : start + size]
        at = start + size + 4


def dechunk(body: bytes) -> bytes:
    """Undo chunked transfer framing; trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].partition(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


_SEGMENTS = pa.schema(
    [
        ("origin", pa.string()), ("number", pa.int32()), ("kind", pa.string()), ("url", pa.string()),
        ("digest", pa.string()), ("refers_id", pa.string()), ("total", pa.int64()), ("block", pa.binary()),
    ]
)
_SEGMENT_DDL = "origin string, number int, kind string, url string, digest string, refers_id string, total long, block binary"
_BATCH_BYTES = 16 << 20


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            data, rows, held = content.as_py(), [], 0
            if data[:2] == b"\x1f\x8b":
                data = gzip.decompress(data)
            for fields, block in parse_records(data):
                kind = fields.get("warc-type", "")
                more = kind == "continuation"
                total = fields.get("warc-segment-total-length")
                rows.append(
                    {
                        "origin": fields["warc-segment-origin-id" if more else "warc-record-id"],
                        "number": int(fields.get("warc-segment-number", 1)),
                        "kind": None if more else kind,
                        "url": fields.get("warc-target-uri"),
                        "digest": fields.get("warc-payload-digest"),
                        "refers_id": fields.get("warc-refers-to"),
                        # a record that isn't cut is its own whole
                        "total": int(total) if total else (None if "warc-segment-number" in fields else len(block)),
                        "block": block,
                    }
                )
                held += len(block)
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENTS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENTS)


def _payload(block: bytes, kind: str) -> tuple[bytes | None, int | None]:
    """The payload and its size; a revisit has the size alone."""
    head, _, body = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
        return None, int(told[1]) if told else None
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        body = dechunk(body)
    return body, len(body)


_RECORDS = pa.schema(
    [
        ("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_id", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)
_RECORD_DDL = "record_id string, url string, record_type string, refers_id string, payload binary, payload_bytes long, payload_digest string"


def _assemble(with_payload: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                numbers = [s["number"] for s in row["segments"]]
                if numbers != list(range(1, len(numbers) + 1)):
                    raise ValueError(f"{row['record_id']} has the segments {numbers}")
                block = b"".join(s["block"] for s in row["segments"])
                if row["total"] != len(block):
                    raise ValueError(f"{row['record_id']}: {len(block)} bytes instead of {row['total']}")
                payload, size = _payload(block, row["record_type"])
                told = (row["digest"] or "").removeprefix("sha256:") or None
                if payload is not None:
                    digest = hashlib.sha256(payload).hexdigest()
                    if told and told != digest:
                        raise ValueError(f"{row['record_id']}: the payload does not match its digest")
                    told = digest
                rows.append({"record_id": row["record_id"], "url": row["url"], "record_type": row["record_type"],
                             "refers_id": row["refers_id"], "payload": payload if with_payload else None, "payload_bytes": size,
                             "payload_digest": told})
                held += len(block)
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return task


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records below ``path``, reassembled: id, url, type, reference, payload, its size and digest.

    Fails on a record that is cut off, a missing or repeated segment, a total
    length that does not hold, broken framing, or a payload that does not match
    its digest. A revisit has no payload; size and digest are those of the
    payload it stands for. The segments of a record come together in one row, so a
    record has 2 GB at most. Without ``with_payload`` payloads are checked, not returned.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    segments = files.mapInArrow(_segments, _SEGMENT_DDL)
    one = lambda name: F.max(name).alias(name)  # noqa: E731 - only one segment has it
    whole = segments.groupBy(F.col("origin").alias("record_id")).agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("segments"),
        one("url"), F.max("kind").alias("record_type"), one("digest"), one("refers_id"), one("total"),
    )
    return whole.mapInArrow(_assemble(with_payload), _RECORD_DDL)


def page_of(record_id: Column) -> Column:
    """The page id in the identifiers that ``write_archives`` gives."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+):", 1).try_cast("long")


def archive_and_read(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    settled: bool = False,
    with_payload: bool = True,
) -> DataFrame:
    """Write the pages as archives in the shared folder and read these back.

    One row for each input row; nulls, empty tables and the rest as in
    ``write_archives`` and ``read_archives``.
    """
    work = Workspace(pages.sparkSession, "warc")
    path = f"{work.root}/archives"
    write_archives(pages, path, id_col, url_col, html_col, settled=settled)
    return read_archives(pages.sparkSession, path, with_payload)
