"""WARC archives: writing pages, and reading with segment reassembly (operator 3).

Writing.  Every page is one record.  Of pages with equal payloads the one with the smallest id
is a ``response``, the others are ``revisit`` records that name it.  A response holds an HTTP
message whose body is in chunked transfer framing; a message longer than ``SEGMENT_BYTES`` goes
on in ``continuation`` records (segment numbers from 1, origin id, total length on the last).
Records are built by the tasks and written, gzipped, by Spark's text writer, whose row end is the
blank lines that end a record, so any store that Spark writes to will do and a lost task's file
is discarded.  A file has at most ``RECORDS_PER_FILE`` records of a segment each, so its size is
bounded, and it is read whole.  Only payload digests that occur more than once are gathered (a
partial aggregate over narrow rows); pages meet them by a size-checked broadcast, so in general
no payload is shuffled.

Reading.  Records are found by their content length.  Segments are grouped by the identifier of
their origin, ordered by number and joined; numbers must run from 1 without a gap and the total
length must hold.  Then the HTTP message is cut, chunked framing is decoded and the payload is
checked against the record's digest.  Unsegmented records need no shuffle.  Revisits take their
payload's size from the record they refer to.  A record that fails has its ``problem`` named.
A response's record id follows from its digest, so revisits can name it; the others are random.

Defined results for odd rows: a null payload is empty; a null id counts as larger than every id;
of equal rows one is the response and the others refer to its id; a url is written with blanks
and control characters percent-encoded (null: ``about:blank``).  Other columns are ignored.  An
empty table writes no record and reads as an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.staging import broadcast_within, stage, stage_path

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 4096
REPEATS = 4096  # revisits of one repeated row that a task makes at a time
BROADCAST_PAYLOADS = 500_000  # digests that occur more than once: 60 bytes each, 30 MB
RECORD_END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_BUILD_ROWS = 256


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(digest: str | None) -> str:
    """The identifier of the response with a payload digest; a random one for None."""
    own = uuid.uuid4() if digest is None else uuid.uuid5(uuid.NAMESPACE_URL, f"sha1:{digest}")
    return f"<urn:uuid:{own}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError on broken framing."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:line].split(b";")[0], 16)  # extensions after ; say nothing of the size
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut off")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def page_records(page_id, url, payload: bytes | None, digest: str, revisit: bool, named: bool, segment: int) -> list[bytes]:
    """The records of one page, without the blank lines after each.

    :param revisit: the payload is that of the response with the same digest
    :param named: a response that revisits may refer to
    """
    own = record_id(digest if named and not revisit else None)
    headers = [
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.insert(1, ("WARC-Page-ID", str(page_id)))
    if revisit:
        more = [("WARC-Refers-To", record_id(digest)), ("WARC-Profile", REVISIT_PROFILE)]
        return [_record([("WARC-Type", "revisit"), *headers, *more], _HTTP + b"\r\n")]
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload or b"")
    if len(block) <= segment:
        return [_record([("WARC-Type", "response"), *headers], block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [_record([("WARC-Type", "response"), *headers, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        out.append(
            _record(
                [
                    ("WARC-Type", "continuation"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}/{n}')}>"),
                    ("WARC-Date", DATE),
                    ("WARC-Segment-Origin-ID", own),
                    ("WARC-Segment-Number", str(n)),
                    *last,
                ],
                part,
            )
        )
    return out


def _records(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _BUILD_ROWS):
                out = []
                for r in batch.slice(lo, _BUILD_ROWS).to_pylist():
                    payload = (r["html"] or "").encode("utf-8")
                    digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode("ascii")
                    out += page_records(r["page_id"], r["url"], payload, digest, r["revisit"], r["named"], segment)
                yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])

    return run


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_revisit: int = 0,
    segment: int = SEGMENT_BYTES,
) -> None:
    """Write one record for every page below ``path``.

    :param least_revisit: payloads of fewer bytes are always responses
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
        (F.octet_length(html) >= least_revisit).alias("named"),
    )
    # Payloads that occur more than once: the smallest id and how many rows have it.
    per_page = rows.filter("named").groupBy("sha1", "page_id").agg(F.count("*").alias("n"))
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "n")
    shared = per_page.groupBy("sha1").agg(F.min(order).alias("first"), F.sum("n").alias("many")).filter("many > 1")
    shared = stage(
        shared.select("sha1", F.col("first.page_id").alias("first_page"), F.col("first.n").alias("twins")), "shared_payloads"
    )
    joined = rows.join(broadcast_within(shared, BROADCAST_PAYLOADS), "sha1", "left").withColumns(
        {"in_group": F.col("named") & F.col("twins").isNotNull(), "is_first": F.col("page_id").eqNullSafe(F.col("first_page"))}
    )
    twin = F.col("in_group") & F.col("is_first") & (F.col("twins") > 1)
    revisit = F.col("in_group") & ~F.col("is_first")
    body = F.when(~F.col("revisit"), F.col("html")).alias("html")
    out = joined.filter(~twin).withColumn("revisit", revisit).select("page_id", "url", body, "sha1", "named", "revisit")
    if shared.filter("twins > 1").limit(1).count():
        out = out.union(_twin_records(joined.filter(twin)))
    (
        out.mapInArrow(_records(segment), "record binary")
        .select(F.col("record").cast("string"))
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "gzip")
        .text(path)
    )


def _twin_records(twins: DataFrame) -> DataFrame:
    """Rows with one payload and one id, the smallest: one of them is the response.

    Equal rows are counted map-side, so many of them are one row per task.
    """
    link = F.struct(F.col("url").isNull().alias("no_url"), "url")
    heads = twins.groupBy("sha1", "page_id").agg(F.min(link).alias("head"), F.first("html").alias("html"))
    counts = twins.groupBy("sha1", "page_id", "url").agg(F.count("*").alias("n"))
    first = F.col("head.url").eqNullSafe(F.col("url"))
    rest = (
        counts.join(heads.select("sha1", "head"), "sha1")
        .withColumn("n", F.col("n") - F.when(first, 1).otherwise(0))
        .filter("n > 0")
    )
    # The repeats of a row in pieces of bounded size, dealt out to the tasks before they are made.
    last = F.expr(f"(n - 1) div {REPEATS}L")
    pieces = rest.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("sha1", "page_id", "url", "piece")
    own = F.least(F.lit(REPEATS).cast("long"), F.col("n") - F.col("piece") * REPEATS)
    rest = pieces.select("page_id", "url", "sha1", F.explode(F.sequence(F.lit(1).cast("long"), own)).alias("nth"))
    yes, no = F.lit(True), F.lit(False)
    return heads.select(
        "page_id", F.col("head.url").alias("url"), "html", "sha1", yes.alias("named"), no.alias("revisit")
    ).union(rest.select("page_id", "url", F.lit(None).cast("string"), "sha1", yes, yes))


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of one archive."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:stop].decode("utf-8").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin = stop + 4
        at = begin + int(headers["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {begin} does not end where its length says")
        yield headers, data[begin:at]
        at += 4


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message, out of its transfer framing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP headers cut off")
    names = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    return unchunked(body) if b"chunked" in names.get(b"transfer-encoding", b"") else body


def _checked(block: bytes, digest: str | None, keep: bool) -> dict:
    try:
        payload = http_payload(block)
    except ValueError as err:
        return {"problem": str(err)}
    found = payload_digest(payload)
    return {
        "payload_bytes": len(payload),
        "payload_digest": found,
        "payload": payload if keep else None,
        "problem": None if digest in (None, found) else "payload digest differs",
    }


_FOUND = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("refers_to", pa.string()),
        ("digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("problem", pa.string()),
        ("origin", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)
_FOUND_DDL = (
    "record_id string, type string, page_id long, url string, refers_to string, digest string, payload_bytes long, "
    "payload_digest string, payload binary, problem string, origin string, segment long, total long, block binary"
)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _found(headers: dict[str, str], block: bytes, keep: bool) -> dict:
    row = dict.fromkeys(_FOUND.names)
    own = headers["warc-record-id"]
    digest = headers.get("warc-payload-digest")
    row |= {
        "record_id": own,
        "type": headers["warc-type"],
        "page_id": _number(headers.get("warc-page-id")),
        "url": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "digest": digest.removeprefix("sha1:") if digest else None,
    }
    number = _number(headers.get("warc-segment-number"))
    if number is not None:
        total = _number(headers.get("warc-segment-total-length"))
        row |= {"origin": headers.get("warc-segment-origin-id", own), "segment": number, "total": total, "block": block}
    elif row["type"] == "response":
        row |= _checked(block, row["digest"], keep)
    return row


def _parsed(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = []
                for headers, block in records_of(gzip.decompress(content.as_buffer())):
                    held.append(_found(headers, block, keep))
                    if len(held) == _BUILD_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema=_FOUND)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_FOUND)

    return run


def join_segments(parts: list[dict]) -> bytes:
    """The block of a record from its segments {segment, total, block}; ValueError if incomplete."""
    parts = sorted(parts, key=lambda p: p["segment"])
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("a segment is missing or doubled")
    block = b"".join(p["block"] for p in parts)
    if parts[-1]["total"] is None:
        raise ValueError("the last segment is missing")
    if parts[-1]["total"] != len(block):
        raise ValueError("total length differs")
    return block


def _joined(keep: bool):
    kept = ["origin", "payload_bytes", "payload_digest", "payload", "problem"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([_FOUND.field(k) for k in kept])
        for batch in batches:
            for r in batch.to_pylist():
                try:
                    row = _checked(join_segments(r["parts"]), r["digest"], keep)
                except ValueError as err:
                    row = {"problem": str(err)}
                yield pa.RecordBatch.from_pylist([{"origin": r["origin"], **row}], schema=schema)

    return run


def read_warc(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per response and revisit of the archives below ``path``.

    Columns: record_id, type, page_id, url, payload_bytes, payload_digest, payload (if kept; of a
    revisit null), refers_page (of a revisit) and problem.  Continuations whose origin is missing
    appear with their origin's identifier, a null type and a problem.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = stage(files.mapInArrow(_parsed(keep_payload), _FOUND_DDL), "warc_records")
    info = ["record_id", "type", "page_id", "url"]
    result = ["payload_bytes", "payload_digest", "payload", "problem"]
    whole = found.filter("type = 'response' AND segment IS NULL").select(*info, *result)
    parts = found.filter("segment IS NOT NULL")
    grouped = parts.groupBy("origin").agg(
        F.collect_list(F.struct("segment", "total", "block")).alias("parts"), F.max("digest").alias("digest")
    )
    joined = grouped.mapInArrow(
        _joined(keep_payload), "origin string, payload_bytes long, payload_digest string, payload binary, problem string"
    )
    heads = parts.filter("type = 'response'").select(*info)
    segmented = joined.join(heads, joined["origin"] == heads["record_id"], "left").select(
        F.coalesce("record_id", "origin").alias("record_id"), *info[1:], *result
    )
    responses = stage(whole.union(segmented), "responses")
    target = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("refers_page"),
        F.col("payload_bytes").alias("n"),
        F.col("payload_digest").alias("d"),
    )
    revisits = found.filter("type = 'revisit'").select(*info, "digest", "refers_to").join(target, "refers_to", "left")
    nothing = F.lit(None)
    problem = F.when(F.col("n").isNull(), "the record referred to is missing").when(
        F.col("digest") != F.col("d"), "payload digest differs"
    )
    return responses.select(*info, *result[:3], nothing.cast("long").alias("refers_page"), "problem").union(
        revisits.select(*info, "n", "d", nothing.cast("binary"), "refers_page", problem)
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    path = stage_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_page").alias("refers_to"),
    )


_BITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * g + 1}, 5) AS INT) >> {15 - 5 * j}) & 31), 1)"
    for g in range(8)
    for j in range(4)
)
OP3_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_page FROM k GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BITS} AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM k JOIN f USING (h)
"""
