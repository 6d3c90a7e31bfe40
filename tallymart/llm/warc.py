"""Web archives (WARC 1.1): writing pages, and reading them back by segment reassembly.

Writing: a page is a ``response`` record with its HTTP head and the payload in
chunked transfer framing; a block above ``segment_bytes`` goes on in
``continuation`` records.  Of pages with equal payloads one is a response, the
others are ``revisit`` records that refer to it.  Spark's text writer makes the
files: the end of a record in an archive is its line separator.

Reading: Spark's text reader streams the pieces between ``\\r\\n\\r\\nWARC/``, and
the parser puts them together again by ``Content-Length``, so a payload that
contains that text is no end of a record.  Continuation records are grouped by the
identifier of the record they belong to, ordered by segment number, held against the
total length, and only then gathered; chunks are decoded last.

Archives are compressed with gzip: such a file is read by one task from its start, as
the parser needs it.  A task holds a batch of records, never a file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import shared_dir, store

END = b"\r\n\r\n"
SEPARATOR = END + b"WARC/"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A table of repeated payloads of at most this many rows is broadcast, a larger one is shuffled.
BROADCAST_ROWS = 200_000
#: Bytes of the rows that a worker hands over at once.
HANDED_BYTES = 4_000_000


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of chunked transfer framing, None where the framing is broken.

    Extensions after a chunk's size and trailing fields after the last chunk are read over.
    """
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        digits = body[at:end].split(b";")[0].strip(b" \t")
        if not re.fullmatch(rb"[0-9a-fA-F]+", digits):
            return None
        size, at = int(digits, 16), end + 2
        if not size:
            # An empty line ends the trailing fields.
            closed = body.startswith(b"\r\n", at) or body.find(END, at) >= 0
            return b"".join(out) if closed else None
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def fields_of(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; folded lines go on, of repeated names the first counts."""
    found: dict[str, str] = {}
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            found.setdefault(
                name.strip().decode("utf-8", "replace").lower(),
                value.strip().decode("utf-8", "replace"),
            )
    return found


def digest_hex(declared: str | None) -> str | None:
    """A field ``sha1:...`` in base 32 or hex as lower-case hex; other digests give None."""
    algorithm, colon, value = (declared or "").partition(":")
    if not colon or algorithm.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes
    #: All bytes of the declared length were there.
    full: bool


def records_of(pieces: Iterator[tuple[str, bytes]]) -> Iterator[Record]:
    """The records of (file, piece), pieces being what stood between separators, file by file.

    The end of a record follows from its declared length alone.  What is no record
    is read over up to the next separator; a file that ends early gives its last
    record with ``full`` false.
    """
    held, file = bytearray(), None
    head: tuple[dict[str, str], int, int] | None = None  # fields, start and end of the block

    def taken(last: bool) -> Iterator[Record]:
        nonlocal held, head
        at = 0
        while True:
            if head is None:
                while held.startswith(END, at):
                    at += len(END)
                if not held.startswith(b"WARC/", at):
                    found = held.find(SEPARATOR, at)
                    if found < 0:
                        break
                    at = found
                    continue
                end = held.find(END, at)
                if end < 0:
                    break
                fields = fields_of(bytes(held[at:end]))
                length = fields.get("content-length", "")
                size = int(length) if length.isascii() and length.isdigit() else 0
                head = fields, end + len(END), end + len(END) + size
            fields, start, end = head
            if len(held) < end and not last:
                break
            yield Record(fields, bytes(held[start:end]), len(held) >= end)
            at, head = min(end, len(held)), None
        del held[:at]
        if head is not None:
            head = head[0], head[1] - at, head[2] - at

    for name, piece in pieces:
        if name != file:
            yield from taken(True)
            held, head, file = bytearray(piece), None, name
        else:
            held += SEPARATOR
            held += piece
        yield from taken(False)
    yield from taken(True)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields]
    head = f"WARC/1.1\r\n{''.join(lines)}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block


def _sha1(data: bytes) -> str:
    return f"sha1:{base64.b32encode(hashlib.sha1(data).digest()).decode()}"


def page_records(
    page_id: str | None, url: str | None, payload: bytes, refers_to: tuple[str, str | None] | None,
    key: str, date: str, chunk_bytes: int, segment_bytes: int,
) -> Iterator[bytes]:
    """The records of one page, without the empty lines that end each.

    ``refers_to`` is the (page id, url) of the response that the page repeats;
    ``key`` makes the identifiers unique.
    """

    def uri(value: str | None, page: str | None) -> str:
        return quote(value, safe="!#$%&'()*+,/:;=?@[]~") if value else f"urn:page:{page or 'none'}"

    def name(number: int) -> str:
        return f"<{uuid.UUID(hashlib.md5(f'{key}:{number}'.encode()).hexdigest()).urn}>"

    always = [("WARC-Target-URI", uri(url, page_id)), ("WARC-Date", date)]
    own = [("Page-Id", page_id)] if page_id is not None else []
    if refers_to is not None:
        to_page, to_url = refers_to
        yield _record(
            [
                ("WARC-Type", "revisit"), ("WARC-Record-ID", name(1)), *always, *own,
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To-Target-URI", uri(to_url, to_page)),
                ("WARC-Refers-To-Date", date), ("Refers-To-Page-Id", to_page),
                ("WARC-Payload-Digest", _sha1(payload)),
                ("Content-Type", "application/http; msgtype=response"),
            ],
            HTTP_HEAD + END,
        )
        return
    block = HTTP_HEAD + END + chunked(payload, chunk_bytes)
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        part = block[at : at + segment_bytes]
        if number == 1:
            fields = [
                ("WARC-Type", "response"), ("WARC-Record-ID", name(1)), *always, *own,
                ("WARC-Payload-Digest", _sha1(payload)),
                ("Content-Type", "application/http; msgtype=response"),
            ]
        else:
            fields = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", name(number)), *always,
                ("WARC-Segment-Origin-ID", name(1)),
            ]
        if len(cuts) > 1:
            fields += [("WARC-Segment-Number", str(number)), ("WARC-Block-Digest", _sha1(part))]
            if number == len(cuts):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def _handed(
    rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]
) -> Iterator[pa.RecordBatch]:
    """Batches of about HANDED_BYTES."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += 200 + size(row)
        if total >= HANDED_BYTES:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
                schema=schema,
            )
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
            schema=schema,
        )


def with_origins(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds ``origin`` to (page_id, url, payload): the (page_id, url) a page refers to, else null.

    Payloads are compared by SHA-256.  Only one row per repeated payload is kept
    beside the pages, counted in the map tasks; it is broadcast up to BROADCAST_ROWS
    rows, beyond that the pages are shuffled, and Spark splits a hot payload.
    """
    keyed = pages.withColumn("key", F.unhex(F.sha2("payload", 256)))
    long = F.octet_length("payload") >= least_bytes
    repeated = store(
        keyed.where(long).groupBy("key")
        .agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first.page_id IS NOT NULL").select("key", "first"),
        "repeated",
    )
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    return keyed.join(repeated, "key", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first")).alias("origin"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 1000,
    chunk_bytes: int = 8192,
    segment_bytes: int = 32_768,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes a folder of archives with the records of all pages.

    A null html is an empty payload.  Pages with equal payloads of at least
    ``least_bytes`` are one response, that of the largest id, and revisits; rows
    that share the largest id are all responses, and so are all rows of a payload that
    has null ids only.  Repeated rows give records of their own.  No rows give no records.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    sent = with_origins(
        pages.select(
            F.col(f"`{page_id}`").cast("long").alias("page_id"),
            F.col(f"`{url}`").cast("string").alias("url"),
            payload.alias("payload"),
        ),
        least_bytes,
    ).select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload",
        F.col("origin.page_id").cast("string").alias("to_page"), F.col("origin.url").alias("to_url"),
    )
    schema = pa.schema([("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            number = 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own, address, data, to_page, to_url = row
                    refers_to = None if to_page is None else (to_page, to_url)
                    key = f"{own}:{part}:{number}"
                    number += 1
                    for record in page_records(
                        own, address, data, refers_to, key, date, chunk_bytes, segment_bytes
                    ):
                        yield (record,)

        yield from _handed(rows(), schema, lambda row: len(row[0]))

    lines = sent.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


_READ = (
    "record_id string, type string, page_id string, target_uri string, refers_to_page string, "
    "refers_to_uri string, declared string, payload_bytes long, payload_digest string, "
    "payload binary, problem string"
)
_PARTS = "origin string, number int, total long, block binary"


def opened(block: bytes, declared: str | None) -> tuple[bytes | None, str | None]:
    """The payload of an HTTP response block, and what is wrong with it."""
    head, found, body = block.partition(END)
    if not found:
        return None, "no end of the HTTP head"
    if "chunked" in fields_of(head).get("transfer-encoding", "").lower():
        whole = dechunked(body)
        if whole is None:
            return None, "broken chunks"
        body = whole
    if declared is not None and hashlib.sha1(body).hexdigest() != declared:
        return body, "payload digest differs"
    return body, None


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record that is not a continuation, from the gzip archives below ``path``.

    Columns: record_id, type, page_id (the field ``Page-Id``, a string), target_uri,
    refers_to_page, refers_to_uri, declared (payload digest as the record names it, hex),
    payload_bytes, payload_digest (SHA-1 of the payload found, hex), payload (null without
    ``payload``), problem, segments.  Only responses have a payload.

    ``problem`` is null for a sound record; otherwise it says that the file ends early,
    that segments are missing, repeated or do not add up to the total length, that a
    block's or payload's digest differs, or that the framing is broken.  Continuations
    whose first segment is missing give one row with the type ``continuation``.
    No archives give no rows.
    """
    arrow = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    wide = StructType.fromDDL(f"{_READ}, {_PARTS}")
    schema = pa.schema([
        (f.name, arrow[{"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())])
        for f in wide
    ])
    files = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    pieces = files.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def rows() -> Iterator[tuple]:
            for fields, block, full in records_of(parts()):
                kind = fields.get("warc-type")
                name, origin = fields.get("warc-record-id"), fields.get("warc-segment-origin-id")
                declared = digest_hex(fields.get("warc-payload-digest"))
                number = _number(fields.get("warc-segment-number"))
                problem = None if full else "the file ends early"
                named = digest_hex(fields.get("warc-block-digest"))
                if full and named is not None and hashlib.sha1(block).hexdigest() != named:
                    problem = "block digest differs"
                data = None
                if number is None and kind == "response" and problem is None:
                    data, problem = opened(block, declared)
                yield (
                    name, kind, fields.get("page-id"), fields.get("warc-target-uri"),
                    fields.get("refers-to-page-id"), fields.get("warc-refers-to-target-uri"),
                    declared, None if data is None else len(data),
                    None if data is None else hashlib.sha1(data).hexdigest(),
                    data if payload else None, problem,
                    None if number is None else origin or name, number,
                    _number(fields.get("warc-segment-total-length")),
                    None if number is None else block,
                )

        yield from _handed(rows(), schema, lambda row: len(row[9] or b"") + len(row[14] or b""))

    parsed = store(pieces.mapInArrow(parse, f"{_READ}, {_PARTS}"), "warc-records")
    names = StructType.fromDDL(_READ).names
    whole = parsed.where("number IS NULL").select(*names, F.lit(1).alias("segments"))
    return whole.unionByName(reassembled(parsed.where("number IS NOT NULL"), payload))


def reassembled(segments: DataFrame, payload: bool = True) -> DataFrame:
    """One row per origin of segments (``_READ`` and ``_PARTS``), columns as of ``read_archives``.

    Numbers and lengths are summed up first; only the segments of an origin that adds
    up, one record, are gathered.
    """
    names = StructType.fromDDL(_READ).names
    first = F.col("number") == 1
    sums = segments.groupBy("origin").agg(
        F.count("*").alias("n"),
        F.min("number").alias("least"),
        F.max("number").alias("most"),
        F.sum(F.col("number").cast("long")).alias("numbers"),
        F.max("total").alias("total"),
        F.sum(F.octet_length("block").cast("long")).alias("bytes"),
        F.max("problem").alias("problem"),
        F.max(F.when(first, F.struct(*[n for n in names if n not in ("payload", "problem")]))).alias("head"),
    )
    # Numbers from 1 to n, each once: no repeated segment gives that sum, count and range
    # unless another is missing, and then the bytes are held against the total.
    complete = (
        (F.col("least") == 1) & (F.col("most") == F.col("n")) & F.col("head").isNotNull()
        & (F.col("numbers") * 2 == F.col("n") * (F.col("n") + 1))
    )
    sums = sums.withColumn(
        "problem",
        F.coalesce(
            F.when(~complete, F.lit("segments are missing or repeated")),
            F.when(~F.col("bytes").eqNullSafe(F.col("total")), F.lit("total length differs")),
            F.col("problem"),
        ),
    )
    sound, broken = sums.where("problem IS NULL"), sums.where("problem IS NOT NULL")
    gathered = (
        segments.join(sound.select("origin", "head", "n"), "origin")
        .groupBy("origin")
        .agg(
            F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
            F.any_value("head").alias("head"),
            F.any_value("n").cast("int").alias("segments"),
        )
        .select("head.*", F.col("parts.block").alias("blocks"), F.col("parts.number").alias("numbers"), "segments")
    )
    kept = [n for n in names if n not in ("payload", "problem", "payload_bytes", "payload_digest")]
    schema = pa.schema(
        [(n, pa.string()) for n in kept]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
           ("problem", pa.string()), ("segments", pa.int32())]
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for *own, blocks, numbers, count in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                ):
                    held, data, problem = dict(zip(kept, own, strict=True)), None, None
                    if numbers != list(range(1, count + 1)):
                        problem = "segments are missing or repeated"
                    elif held["type"] == "response":
                        data, problem = opened(b"".join(blocks), held["declared"])
                    yield (
                        *own, None if data is None else len(data),
                        None if data is None else hashlib.sha1(data).hexdigest(),
                        data if payload else None, problem, count,
                    )

        yield from _handed(rows(), schema, lambda row: len(row[-3] or b""))

    out = ", ".join(
        [f"{n} string" for n in kept]
        + ["payload_bytes long", "payload_digest string", "payload binary", "problem string", "segments int"]
    )
    made = gathered.select(*kept, "blocks", "numbers", "segments").mapInArrow(join, out)
    lost = broken.select(
        *(F.coalesce(F.col(f"head.{n}"), F.col("origin")).alias(n) if n == "record_id"
          else F.coalesce(F.col(f"head.{n}"), F.lit("continuation")).alias(n) if n == "type"
          else F.col(f"head.{n}").alias(n) for n in kept),
        F.lit(None).cast("long").alias("payload_bytes"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("binary").alias("payload"),
        "problem",
        F.col("n").cast("int").alias("segments"),
    )
    return made.unionByName(lost)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits; a revisit gets size and digest of the response it refers to.

    That is the sound response of the page and the payload digest that it names; without
    one, ``payload_bytes`` and ``payload_digest`` are null and ``problem`` says so.
    ``records`` is read twice.
    """
    named = ["page_id", "type", "segments"]
    responses = records.where("type = 'response'").select(
        *named, "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("refers_to_page"), "problem"
    )
    held = (
        responses.where("problem IS NULL").groupBy(F.col("page_id").alias("to_page"), "payload_digest")
        .agg(F.any_value("payload_bytes").alias("payload_bytes"))
    )
    revisits = records.where("type = 'revisit'").select(*named, "refers_to_page", "declared", "problem")
    found = revisits.join(
        held,
        (F.col("refers_to_page") == F.col("to_page")) & (F.col("declared") == F.col("payload_digest")),
        "left",
    ).select(
        *named, "payload_bytes", "payload_digest", "refers_to_page",
        F.coalesce("problem", F.when(F.col("to_page").isNull(), F.lit("no response to refer to"))).alias("problem"),
    )
    return responses.unionByName(found)


def round_trip(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 1000, chunk_bytes: int = 8192, segment_bytes: int = 32_768,
) -> DataFrame:
    """Writes the pages as archives to the shared folder and reads them back: a row per page.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, segments,
    problem.  Null, empty and repeated rows are as in ``write_archives``.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, page_id, url, html, least_bytes, chunk_bytes, segment_bytes)
    records = store(read_archives(spark, path, payload=False).drop("payload"), "warc-read")
    return resolved(records).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_page").cast("long").alias("refers_to"),
        "segments",
        "problem",
    )
