"""Archives: what is written is read back, and broken ones are told."""

from __future__ import annotations

import glob
import gzip
import hashlib
from collections import Counter, defaultdict

import pytest

from tallymart.llm import warc
from tallymart.llm.queries import QUERIES


def brute(rows: list[tuple], least: int = 1000) -> Counter:
    """(page_id, html) to (page_id, bytes, digest, type, refers_to)."""
    groups = defaultdict(list)
    for page, html in rows:
        groups[(html or "").encode()].append(page)
    out = Counter()
    for data, pages in groups.items():
        first = max((p for p in pages if p is not None), default=None)
        for page in pages:
            again = len(data) >= least and page != first and first is not None
            kind = ("revisit", first) if again else ("response", None)
            out[page, len(data), hashlib.sha1(data).hexdigest(), *kind] += 1
    return out


def trip(df, **options) -> Counter:
    found = warc.round_trip(df, **options)
    assert not found.where("problem IS NOT NULL").count()
    return Counter(
        tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    )


def test_query_against_brute_force(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.01")
    pages = spark.read.parquet(f"{path}/pages.parquet").select("page_id", "html").collect()
    found = QUERIES["op11_warc_archives"](spark, path).collect()
    assert Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found
    ) == brute([tuple(p) for p in pages])


TEXTS = [
    None, "", "x", "é" * 700, "a" * 999, "b" * 1000, "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 90,
    "WARC/1.1", "\r\n" * 600, "\n\r\n\r" * 300, "0\r\n\r\n" * 400, "日本" * 40_000, "\x00\x85 " * 500, "\r\n\r\nWARC/",
]


@pytest.mark.parametrize("segment_bytes, chunk_bytes", [(32_768, 8192), (37, 5), (1000, 1), (64, 100_000)])
def test_odd_texts(spark, segment_bytes, chunk_bytes):
    """Separators inside payloads, cut characters, copies, repeated rows, null ids and addresses."""
    texts = [t if t is None or segment_bytes > 100 else t[:1500] for t in TEXTS]
    rows = [(k, f"http://x/{k} \r\nA: b", t, 1) for k, t in enumerate(texts)]
    rows += [(100 + k, None, t, 2) for k, t in enumerate(texts)]
    rows += [(100, None, None, 2), (None, None, "b" * 1000, 3), (None, "u", "q" * 1200, 3), (None, "u", "q" * 1200, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, type int")
    df = df.selectExpr("*", "type AS payload", "type AS key", "type AS `a.b`", "type AS origin")
    options = {"segment_bytes": segment_bytes, "chunk_bytes": chunk_bytes}
    assert trip(df, **options) == brute([(r[0], r[2]) for r in rows])
    assert trip(df.limit(0), **options) == Counter()


def test_hot_payload(spark, monkeypatch):
    """A third of all pages are copies; both ways to join give the same."""
    df = spark.range(3000).selectExpr(
        "id AS page_id", "'u' AS url", "CASE WHEN id % 3 = 0 THEN repeat('z', 1500) ELSE repeat(id, 300) END AS html"
    )
    rows = [tuple(r) for r in df.select("page_id", "html").collect()]
    assert trip(df) == brute(rows)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", -1)
    assert trip(df) == brute(rows)


def test_payloads_come_back(spark, tmp_path):
    rows = [(k, f"http://x/{k}", t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(df, path, segment_bytes=500)
    found = warc.read_archives(spark, path).collect()
    assert {int(r.page_id): bytes(r.payload) for r in found} == {k: (t or "").encode() for k, _, t in rows}
    assert all(r.problem is None and r.type == "response" for r in found)
    assert max(r.segments for r in found) > 100


def archive(path, data: bytes, name: str = "a.warc.gz") -> str:
    path.mkdir(exist_ok=True)
    (path / name).write_bytes(gzip.compress(data))
    return str(path)


def record(block: bytes, *fields: str, version: str = "1.0") -> bytes:
    return f"WARC/{version}\r\n{''.join(f + chr(13) + chr(10) for f in fields)}Content-Length: {len(block)}\r\n\r\n".encode() + block + warc.END


BODY = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n4;x=y\r\nabcd\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Another version, order of segments over files, folded fields, members of a gzip file, plain bodies."""
    parts = [BODY[:20], BODY[20:51], BODY[51:]]
    segments = [
        record(parts[0], "warc-type: response", "WARC-Record-ID: <o>", "WARC-Segment-Number: 1"),
        record(parts[1], "WARC-Type: continuation", "WARC-Record-ID: <p>", "WARC-Segment-Origin-ID: <o>", "WARC-Segment-Number: 2"),
        record(parts[2], "WARC-Type: continuation", "WARC-Record-ID: <q>", "WARC-Segment-Origin-ID:\r\n <o>",
               "WARC-Segment-Number: 3", f"WARC-Segment-Total-Length: {len(BODY)}"),
    ]
    info = record(b"software: x", "WARC-Type: warcinfo", "WARC-Record-ID: <i>", version="1.1")
    plain = record(b"HTTP/1.1 200 OK\r\n\r\nplain", "WARC-Type: response", "WARC-Record-ID: <r>")
    path = archive(tmp_path / "w", segments[2] + segments[0], "a.gz")
    (tmp_path / "w" / "b.gz").write_bytes(gzip.compress(info) + gzip.compress(segments[1]) + gzip.compress(plain))
    found = {r.record_id: r for r in warc.read_archives(spark, path).collect()}
    assert set(found) == {"<o>", "<i>", "<r>"}
    assert bytes(found["<o>"].payload) == b"abcd0123456789" and found["<o>"].segments == 3
    assert bytes(found["<r>"].payload) == b"plain" and found["<i>"].payload is None
    assert all(r.problem is None for r in found.values())


def test_broken_archives(spark, tmp_path):
    def seg(number, block, origin="<o>", *more):
        own = "WARC-Type: response" if number == 1 else f"WARC-Segment-Origin-ID: {origin}"
        name = origin if number == 1 else f"{origin}-{number}"
        return record(block, own, f"WARC-Record-ID: {name}", f"WARC-Segment-Number: {number}", *more)

    total = f"WARC-Segment-Total-Length: {len(BODY)}"
    data = b"".join([
        seg(1, BODY[:30], "<missing>"), seg(3, BODY[30:], "<missing>", total),
        seg(1, BODY[:30], "<twice>"), seg(2, BODY[30:], "<twice>", total), seg(2, BODY[30:], "<twice>", total),
        seg(1, BODY[:30], "<short>"), seg(2, BODY[31:], "<short>", total),
        seg(1, BODY[:30], "<endless>"), seg(2, BODY[30:], "<endless>"),
        seg(2, BODY[30:], "<headless>", total),
        b"no record at all" + warc.END,
        record(BODY[:-9], "WARC-Type: response", "WARC-Record-ID: <framing>"),
        record(BODY, "WARC-Type: response", "WARC-Record-ID: <digest>", f"WARC-Payload-Digest: sha1:{'0' * 40}"),
        record(BODY, "WARC-Type: response", "WARC-Record-ID: <block>", f"WARC-Block-Digest: sha1:{'0' * 40}"),
        record(BODY, "WARC-Type: response", "WARC-Record-ID: <good>"),
        record(BODY, "WARC-Type: response", "WARC-Record-ID: <cut>")[:-30],
    ])
    path = archive(tmp_path / "w", data, "a.gz")
    archive(tmp_path / "w", record(BODY, "WARC-Type: response", "WARC-Record-ID: <next>"), "b.gz")
    rows = warc.read_archives(spark, path).collect()
    found = {r.record_id: r.problem for r in rows}
    assert len(rows) == len(found)
    assert found == {
        "<missing>": "segments are missing or repeated",
        "<twice>": "segments are missing or repeated",
        "<short>": "total length differs",
        "<endless>": "total length differs",
        "<headless>": "segments are missing or repeated",
        "<framing>": "broken chunks",
        "<digest>": "payload digest differs",
        "<block>": "block digest differs",
        "<good>": None,
        "<cut>": "the file ends early",
        "<next>": None,
    }


def test_revisit_without_its_response(spark, tmp_path):
    df = spark.createDataFrame([(k, "u", "z" * 2000) for k in (1, 2)], "page_id long, url string, html string")
    path = str(tmp_path / "archives")
    warc.write_archives(df.coalesce(1), path)
    (file,) = glob.glob(f"{path}/*.gz")
    with gzip.open(file) as data:
        revisit = next(r for r in data.read().split(warc.END + b"WARC/") if b"Type: revisit" in r)
    lone = archive(tmp_path / "lone", b"WARC/" + revisit.removeprefix(b"WARC/") + warc.END)
    (row,) = warc.resolved(warc.read_archives(spark, lone)).collect()
    assert (row.page_id, row.type, row.payload_bytes, row.problem) == ("1", "revisit", None, "no response to refer to")
