"""Archives: round trips, framing, and transactions."""

import gzip
import hashlib
import io

import pytest
from cases import rows_of
from conftest import SMALL

from aisflow.llm import queries, warc

BIG = "<p>" + "é\r\n\r\nWARC/1.1\r\n\r\n" * 20
SCHEMA = "page_id long, url string, html string, digest string, payload string, bytes string"
PAGES = [
    (5, "http://a/", BIG), (3, "http://b/ c\r\nX: y", BIG), (9, None, BIG), (1, "http://d/", "short"), (2, "http://d/", "short"), (4, "http://e/", None),
    (6, "http://f/", ""), (7, "u", "x" * 100), (8, "u", "x" * 100), (10, "v", "y" * 99), (11, "v", "y" * 99), (12, "w", "z" * 500_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[data] != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=repr)


def read_back(spark, path):
    records = warc.read(spark, path)
    return warc.page_ids(warc.assemble(records), records)


def digest_rows(spark, path):
    found = read_back(spark, path)
    return rows_of(found.select("page_id", "response.bytes", "response.digest", "response.type", "refers_to"))


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(frame(spark, PAGES), path, file_captures=2)
    assert digest_rows(spark, path) == brute(PAGES)
    rows = {r.page_id: r for r in read_back(spark, path).collect()}
    assert rows[3].response.payload.decode() == BIG and rows[5].response.payload is None and rows[12].response.payload == b"z" * 500_000
    assert rows[3].uri == "http://b/%20c%0D%0AX:%20y" and rows[9].uri is None
    assert rows[1].request.uri == "http://d/" and rows[1].metadata.fields["fetched"] == rows[1].date
    assert rows[5].response.refers_to == rows[3].record_id


def test_shuffled_digests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    path = str(tmp_path / "w")
    warc.write(frame(spark, PAGES), path)
    assert digest_rows(spark, path) == brute(PAGES)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(3, "a", BIG), (3, "a", BIG), (4, "a", BIG)]
    path = str(tmp_path / "w")
    warc.write(frame(spark, rows + [(None, "b", BIG), (None, "b", "q")]), path)
    digest = hashlib.sha256(BIG.encode()).hexdigest()
    size = len(BIG.encode())
    expected = [(3, size, digest, "response", None)] * 2 + [(4, size, digest, "revisit", 3), (None, size, digest, "revisit", 3)]
    expected.append((None, 1, hashlib.sha256(b"q").hexdigest(), "response", None))
    assert digest_rows(spark, path) == sorted(expected, key=repr)


def test_empty_table(spark, tmp_path):
    warc.write(frame(spark, PAGES).limit(0), str(tmp_path / "w"))
    assert digest_rows(spark, str(tmp_path / "w")) == []


def record(kind, record_id, block=b"", *more):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + record_id, b"Content-Length: %d" % len(block), *more]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """One gzip member a record, other types, several or no companions, plain files."""
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nmore"
    kind = b"Content-Type: application/http; msgtype=response"
    parts = [
        record(b"warcinfo", b"<i>", b"software: x\r\n"),
        record(b"request", b"<q2>", b"GET", b"WARC-Concurrent-To: <r1>"),
        record(b"request", b"<q1>", b"GET", b"WARC-Concurrent-To: <r1>"),
        record(b"response", b"<r1>", http, kind),
        record(b"metadata", b"<m>", b"k: v\r\n", b"WARC-Concurrent-To: <gone>"),
    ]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "w" / "b.warc").write_bytes(record(b"response", b"<r2>", http, kind))
    rows = {r.record_id: r for r in warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()}
    assert set(rows) == {"<r1>", "<r2>"}
    assert rows["<r1>"].request.record_id == "<q1>" and rows["<r1>"].metadata is None and rows["<r2>"].request is None
    assert rows["<r2>"].response.payload == b"body\r\n\r\nmore"


def test_broken_archives():
    whole = record(b"response", b"<r>", b"x" * 500)
    for bad in (whole[:300], b"garbage" + whole, gzip.compress(whole)[:-20]):
        with pytest.raises(ValueError):
            list(warc.parse(io.BufferedReader(warc._Unzipped(bad))))


def test_given_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    found = queries.op4_warc_captures(spark, SMALL)
    assert rows_of(found.drop("request_uri")) == brute(rows)
    uris = {page_id: url.replace(" ", "%20") for page_id, url, _ in rows}
    assert {r.page_id: r.request_uri for r in found.collect()} == uris


def test_archives_are_parsed_once_and_requests_are_joined(spark):
    from conftest import plan_of

    plan = plan_of(queries.op4_warc_captures(spark, SMALL))
    assert "MapInArrow" not in plan and "request" in plan and "binaryFile" not in plan


def test_archives_that_only_spark_can_open(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    warc.write(frame(spark, PAGES), path, file_captures=2)
    streamed = rows_of(warc.read(spark, path))
    monkeypatch.setattr(warc.archives, "can_stream", lambda p: False)
    assert rows_of(warc.read(spark, path)) == streamed
    bare = warc.read(spark, path, payloads=False)
    assert rows_of(bare.drop("payload")) == rows_of(warc.read(spark, path).drop("payload")) and bare.where("payload IS NOT NULL").isEmpty()
