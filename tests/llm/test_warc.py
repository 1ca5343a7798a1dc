import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from delaynet.llm import warc
from delaynet.llm.queries import QUERIES

SCHEMA = "page_id bigint, url string, html string, original bigint, payload string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, 7, "x", "y") for i, u, h in rows], SCHEMA).repartition(3)


def reference(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        original = first.get(html or "") if len(payload) >= least else None
        revisit = original is not None and original != i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=str)


def answers(df):
    found = df.select(warc.page_of(F.col("record_id")), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")))
    return sorted((tuple(r) for r in found.collect()), key=str)


ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, "http://c/\r\nX: y", "<p>ünï 東 😀</p>"), (0, "http://d/", "<p>one</p>"),
    (4, None, None), (5, "http://e/", ""), (6, "http://f/", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb\r\n"), (7, "http://g/", "\r\n\r\n"),
    (8, "http://h/", "x" * 300_000), (9, "http://i/", "x" * 300_000), (None, "http://j/", "<p>one</p>"), (None, "http://k/", "only without an id"),
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (-3, "http://l/", "\nline"),
]


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_awkward_rows(spark, tmp_path, least):
    assert answers(warc.archive(frame(spark, ROWS), str(tmp_path / "w"), least)) == reference(ROWS, least)


def test_archives_hold_the_format(spark, tmp_path):
    warc.archive(frame(spark, ROWS), str(tmp_path / "w"))
    found = []
    for file in Path(tmp_path / "w").glob("*.gz"):
        content = gzip.decompress(file.read_bytes())
        records = list(warc.parsed(io.BufferedReader(io.BytesIO(content))))
        assert content.count(b"WARC-Record-ID: ") == len(records)
        found += records
    assert len(found) == len(ROWS)
    for head, block in found:
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        if head["WARC-Type"] == "revisit":
            assert payload == b"" and head["WARC-Profile"] == warc.IDENTICAL_PAYLOAD
            assert head["WARC-Refers-To"] in {h["WARC-Record-ID"] for h, _ in found if h["WARC-Type"] == "response"}
        else:
            assert base64.b32encode(hashlib.sha1(payload).digest()).decode() == head["WARC-Payload-Digest"].removeprefix("sha1:")


def test_payloads_come_back_whole(spark, tmp_path):
    revisits = warc.resolve(warc.headers(frame(spark, ROWS)))
    warc.write_archives(warc.records(frame(spark, ROWS), revisits), str(tmp_path / "w"))
    found = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, str(tmp_path / "w")).collect() if r.payload is not None}
    expected = {}
    for i, _, html in ROWS:
        expected.setdefault(f"<urn:page:{'none' if i is None else i}>", set()).add((html or "").encode())
    assert all(payload in expected[record] for record, payload in found.items())


def test_no_pages(spark, tmp_path):
    assert warc.archive(frame(spark, []), str(tmp_path / "w")).collect() == []


def test_query_over_all_pages(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    found = QUERIES["op8_warc_revisits"](spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in found.collect()), key=str) == reference(rows)
