"""WARC round trips, broken archives, odd pages."""

import base64
import gzip
import hashlib

import pytest

from hostgrain.llm import warc_segments as w
from hostgrain.llm.storage import work_dir


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_chunked_framing():
    for n in (0, 1, 7, 8, 9, 100):
        body = bytes(range(256))[:n]
        assert w.decode_chunked(w._chunked(body, 8)) == body
    assert w.decode_chunked(b"5;x=y\r\nhello\r\n0\r\n\r\n") == b"hello"
    assert w.decode_chunked(b"5\r\nhel") is None and w.decode_chunked(b"zz\r\n") is None
    assert w.http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain" and w.http_payload(b"no header") is None


def test_round_trip_of_odd_pages(spark):
    texts = [None, "", "short é", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "0\r\n\r\n", "long ä " * 3000, "long ä " * 3000, "ü" * 5000]
    rows = [(i, f"http://x/ {i}\r\nWARC-Type: evil", t, "clash") for i, t in enumerate(texts)] + [(None, None, "orphan", "clash"), (2, "http://x", "short é", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha string")
    path = work_dir(spark, "warc")
    w.write_archives(pages, path, segment_bytes=2000, chunk_bytes=300, records_per_archive=4)
    got = w.read_archives(spark, path).collect()
    assert len(got) == len(rows) and all(r["complete"] for r in got)
    number = lambda s: None if s in (None, "") else int(s)
    found = {number(r["record_id"][10:-1].split(":")[0]): r for r in got}
    for i, t in enumerate(texts):
        assert found[i]["payload_digest"] == digest(t) and found[i]["payload_bytes"] == len((t or "").encode())
    kinds = {i: (r["record_type"], r["refers_to"]) for i, r in found.items()}
    assert kinds[0] == ("revisit", "<urn:page:1>") and kinds[1][0] == "response"
    assert kinds[5] == ("revisit", "<urn:page:6>") and kinds[6][0] == "response" and found[6]["segments"] > 5
    assert kinds[None][0] == "response"


def test_lost_or_swapped_segments_are_noticed(spark, tmp_path):
    records = w.page_records(1, "http://x", "abc" * 2000, 0, None, 1000, 300)
    assert len(records) > 4
    for name, kept in (("whole", records[::-1]), ("lost", records[:2] + records[3:]), ("no end", records[:-1]), ("no start", records[1:])):
        folder = tmp_path / name
        folder.mkdir()
        for i, r in enumerate(kept):  # each segment in an archive of its own
            (folder / f"{i}.warc.gz").write_bytes(gzip.compress(r + b"\r\n\r\n"))
        row = w.read_archives(spark, f"file://{folder}").collect()[0]
        assert row["complete"] == (name == "whole")
        assert row["payload_digest"] == (digest("abc" * 2000) if name == "whole" else None)


def test_no_pages(spark):
    path = work_dir(spark, "warc")
    w.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert w.read_archives(spark, path).count() == 0


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = work_dir(spark, "warc")
    w.write_archives(pages, path, min_revisit_bytes=3)
    assert sorted(r["record_type"] for r in w.read_archives(spark, path).collect()) == ["response"] * 3 + ["revisit"]


@pytest.mark.parametrize("text", ["", "x", "é" * 10])
def test_digest(text):
    assert w.base32_digest(text.encode()) == digest(text)


@pytest.mark.parametrize("heavy", [1, 1000])
def test_frequent_and_other_repeated_payloads(spark, monkeypatch, heavy):
    monkeypatch.setattr(w, "HEAVY", heavy)
    texts = ["once", "", "twice", "", "thrice", "twice", "thrice", "", "thrice", None, "alone"]
    pages = spark.createDataFrame([(i, "u", t, 0) for i, t in enumerate(texts)], "page_id long, url string, html string, n int")
    path = work_dir(spark, "warc")
    w.write_archives(pages, path)
    found = {int(r["record_id"][10:].split(":")[0]): r["refers_to"] for r in w.read_archives(spark, path).collect()}
    last = {(t or ""): i for i, t in enumerate(texts)}
    assert found == {i: None if last[t or ""] == i else f"<urn:page:{last[t or '']}>" for i, t in enumerate(texts)}
