"""WARC writing and reading, segment reassembly, transfer framing."""

import base64
import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from dialstat.llm import warc as W
from dialstat.llm.staging import stage_path
from odd import rows_of


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, pages, schema="page_id long, url string, html string, row long, sha1 string", **options):
    path = stage_path(spark, "warc-test")
    W.write_warc(spark.createDataFrame(pages, schema).repartition(3), path, **options)
    return path, rows_of(W.read_warc(spark, path, keep_payload=True))


def test_pages_come_back(spark):
    rng = random.Random(1)
    big = "".join(rng.choice("abé日\r\n\r\nWARC/1.1 <p>") for _ in range(60_000))
    pages = [
        (5, "http://a/b c\r\nX: y", big, 0, ""),
        (3, "http://a/", big, 0, ""),
        (9, None, None, 0, ""),
        (8, "http://b/", "", 0, ""),
        (None, "http://c/", "", 0, ""),
        (7, "http://d/ü?q=1", "<p>once</p>", 0, ""),
        (6, "http://e/", "twice", 0, ""),
        (6, "http://e/", "twice", 0, ""),  # a repeated row
        (6, None, "twice", 0, ""),  # the id and payload again, with another url
        (10, "http://f/", "twice", 0, ""),
        (None, None, "only a null id", 0, ""),
    ]
    _, got = round_trip(spark, pages)
    assert len(got) == len(pages) and all(r["problem"] is None for r in got)
    key = lambda r: (str(r[0]), r[1], str(r[2]), r[3])
    want = [
        (5, "revisit", 3, b32(big)),
        (3, "response", None, b32(big)),
        (9, "revisit", 8, b32("")),
        (8, "response", None, b32("")),
        (None, "revisit", 8, b32("")),
        (7, "response", None, b32("<p>once</p>")),
        (6, "response", None, b32("twice")),
        (6, "revisit", 6, b32("twice")),
        (6, "revisit", 6, b32("twice")),
        (10, "revisit", 6, b32("twice")),
        (None, "response", None, b32("only a null id")),
    ]
    assert sorted(((r["page_id"], r["type"], r["refers_page"], r["payload_digest"]) for r in got), key=key) == sorted(want, key=key)
    by = {r["page_id"]: r for r in got if r["type"] == "response"}
    assert by[3]["payload"].decode() == big and by[3]["payload_bytes"] == len(big.encode())
    assert {r["url"] for r in got} >= {"http://a/b%20c%0D%0AX:%20y", "about:blank", "http://d/%C3%BC?q=1"}


def test_least_revisit_and_empty_tables(spark):
    pages = [(1, "u", "aa", 0, ""), (2, "u", "aa", 0, ""), (3, "u", "bbbb", 0, ""), (4, "u", "bbbb", 0, "")]
    _, got = round_trip(spark, pages, least_revisit=3)
    assert sorted((r["page_id"], r["type"], r["refers_page"]) for r in got) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)
    ]
    path, got = round_trip(spark, [])
    assert got == []


def test_small_segments_are_continuations(spark):
    html = "x" * 5000
    path, got = round_trip(spark, [(1, "u", html, 0, "")], segment=512)
    assert got[0]["payload"] == html.encode() and got[0]["problem"] is None
    raw = b"".join(gzip.decompress(r["content"]) for r in rows_of(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)))
    records = list(W.records_of(raw))
    assert [h["warc-type"] for h, _ in records] == ["response"] + ["continuation"] * (len(records) - 1)
    assert [h["warc-segment-number"] for h, _ in records] == [str(i + 1) for i in range(len(records))]
    assert int(records[-1][0]["warc-segment-total-length"]) == sum(len(b) for _, b in records)
    assert max(len(b) for _, b in records) <= 512


def _archive(spark, records):
    """Records as files of two, in the given order."""
    path = stage_path(spark, "foreign")
    rows = [(i // 2, r) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "f int, record binary").repartition(5, "f").sortWithinPartitions("f")
    df.selectExpr("cast(record as string)").write.option("lineSep", W.RECORD_END).option("compression", "gzip").text(path)
    return rows_of(W.read_warc(spark, path, keep_payload=True))


def test_segments_from_any_file_in_any_order_and_what_is_wrong_with_them(spark):
    def page(n, html):
        return W.page_records(n, "u", html, W.payload_digest(html), False, True, 64)

    whole, gap, headless, tailless, long = (page(n, bytes([65 + n]) * 300) for n in range(5))
    assert len(whole) > 4
    long[-1] = long[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    forged = W.page_records(7, "u", b"abc", W.payload_digest(b"abd"), False, True, 10_000)
    broken = [W.page_records(8, "u", b"abc", W.payload_digest(b"abc"), False, True, 10_000)[0].replace(b"3\r\nabc", b"9\r\nabc")]
    orphan = W.page_records(9, "u", None, W.payload_digest(b"q"), True, True, 100)
    records = whole + gap[:2] + gap[3:] + headless[1:] + tailless[:-1] + long + forged + broken + orphan
    random.Random(2).shuffle(records)
    got = {(r["type"], r["page_id"]): r for r in _archive(spark, records)}
    assert got["response", 0]["payload"] == b"A" * 300 and got["response", 0]["problem"] is None
    problems = {k: r["problem"] for k, r in got.items() if r["problem"]}
    assert problems == {
        ("response", 1): "a segment is missing or doubled",
        (None, None): "a segment is missing or doubled",
        ("response", 3): "the last segment is missing",
        ("response", 4): "total length differs",
        ("response", 7): "payload digest differs",
        ("response", 8): "chunk cut off",
        ("revisit", 9): "the record referred to is missing",
    }


def test_framing():
    for size in (0, 1, 8191, 8192, 8193, 30_000):
        body = bytes(i % 251 for i in range(size))
        assert W.unchunked(W.chunked(body)) == body
    assert W.unchunked(b"3;name=x\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"zz\r\nab\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(broken)
    with pytest.raises(ValueError):
        list(W.records_of(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab\r\n\r\n"))
    assert pa.types.is_binary(W._FOUND.field("block").type)
