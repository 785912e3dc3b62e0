import hashlib

import pytest

from tallyhouse.llm import warc

LARGE = "<p>" + "text " * 300 + "</p>"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    by = {}
    for page, _, html in rows:
        by.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        known = [p for p in by[html or ""] if p is not None]
        first = max(known) if known and len(data) >= 1000 else page
        revisit = page is not None and first != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a", LARGE),
    (2, "http://b", LARGE),
    (3, "http://c\r\nX: y", LARGE + "é漢"),
    (4, None, None),
    (5, "http://e", ""),
    (6, "http://f", "short"),
    (7, "http://g", "short"),
    (8, "http://h", FAKE),
    (9, "http://i", "before " + FAKE * 40 + LARGE),
    (10, "http://j", "WARC/1.0\r\n" * 200),
    (11, "http://k", "no header WARC/1.0\r\nContent-Length: 99999999\r\n\r\n" + LARGE),
    (12, "http://l", "long " * 60_000 + FAKE + "tail\r\n\r\n"),
    (None, "http://m", LARGE),
]


@pytest.mark.parametrize("split", ["64m", "4k", "700b"])
def test_round_trip_with_magic_in_payloads(spark, tmp_path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.round_trip(pages(spark, ROWS).coalesce(2), str(tmp_path / "w")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((tuple(r) for r in got), key=repr) == expected(ROWS)


def test_records_carry_their_payloads(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), str(tmp_path / "w"))
    records = warc.read_archives(spark, str(tmp_path / "w"))
    bodies = sorted(bytes(r.payload) for r in records.collect())
    assert bodies == sorted(b"" if e[3] == "revisit" else (dict((r[0], r[2]) for r in ROWS)[e[0]] or "").encode() for e in expected(ROWS))


def test_without_broadcast_and_on_foreign_files(spark, tmp_path):
    head = b"WARC/1.0\r\nContent-Length: %d\r\nWARC-Type: resource\r\n\r\n"
    good = b"".join(head % len(b) + b + b"\r\n\r\n" for b in (b"one", b"\xff\x00two", b""))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(good)
    (tmp_path / "in" / "b.warc").write_bytes(good + head % 1000 + b"cut off")
    (tmp_path / "in" / "c.warc").write_bytes(b"")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = warc.read_archives(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    complete = sorted((r.file[-6:], bytes(r.payload)) for r in got if not bytes(r.payload).startswith(b"cut"))
    assert complete == sorted((f, b) for f in ("a.warc", "b.warc") for b in (b"one", b"\xff\x00two", b""))


def test_empty_table_ties_and_other_columns(spark, tmp_path):
    assert warc.round_trip(pages(spark, []), str(tmp_path / "none")).count() == 0
    rows = [(1, "u", LARGE, "x")] * 2 + [(0, "u", LARGE, "y")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = sorted((tuple(r) for r in warc.round_trip(docs, str(tmp_path / "ties")).collect()), key=repr)
    assert [(r[0], r[3], r[4]) for r in got] == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


def test_sample_pages(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in source.collect()]
    got = warc.round_trip(source, str(tmp_path / "w")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)
