import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from quillrank import Workspace
from quillrank.llm.warc import merged_ranges, parse_record, read_records, write_archives

SCHEMA = "page_id long, url string, html string, archive string, key int, digest string"
PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/4 b\r\nX: y", ""), (5, "u", None),
    (6, "u", "é" * 3000 + "\r\n\r\nWARC/1.1"), (7, "u", "\r\n\r\n"), (None, "n", "same"), (None, "n", "only"), (8, "t", "tie"), (8, "t", "tie"),
    *[(100 + i, f"http://b/{i}", f"page {i} " * 50) for i in range(200)],
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages, min_bytes=0):
    out = []
    for page, _, html in pages:
        group = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        last = max(group, default=None)
        is_response = len((html or "").encode()) < min_bytes or page == last
        out.append((page, len((html or "").encode()), sha(html), "response" if is_response else "revisit", None if is_response else last))
    return sorted(out, key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "x", 1, None) for p in pages], SCHEMA)


@pytest.mark.parametrize("min_bytes, archive_bytes, range_bytes", [(0, 1 << 20, 1 << 20), (5, 500, 300)])
def test_round_trip(spark, min_bytes, archive_bytes, range_bytes):
    with Workspace(spark) as workspace:
        index = write_archives(frame(spark, PAGES), workspace.folder("warc"), workspace, min_bytes, archive_bytes)
        rows = read_records(index, range_bytes=range_bytes).collect()
        assert index.count() == len(PAGES)
        got = sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows], key=repr)
        assert got == expected(PAGES, min_bytes)
        texts = {p: h or "" for p, _, h in PAGES}
        assert all(r["payload"] == texts[r["page_id"]] for r in rows if r["record_type"] == "response" and r["page_id"])
        assert {r["uri"] for r in rows if r["page_id"] == 4} == {"http://a/4%20b%20%20X:%20y"} and {r["uri"] for r in rows if r["page_id"] == 3} == {None}
        some = read_records(index.where("page_id between 120 and 130"), range_bytes=range_bytes)
        assert sorted(r["page_id"] for r in some.collect()) == list(range(120, 131))


def test_ranges_are_merged(spark):
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 7)]
    index = spark.createDataFrame(rows, "archive string, offset long, length long")
    got = sorted((r["archive"], r["start"], r["end"], len(r["records"])) for r in merged_ranges(index, gap_bytes=5).collect())
    assert got == [("a", 0, 30, 3), ("a", 100, 105, 1), ("b", 0, 7, 1)]


def test_archives_are_plain_gzip(spark):
    with Workspace(spark) as workspace:
        index = write_archives(frame(spark, PAGES[:4]).coalesce(1), workspace.folder("warc"), workspace).collect()
        total = b"".join(gzip.open(name.removeprefix("file:"), "rb").read() for name in {r["archive"] for r in index})
    assert total.count(b"WARC/1.1\r\n") == 4 and total.endswith(b"\r\n\r\n")


def test_wrong_digest_is_found(spark):
    with Workspace(spark) as workspace:
        row = write_archives(frame(spark, [(1, "u", "text")]), workspace.folder("warc"), workspace).first()
        record = gzip.open(row["archive"].removeprefix("file:"), "rb").read()
    assert parse_record(record)["payload"] == "text"
    with pytest.raises(ValueError):
        parse_record(record.replace(b"text\r\n\r\n", b"tex?\r\n\r\n"))


def test_empty(spark):
    with Workspace(spark) as workspace:
        index = write_archives(frame(spark, []), workspace.folder("warc"), workspace)
        assert index.count() == 0 and read_records(index).count() == 0
