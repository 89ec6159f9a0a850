"""WARC archives with an index that comes first, and readers that fetch byte ranges.

Every record is a gzip member of its own, as is usual for archives. Tasks write archives of bounded size and return the
index (archive, offset, length, URL, digest), which Spark commits; archives of attempts that were lost have other names
and no index row names them. A reader selects index rows, merges neighbouring ranges, and reads each merged range with
one request. Archives go through ``pyarrow.fs``, so their folder must be one that it can open.

Defined cases: a null payload is an empty one; a null URL leaves out the header; control characters and blanks in URLs are
escaped in the header, not in the index; a null page_id is written as ``none`` and is never the response of a
group with others; rows that tie on the largest page_id are all responses; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillrank.workspace import Workspace

ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
# The base-32 alphabet, beside the digits that Spark's conv() uses.
_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: five hexadecimal digits are four digits here."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _CONV, _BASE32)


def _page(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _http_header(size: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))


def _header(date: str) -> Column:
    """Header of a record, up to the block, from ``page_id url digest payload_bytes record_type refers_to``."""
    is_revisit = F.col("record_type") == "revisit"
    block = F.length(_http_header(F.col("payload_bytes"))) + F.when(is_revisit, 0).otherwise(F.col("payload_bytes"))
    revisit = F.concat(
        F.lit("\r\nWARC-Refers-To: "),
        _page(F.col("refers_to")),
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
    )
    uri = F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        "record_type",
        F.lit("\r\nWARC-Record-ID: "),
        _page(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        "digest",
        F.when(is_revisit, revisit).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block,
        F.lit(END),
        _http_header(F.col("payload_bytes")),
    )


def write_archives(
    pages: DataFrame, path: str, workspace: Workspace, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE
) -> DataFrame:
    """Write ``pages`` (``page_id url html``) as archives below ``path`` and return the index.

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page_id is the response, the others
    revisit it. Index: ``(archive, offset, length, page_id, url, digest)``.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("key"),
        base32_sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    responses = known.groupBy("key").agg(F.max("page_id").alias("response"))
    is_response = (F.col("payload_bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("response"))
    typed = known.join(responses, "key").withColumn("record_type", F.when(is_response, "response").otherwise("revisit"))
    typed = typed.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("response")))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    rows = typed.select("page_id", "url", "digest", _header(date).alias("header"), block.alias("payload"))
    kept = rows.schema["page_id"], rows.schema["url"], rows.schema["digest"]
    places = [T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Archives(path, archive_bytes)
        try:
            for batch in batches:
                headers, payloads = batch.column("header"), batch.column("payload")
                found = [files.append(h.as_py() + p.as_py() + END) for h, p in zip(headers, payloads)]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.int64()))]
                names = ["page_id", "url", "digest"]
                if found:
                    yield pa.RecordBatch.from_arrays(columns + [batch.column(n) for n in names], names=["archive", "offset", "length", *names])
        finally:
            files.close()

    return workspace.save(rows.mapInArrow(write, T.StructType([*places, *kept])), "index")


class Archives:
    """The archives that one attempt of a task writes. Names tell attempts apart, so none overwrites another's."""

    def __init__(self, path: str, archive_bytes: int):
        self.path, self.archive_bytes = path, archive_bytes
        self.file, self.name, self.offset, self.number = None, "", 0, 0

    def append(self, record: str) -> tuple[str, int, int]:
        """Write a record as a gzip member of its own; returns ``(archive, offset, length)``."""
        if self.file is None or self.offset >= self.archive_bytes:
            self.close()
            self.name = f"{self.path}/part-{TaskContext.get().taskAttemptId():08d}-{uuid.uuid4().hex[:8]}-{self.number:04d}.warc.gz"
            store, inside = _store(self.path)
            store.create_dir(inside, recursive=True)
            self.file, self.offset, self.number = store.open_output_stream(_store(self.name)[1], compression=None), 0, self.number + 1
        data = gzip.compress(record.encode("utf-8", "surrogateescape"), mtime=0)
        self.file.write(data)
        place = self.name, self.offset, len(data)
        self.offset += len(data)
        return place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def merged_ranges(index: DataFrame, gap_bytes: int = GAP_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(archive, start, end, records)``: neighbouring records in one range, unless more than ``gap_bytes`` lie between
    them or it gets larger than about ``range_bytes``. ``records`` are ``(offset, length)``, in order."""
    w = Window.partitionBy("archive").orderBy("offset")
    end = F.col("offset") + F.col("length")
    before = index.select("archive", "offset", "length", F.lag(end).over(w).alias("was"), F.lag("offset").over(w).alias("from"))
    piece = lambda c: F.floor(F.col(c) / F.lit(range_bytes))
    is_new = F.col("was").isNull() | (F.col("offset") - F.col("was") > gap_bytes) | (piece("offset") != piece("from"))
    numbered = before.withColumn("range", F.sum(is_new.cast("long")).over(w))
    return numbered.groupBy("archive", "range").agg(
        F.min("offset").alias("start"),
        F.max(end).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def _store(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if colon and not rest.startswith("//"):
        path = f"{scheme}://{rest}"
    return fs.FileSystem.from_uri(path)


def parse_record(record: bytes) -> dict:
    """The fields of one record; a response's payload must have the digest that its header states."""
    head, _, block = record.removesuffix(END.encode()).partition(END.encode())
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block.partition(END.encode())
    number = lambda urn: None if urn is None or urn == "<urn:page:none>" else int(urn[len("<urn:page:") : -1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    if len(block) != int(fields["Content-Length"]):
        raise ValueError(f"block of {fields['WARC-Record-ID']} has {len(block)} bytes")
    if fields["WARC-Type"] == "response" and (
        len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
    ):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have the digest {digest}")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "uri": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload.decode("utf-8", "surrogateescape") if fields["WARC-Type"] == "response" else None,
    }


FIELDS = "page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string"


def read_records(index: DataFrame, payloads: bool = True, gap_bytes: int = GAP_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records that ``index`` (all of it, or selected rows) names, read from their archives; see ``FIELDS``."""
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = merged_ranges(index, gap_bytes, range_bytes).repartition(tasks, "archive", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                store, inside = _store(row.archive)
                with store.open_input_file(inside) as file:
                    file.seek(row.start)
                    data = file.read(row.end - row.start)
                found = []
                for record in row.records:
                    at = record["offset"] - row.start
                    found.append(parse_record(gzip.decompress(data[at : at + record["length"]])))
                out = pd.DataFrame(found).astype({"page_id": "Int64", "refers_to": "Int64"})
                yield out if payloads else out.drop(columns="payload")

    fields = FIELDS if payloads else FIELDS.rsplit(",", 1)[0]
    return ranges.select("archive", "start", "end", "records").mapInPandas(read, fields)
