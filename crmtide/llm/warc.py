"""WARC archives with an index, read back by byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crmtide.llm.common import saved, table
from crmtide.session import shared_dir

FILE_BYTES = 1_000_000_000
RANGE_BYTES = 8_000_000
GAP_BYTES = 64_000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def sha1_base32(column: Column) -> Column:
    """Five hex digits are four digits of base 32, which the alphabet then renames."""
    digest = F.sha1(column)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def plan_records(
    pages: DataFrame,
    least_bytes: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): what each row's record will be.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with
    the largest id is stored, others refer to it; refers_to is NULL for what is
    stored. A NULL html is an empty payload. A row without id refers to its
    payload's largest id, or is stored if no row with that payload has one. Rows
    that repeat the largest id are all stored. Other columns are ignored.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_column).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload")))
    long_enough = F.octet_length("payload") >= least_bytes
    keep = rows.filter(long_enough).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    keep = keep.filter("n > 1").select("digest", "kept")
    refers = F.when(~F.col("kept").eqNullSafe(F.col("page_id")), F.col("kept"))
    joined = rows.join(keep, "digest", "left")
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{uuid.uuid4() if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    tail = (name or "").rstrip(">").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as it stands in the archive before compression; a revisit holds no payload."""
    stored = refers_to is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [VERSION, f"WARC-Type: {'response' if stored else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}"]
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if not stored:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    block = http + payload if stored else http
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's values; the payload's digest and length are taken from the payload where there is one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not the start of a record: {lines[0][:40]!r}")
    named = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(named["Content-Length"])]
    if len(block) != int(named["Content-Length"]):
        raise ValueError("a record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rpartition(b": ")[2])
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    if named["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != stated:
            raise ValueError(f"payload of {named['WARC-Record-ID']} does not match its digest")
    url = named.get("WARC-Target-URI")
    return {
        "page_id": _page(named["WARC-Record-ID"]),
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": named["WARC-Type"],
        "refers_to": _page(named.get("WARC-Refers-To")),
        "payload_bytes": stated,
        "payload_digest": digest,
        "payload": payload if named["WARC-Type"] == "response" else None,
    }


def _writer(folder: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip.compress(record(page_id, url, payload, digest, refers_to), 6, mtime=0)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((name, at, len(member), url, digest, page_id, kind))
                at += len(member)
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            names = ["file", "offset", "length", "url", "digest", "page_id", "record_type"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if out is not None:
            out.close()

    return write


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``plan_records`` into archives below ``folder``; returns the index, saved.

    Each record is a gzip member of its own. A task writes files of its own
    names, and the index is committed by Spark from the attempts that ended, so
    what a lost executor or a second attempt left behind is in no index.
    """
    return saved(records.mapInArrow(_writer(folder), INDEX), "warc-index")


def _reader(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for span in batch.to_pylist():
                with fs.open_input_file(f"{root}/{span['file']}") as file:
                    raw = file.read_at(span["end"] - span["start"], span["start"])
                rows = []
                for one in span["records"]:
                    at = one["offset"] - span["start"]
                    rows.append(parse(gzip.decompress(raw[at : at + one["length"]])))
                columns = [pa.array([r[c] for r in rows], k) for c, k in zip(rows[0], kinds)]
                yield pa.RecordBatch.from_arrays(columns, list(rows[0]))

    return read


def byte_ranges(index: DataFrame) -> DataFrame:
    """(file, start, end, records) to read for the index rows: neighbours in one range, which is bounded."""
    by = Window.partitionBy("file", "chunk").orderBy("offset")
    until = F.lag(F.col("offset") + F.col("length")).over(by)
    begins = F.coalesce((F.col("offset") - until > GAP_BYTES).cast("int"), F.lit(1))
    return (
        index.select("file", "offset", "length", F.floor(F.col("offset") / RANGE_BYTES).alias("chunk"))
        .withColumn("range", begins)
        .withColumn("range", F.sum("range").over(by))
        .groupBy("file", "chunk", "range")
        .agg(
            F.min("offset").alias("start"),
            F.max(F.col("offset") + F.col("length")).alias("end"),
            F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
        )
        .select("file", "start", "end", "records")
    )


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Records of the index rows, whole; a payload that differs from its digest stops the read."""
    return byte_ranges(index).mapInArrow(_reader(folder), RECORD)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    index = write_archives(plan_records(table(spark, sf_dir, "pages", "page_id", "url", "html")), folder)
    return read_archives(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS m FROM p),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(x, 5 * i + 1, 5))::BIGINT >> s) & 31) + 1, 1)), '')), '') AS digest FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> m THEN m END AS refers_to
FROM b
"""
