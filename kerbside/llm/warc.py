"""WARC archives: writing, and reading with segment reassembly (operator 9).

Writing. Each page becomes a record: a ``response`` whose block is an HTTP
response in chunked transfer framing, or, if another record has the same
payload, a ``revisit`` that refers to it. Blocks longer than ``segment_bytes``
are split: the first record is segment 1, ``continuation`` records name it as
their origin, and the last one carries the total length. Records are cut to a
bounded size and archives to a bounded number of records, so an archive is
small enough to be one task's input. Spark's text writer puts them into the
shared folder, gzip-compressed.

Reading. Spark's binary reader hands archives to the parser. Records without
segments are decoded on the spot; segments are grouped by origin identifier,
ordered by number, checked against the total length, joined and decoded.
Revisits take size and digest from the record that they refer to.

Cases: a NULL payload is an empty payload; a NULL url leaves the header out; a
NULL id is an empty id in the record's name and comes back NULL; among equal
payloads of ``min_revisit`` bytes or more all rows with the largest id are
responses (repeated rows keep records of their own) and the others revisits;
without any id all are responses; an empty table writes an empty archive and
gives no rows; other columns of the input are not read. A record whose
segments are missing, or whose length or digest differs, is an error: it
raises, and does not vanish from the result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, settle, slices
from kerbside.session import scratch_path

CRLF = b"\r\n"
END = b"\r\n\r\n"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD_SCHEMA = ("record_id string, page_id string, record_type string, refers_to string, payload_sha1 string, "
                 "payload_bytes long, segment int, total_length long, block binary")


def chunked(payload: bytes, size: int = 4096) -> bytes:
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", END])


def dechunk(block: bytes) -> bytes:
    """The payload of an HTTP response in chunked framing."""
    at = block.index(END) + 4
    parts = []
    while True:
        line_end = block.index(CRLF, at)
        size = int(block[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        if block[at + size:at + size + 2] != CRLF:
            raise ValueError("chunk without an end")
        parts.append(block[at:at + size])
        at += size + 2


def _record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = b"".join(k + b": " + v + CRLF for k, v in headers)
    return VERSION + CRLF + head + b"Content-Length: %d" % len(block) + END + block


def records(page_id: str, url: bytes | None, payload: bytes, sha1: str, refers_to: str | None, serial: str,
            segment_bytes: int) -> list[bytes]:
    """The records of one page, without the two line ends that close each."""
    name = f"<urn:page:{page_id}:{sha1}:{serial}>".encode()
    common = [(b"WARC-Date", DATE)]
    if url is not None:
        common.append((b"WARC-Target-URI", url.replace(b"\r", b"%0D").replace(b"\n", b"%0A")))
    digest = (b"WARC-Payload-Digest", b"sha1:" + base64.b32encode(bytes.fromhex(sha1)))
    kind = (b"Content-Type", b"application/http; msgtype=response")
    if refers_to is not None:
        return [_record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", name), *common, digest, kind,
                         (b"WARC-Profile", PROFILE), (b"WARC-Refers-To", f"<urn:page:{refers_to}:{sha1}>".encode())], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    first = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", name), *common, digest, kind]
    if len(block) <= segment_bytes:
        return [_record(first, block)]
    out = [_record([*first, (b"WARC-Segment-Number", b"1")], block[:segment_bytes])]
    for n, i in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        headers = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", name[:-1] + b":%d>" % n), *common,
                   (b"WARC-Segment-Origin-ID", name), (b"WARC-Segment-Number", b"%d" % n)]
        if i + segment_bytes >= len(block):
            headers.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(_record(headers, block[i:i + segment_bytes]))
    return out


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 1000, segment_bytes: int = 16384, records_per_file: int = 1500) -> None:
    """Write one record (or its segments) per row under ``path``.

    Which rows revisit follows from one aggregate per payload digest; only
    digests that occur more than once come to the join. A digest with very
    many rows reaches that aggregate as one row per task, and in the join it
    is one that adaptive execution can split."""
    payload = F.coalesce(as_bytes(payload_col), F.lit(b""))
    pages = df.select(F.col(id_col).alias("page_id"), as_bytes(url_col).alias("url"), payload.alias("payload")).withColumn(
        "sha1", F.sha1("payload"))
    shared = (pages.where(F.octet_length("payload") >= min_revisit).groupBy("sha1")
              .agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    marked = pages.join(shared, "sha1", "left")
    revisits = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 2):
            out = []
            for page, url, body, sha1, refers in zip(*(c.to_pylist() for c in batch.columns)):
                n += 1
                out += records(page or "", url, body or b"", sha1, refers, f"{part}-{n}", segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    made = marked.select(F.col("page_id").cast("string").alias("page"), "url",
                         F.when(~revisits, F.col("payload")).alias("body"), "sha1",
                         F.when(revisits, F.col("origin").cast("string")).alias("refers")).mapInArrow(run, "record binary")
    (made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode())
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse(data: bytes):
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head_end = data.index(END, at)
        lines = data[at:head_end].split(CRLF)
        if lines[0] != VERSION:
            raise ValueError("not a record")
        headers = dict(x.split(b": ", 1) for x in lines[1:])
        at = head_end + 4 + int(headers[b"Content-Length"])
        if data[at:at + 4] != END:
            raise ValueError("record length differs")
        yield headers, data[head_end + 4:at]
        at += 4


def _checked(block: bytes, sha1: str) -> int:
    payload = dechunk(block)
    if hashlib.sha1(payload).hexdigest() != sha1:
        raise ValueError("payload digest differs")
    return len(payload)


def _row(headers: dict, block: bytes) -> tuple:
    text = lambda k: headers[k].decode() if k in headers else None
    kind, name = text(b"WARC-Type"), text(b"WARC-Segment-Origin-ID") or text(b"WARC-Record-ID")
    page = name[1:-1].split(":")[2] or None
    digest = text(b"WARC-Payload-Digest")
    sha1 = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
    segment = int(headers.get(b"WARC-Segment-Number", b"0"))
    total = int(headers[b"WARC-Segment-Total-Length"]) if b"WARC-Segment-Total-Length" in headers else None
    if segment:
        return name, page, kind, None, sha1, None, segment, total, block
    if kind == "revisit":
        refers = text(b"WARC-Refers-To")[1:-1].split(":")[2]
        return name, page, kind, refers, sha1, None, 0, None, None
    return name, page, kind, None, sha1, _checked(block, sha1), 0, None, None


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path``; those of a segmented record one
    row per segment with its block, the others decoded."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                yield _arrow([_row(h, b) for h, b in parse(data)])

    # The text writer leaves a lone line end in a file without rows.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def reassemble(parts: DataFrame) -> DataFrame:
    """Segments -> one decoded row per origin. A group is one record: what it
    gathers is a single page's block."""
    joined = parts.groupBy(F.col("record_id")).agg(
        F.first("page_id").alias("page_id"), F.max("payload_sha1").alias("payload_sha1"), F.max("total_length").alias("total_length"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("pieces"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, page, sha1, total, pieces = (c[i].as_py() for c in batch.columns)
                block = b"".join(p["block"] for p in pieces)
                if [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1)) or total != len(block):
                    raise ValueError(f"segments of {name} are not whole")
                yield _arrow([(name, page, "response", None, sha1, _checked(block, sha1), 0, total, None)])

    return joined.select("record_id", "page_id", "payload_sha1", "total_length", "pieces").mapInArrow(run, RECORD_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record: page_id (string), record_type, refers_to,
    payload_sha1 and payload_bytes, for revisits those of the full payload."""
    seen = settle(read_records(spark, path), "records")
    whole = seen.where("segment = 0").unionByName(reassemble(seen.where("segment > 0")))
    columns = ["page_id", "record_type", "refers_to", "payload_sha1", "payload_bytes"]
    responses = whole.where("record_type = 'response'").select(columns)
    sizes = (responses.groupBy(F.col("page_id").alias("origin"), F.col("payload_sha1").alias("origin_sha1"))
             .agg(F.max("payload_bytes").alias("origin_bytes")))
    revisits = seen.where("record_type = 'revisit'").select(columns)
    resolved = revisits.join(sizes, (revisits.refers_to == sizes.origin) & (revisits.payload_sha1 == sizes.origin_sha1), "left")
    return responses.unionByName(resolved.select("page_id", "record_type", "refers_to", "payload_sha1",
                                                 F.col("origin_bytes").alias("payload_bytes")))


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives to the shared folder, read them back, one row per page."""
    spark = df.sparkSession
    kind = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    path = scratch_path(spark, "warc")
    write_archives(df, path, id_col, url_col, payload_col)
    back = read_archives(spark, path)
    return back.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", F.col("payload_sha1").alias("payload_digest"),
                       "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
