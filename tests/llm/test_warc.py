import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string, payload long"


def pages():
    rnd = random.Random(3)
    big = "".join(rnd.choice("abc é<>\r\n") for _ in range(60000))
    rows = [(1, "http://a/", big), (2, "http://b/", big), (9, None, big), (3, "http://c/", None), (4, "", ""), (5, "u\r\nX: y", "x\r\n\r\ny" * 10),
            (6, "http://d/", "s" * 999), (7, "http://e/", "s" * 999), (8, "http://f/", "t" * 1000), (10, "http://g/", "t" * 1000),
            (10, "http://g/", "t" * 1000), (None, "http://h/", "t" * 1000), (11, "http://i/", "WARC/1.1\r\n\r\n" * 3000), (12, "x", "你" * 9000),
            (None, "n", "u" * 2000), (None, "n", "u" * 2000)]
    return [(*r, "clash", 0) for r in rows]


def brute(rows):
    payload = [(r[2] or "").encode() for r in rows]
    n, top = Counter(payload), {}
    for r, p in zip(rows, payload):
        if r[0] is not None:
            top[p] = max(r[0], top.get(p, r[0]))
    out = []
    for r, p in zip(rows, payload):
        revisit = len(p) >= 1000 and n[p] > 1 and p in top and r[0] != top[p]
        out.append((r[0], len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", top[p] if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = pages()
    got = warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_segments_and_files(spark, tmp_path):
    rows = pages()
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path, segment_bytes=500, records_per_file=40)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    parsed = [list(warc.parse(gzip.decompress(bytes(f.content)))) for f in files if f.length]
    assert len(parsed) > 5 and max(map(len, parsed)) <= 40
    assert max(len(b) for p in parsed for _, b in p) <= 500
    assert any(h[b"WARC-Type"] == b"continuation" for p in parsed for h, _ in p)
    back = warc.read_archives(spark, path)
    got = sorted(((int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_sha1, r.record_type, int(r.refers_to) if r.refers_to else None)
                  for r in back.collect()), key=str)
    assert got == brute(rows)


def test_lost_segment_is_an_error(spark):
    payload = b"x" * 5000
    name = hashlib.sha1(payload).hexdigest()
    made = [warc._row(h, b) for r in warc.records("1", None, payload, name, None, "0-1", 1000) for h, b in warc.parse(r + warc.END)]
    whole = spark.createDataFrame(made, warc.RECORD_SCHEMA)
    assert warc.reassemble(whole).first().payload_bytes == 5000
    for lost in (1, 3, len(made)):
        with pytest.raises(Exception, match="not whole"):
            warc.reassemble(whole.where(F.col("segment") != lost)).collect()


def test_chunked_framing():
    for payload in (b"", b"a", b"x\r\n0\r\n\r\n" * 1000):
        for size in (1, 7, 4096):
            assert warc.dechunk(warc.HTTP_HEAD + warc.chunked(payload, size)) == payload
