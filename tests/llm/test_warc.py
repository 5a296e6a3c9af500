import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from lodestone.llm import warc
from lodestone.llm.common import shared_dir


def brute(rows, least=0):
    out = []
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        same = [(p is not None, p or 0, -j) for j, (p, _, h) in enumerate(rows) if (h or "").encode() == data]
        first = max(same)
        page_first = rows[-first[2]][0]
        kind = "response" if len(data) < least or sum(x[:2] == first[:2] for x in same) == 1 and page == page_first else None
        out.append((page, len(data), warc.base32_sha1(data), kind, page_first))
    return out


def pages():
    rows = [(i, f"http://h{i % 7}.example.org/{i}", f"<p>é {i % 40}</p>" * (i % 40)) for i in range(300)]
    rows += [(None, "http://null.example", "x"), (None, None, None), (1000, None, ""), (1001, "http://a\r\nX-Evil: 1/ü", "\r\n\r\n\x00"), (1002, "u", "long " * 200_000)]
    return rows + [(2000, "same", "same")] * 3 + [(-5, "", "neg"), (1 << 62, "", "neg")]


def read(spark, rows, **more):
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as sha", "3 as key").repartition(4)
    manifest = warc.write_archives(df, folder, **more)
    return folder, manifest, warc.read_archives(manifest, folder, payloads=True).collect()


@pytest.mark.parametrize("least,roll", [(0, 1 << 30), (60, 3000)])
def test_round_trip(spark, least, roll):
    rows = pages()
    folder, manifest, got = read(spark, rows, min_bytes=least, roll_bytes=roll, least_shard=20_000)
    assert len(got) == len(rows)
    want = brute(rows, least)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    for r, w in zip(sorted(got, key=lambda r: key((r.page_id, r.payload_bytes, r.payload_digest))), sorted(want, key=key), strict=True):
        assert (r.page_id, r.payload_bytes, r.payload_digest) == w[:3]
        if w[3]:
            assert r.record_type == "response"
        if r.record_type == "revisit":
            assert r.refers_to == w[4]
        else:
            assert r.refers_to is None and hashlib.sha1(r.payload).digest() and len(r.payload) == r.payload_bytes
    # one response of each payload, revisits refer to its record
    by = {}
    for r in got:
        by.setdefault(r.payload_digest, []).append(r)
    for group in by.values():
        first = [r for r in group if r.record_type == "response"]
        assert len(first) == (1 if group[0].payload_bytes >= least else len(group))
    assert len({r.record_id for r in got}) == len(got)
    files = manifest.collect()
    assert len(files) > 3 and sum(f.records for f in files) == len(rows)
    for f in files:
        data = spark.sparkContext.binaryFiles(f"{folder}/{f.name}").first()[1]
        assert hashlib.sha256(data).hexdigest() == f.sha256 and len(data) == f.bytes and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert f.bytes <= roll or f.records == 1
    # ids ascend over shards and files, rows of no id first
    at = [r.lo for r in _spans(spark, folder, files)]
    assert at == sorted(at)


def _spans(spark, folder, files):
    for f in sorted(files, key=lambda f: (f.shard, f.file)):
        ids = [r.page_id for r in warc.read_archives(spark.createDataFrame([(f.shard, f.name)], "shard int, name string"), folder).collect()]
        yield type("Span", (), {"lo": min(-(1 << 63) if i is None else i for i in ids)})


def test_same_rows_same_files(spark):
    rows = pages()
    first, again = (read(spark, x, least_shard=20_000, roll_bytes=4000)[1].orderBy("name").collect() for x in (rows, rows[::-1]))
    assert [(f.name, f.sha256) for f in first] == [(f.name, f.sha256) for f in again]


def test_revisits_refer_to_records_that_exist(spark):
    folder, manifest, got = read(spark, pages(), least_shard=20_000)
    responses = {r.record_id for r in got if r.record_type == "response"}
    refers = set()
    for f in manifest.collect():
        for record in warc.members(__import__("io").BytesIO(spark.sparkContext.binaryFiles(f"{folder}/{f.name}").first()[1])):
            headers, _ = warc.parse(record)
            assert "x-evil" not in headers
            refers.update([headers["warc-refers-to"]] if "warc-refers-to" in headers else [])
    assert refers and refers <= responses


def test_hot_payload_and_empty_table(spark):
    rows = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    got = warc.read_archives(warc.write_archives(rows, folder, least_shard=1 << 16), folder)
    assert got.groupBy("record_type").count().orderBy("record_type").collect() == [("response", 2667), ("revisit", 1333)]
    assert {r.refers_to for r in got.filter("record_type = 'revisit'").collect()} == {3999}
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    assert warc.read_archives(warc.write_archives(rows.limit(0), folder), folder).count() == 0


def test_damage_is_found(spark):
    packed = warc.response(1, "u", 2, b"abc", b"x", warc.base32_sha1(b"abc"), "1970-01-01T00:00:00Z", 6)
    record = gzip.decompress(packed)
    assert warc.parse(record)[1].endswith(b"\r\n\r\nabc")
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.members(__import__("io").BytesIO(packed[:-5])))
