"""Web archives (WARC 1.1) written in order, in files of bounded size, the same files whenever the input is the same.

Records are sorted by id over the whole table and cut into shards of equal bytes at exact places of that order. A shard is written by
one task, which begins a new file when the next record would make the compressed size too large. Headers, record ids
and digests are made anew from each row. Of equal payloads one record is the response and the others are revisits that refer to it.

Tasks write under names of their own; what the successful ones wrote is listed in a manifest, the listed files are then renamed, and
the manifest with their final names is written last: an archive is what its manifest lists.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: A shard holds a 256th of all bytes, within these bounds; files are at most so large, compressed, but for a single larger record.
SHARDS, LEAST, MOST = 256, 4 << 20, 1 << 30
ROLL = 1 << 30
#: Bytes that a record has besides its payload, about.
OVERHEAD = 500
#: A payload that more than one in so many rows have is joined apart from the others.
HEAVY = 1000

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, key: int, sha: bytes, copy: int = 0) -> str:
    """A record's URN, from what the record is."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page} {key} {copy} '.encode() + sha).digest()[:16], version=5)}>"


def _record(kind: str, rid: str, date: str, block: bytes, more: list[tuple[str, str | None]], level: int) -> bytes:
    """One record as a gzip member of its own. Line breaks and other control characters in a header are percent-encoded; a header of no value is left out."""
    safe = lambda v: "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in v)
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), *more, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {safe(v)}\r\n" for k, v in head if v is not None) + "\r\n"
    pack = zlib.compressobj(level, wbits=31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def response(page: int | None, url: str | None, key: int, payload: bytes, sha: bytes, digest: str, date: str, level: int, copy: int = 0) -> bytes:
    more = [("WARC-Target-URI", url), ("X-Page-ID", None if page is None else str(page)), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    return _record("response", record_id(page, key, sha, copy), date, HTTP % len(payload) + payload, more, level)


def revisit(page: int | None, url: str | None, key: int, size: int, sha: bytes, digest: str, copy: int, first: tuple[int | None, int], date: str, level: int) -> bytes:
    """A record that has the response's HTTP headers only and refers to the response ``first`` (its page and key)."""
    more = [
        ("WARC-Target-URI", url), ("X-Page-ID", None if page is None else str(page)), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*first, sha)), ("X-Refers-To-Page-ID", None if first[0] is None else str(first[0])),
    ]
    return _record("revisit", record_id(page, key, sha, copy), date, HTTP % size, more, level)


def _place(ids: pa.Array, keys: pa.Array) -> np.ndarray:
    """Ids (null first) and keys as strings of bytes that sort as they do."""
    out = np.zeros((len(ids), 17), np.uint8)
    out[:, 0] = ids.is_valid().to_numpy(zero_copy_only=False)
    for at, x in ((1, ids.fill_null(0)), (9, keys)):
        out[:, at : at + 8] = (x.to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S17")


def shard_starts(meta: DataFrame, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """Where shards begin in the order of (id, key): rows are sorted over all tasks, their bytes added up, and cut at multiples of a shard's bytes."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            size = b.column(2).to_numpy()
            before = np.cumsum(size) - size + total
            total = int(before[-1] + size[-1]) if len(size) else total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before)], names=["id", "key", "size", "before"])

    rows = meta.select("id", "key", (F.col("n_bytes") + OVERHEAD).alias("size")).repartitionByRange("id", "key").sortWithinPartitions("id", "key")
    rows = materialise(rows.mapInArrow(add_up, "id long, key long, size long, before long").withColumn("part", F.spark_partition_id()), "warc-order")
    sums = {r.part: r.size for r in rows.groupBy("part").agg(F.sum("size").alias("size")).collect()}  # one row a partition
    if not sums:
        return np.zeros(0, "S17")
    size = min(max(sum(sums.values()) // SHARDS, least), most)
    starts, at = [], 0
    for part in sorted(sums):
        starts.append((part, at))
        at += sums[part]
    offsets = meta.sparkSession.createDataFrame(starts, "part int, offset long")
    shard = F.expr(f"(before + offset) div {size}")
    found = rows.join(F.broadcast(offsets), "part").groupBy(shard.alias("shard")).agg(F.min(F.struct("id", "key")).alias("first")).select("first.*")
    first = found.toArrow()  # one row a shard
    return np.sort(_place(first["id"].combine_chunks(), first["key"].combine_chunks()))


def _marks(meta: DataFrame, least: int) -> DataFrame:
    """The rows whose payload others have too, with the id and key of the payload's response: that of the largest id."""
    copies = meta.filter(F.col("n_bytes") >= least).groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("id", "key")).alias("first")).filter("n > 1")
    copies = materialise(copies, "warc-copies")
    heavy = copies.filter(F.col("n") * HEAVY > meta.count()).select("sha", F.col("first").alias("heavy"))  # fewer than HEAVY rows
    rows = meta.select("id", "key", "sha").join(F.broadcast(heavy), "sha", "left")
    return rows.filter("heavy is not null").select("id", "key", "sha", F.col("heavy").alias("first")).unionAll(
        rows.filter("heavy is null").join(copies.select("sha", "first"), "sha").select("id", "key", "sha", "first")
    )


def write_archives(df: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, roll_bytes: int = ROLL, least_shard: int = LEAST, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write every row as a record; returns the manifest: shard, file, name, records, bytes, sha256.

    ``folder``: where driver and executors can write, a local path or a URI that pyarrow knows. The id is an integer; a payload is text in UTF-8 or
    binary, null: empty. Rows of equal payloads of at least ``min_bytes`` bytes are one response, that of the largest id, and revisits; of rows
    equal in id, url and payload the first is written before its copies. Rows of no id come first. A null url has no target header. Rows
    equal in every column stay in one shard. Other columns are not looked at; no rows make no files. All headers are made from the row, so equal
    tables make equal files. No date is known of a row: all records bear ``date``.
    """
    spark = df.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    rows = rows.withColumn("key", F.xxhash64("url", "sha"))
    meta = materialise(rows.select("id", "key", "sha", F.octet_length("payload").cast("long").alias("n_bytes")), "warc-rows")
    starts = shard_starts(meta, least_shard)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = np.searchsorted(starts, _place(b.column("id"), b.column("key")), side="right") - 1
            out, size, first = [], 0, 0

            def some(to: int) -> pa.RecordBatch:
                part = b.slice(first, to - first)
                cols = [pa.array(shard[first:to], pa.int32()), part.column("id"), part.column("key"), part.column("sha"), pa.array([1] * len(out), pa.int32()), part.column("url")]
                none = pa.nulls(len(out), pa.int64())
                return pa.RecordBatch.from_arrays([*cols, *map(pa.array, zip(*out, strict=True)), none, none], names=NAMES)

            for i in range(b.num_rows):
                page, url, data, sha, key = (b.column(c)[i].as_py() for c in ("id", "url", "payload", "sha", "key"))
                digest = base32_sha1(data)
                out.append((len(data), digest, response(page, url, key, data, sha, digest, date, level)))
                size += len(data)
                if size >= 4 << 20:
                    yield some(i + 1)
                    out, size, first = [], 0, i + 1
            if out:
                yield some(b.num_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = np.searchsorted(starts, _place(b.column("id"), b.column("key")), side="right") - 1
            n, first = b.num_rows, b.column("first")
            none = [pa.nulls(n, t) for t in (pa.string(), pa.int64(), pa.string(), pa.binary())]
            kinds = pa.array(np.zeros(n, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *b.select(["id", "key", "sha"]).columns, kinds, *none, *(first.field(i) for i in range(2))], names=NAMES)

    every = rows.mapInArrow(compress, SCHEMA).unionAll(_marks(meta, min_bytes).mapInArrow(deal, SCHEMA))
    parts = max(1, min(len(starts), 10_000))
    # marks come before the records that they are about
    every = every.repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard", "id", "key", "sha", "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Files(folder, roll_bytes, date, level) as files:
            mark, copy, last = None, 0, None
            for b in batches:
                columns = [b.column(c) for c in NAMES]
                for i in range(b.num_rows):
                    shard, page, key, sha, kind, url, size, digest, packed, first_page, first_key = (c[i].as_py() for c in columns)
                    here = page, key, sha
                    if not kind:
                        if mark is None or mark[0] != here:
                            mark, copy = (here, (first_page, first_key)), 0
                        continue
                    if mark is None or mark[0] != here:  # a response, whoever else has its payload
                        copy = copy + 1 if last == here else 0
                        if copy:  # equal rows are told apart by their record ids
                            payload = parse(zlib.decompress(packed, wbits=31))[1].partition(b"\r\n\r\n")[2]
                            packed = response(page, url, key, payload, sha, digest, date, level, copy)
                        files.add(shard, packed)
                        last = here
                    elif mark[1] == (page, key) and not copy:
                        files.add(shard, packed)
                        copy = 1
                    else:
                        copy += 1
                        files.add(shard, revisit(page, url, key, size, sha, digest, copy, mark[1], date, level))
            done = files.close()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    written = materialise(every.mapInArrow(write, "shard int, file int, temporary string, records long, bytes long, sha256 string"), "warc-files")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = []
            for r in b.to_pylist():
                names.append(f"shard-{r['shard']:06d}-{r['file']:05d}.warc.gz")
                _move(f"{folder}/{r['temporary']}", f"{folder}/{names[-1]}")
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("file"), pa.array(names, pa.string()), *b.select(["records", "bytes", "sha256"]).columns], names=["shard", "file", "name", "records", "bytes", "sha256"])

    manifest = written.repartition(max(1, min(parts, 256))).mapInArrow(commit, "shard int, file int, name string, records long, bytes long, sha256 string")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    _remove(f"{folder}/_temporary")
    return spark.read.parquet(f"{folder}/manifest")


SCHEMA = "shard int, id long, key long, sha binary, kind int, url string, n_bytes long, digest string, packed binary, first_id long, first_key long"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _move(old: str, new: str) -> None:
    """Rename; done already if another attempt has."""
    system, source = _open(old)
    _, target = _open(new)
    kinds = [i.is_file for i in system.get_file_info([source, target])]
    if kinds[0]:
        system.move(source, target)
    elif not kinds[1]:
        raise FileNotFoundError(old)


def _remove(uri: str) -> None:
    from pyarrow import fs

    system, path = _open(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


class _Files:
    """The files of one task, under names of this attempt; begins a new one for each shard and when the next record would make one too large."""

    def __init__(self, folder: str, roll: int, date: str, level: int):
        self.folder, self.roll, self.date, self.level = folder, roll, date, level
        self.done: list[dict] = []
        self.stream = None

    def __enter__(self) -> _Files:
        return self

    def __exit__(self, *_) -> None:
        if self.stream:
            self.stream.close()

    def add(self, shard: int, packed: bytes) -> None:
        last = self.done[-1] if self.stream else None
        if not last or last["shard"] != shard or last["bytes"] + len(packed) > self.roll and last["records"]:
            self._begin(shard, last["file"] + 1 if last and last["shard"] == shard else 0)
        self._put(packed)
        self.done[-1]["records"] += 1

    def _begin(self, shard: int, file: int) -> None:
        self._end()
        self.done.append({"shard": shard, "file": file, "temporary": f"_temporary/{uuid.uuid4().hex}.warc.gz", "records": 0, "bytes": 0})
        system, path = _open(f"{self.folder}/{self.done[-1]['temporary']}")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream, self.sha = system.open_output_stream(path, compression=None), hashlib.sha256()
        name = f"shard-{shard:06d}-{file:05d}.warc.gz"
        block = b"format: WARC file version 1.1\r\n"
        rid = record_id(None, shard, b"", file)
        self._put(_record("warcinfo", rid, self.date, block, [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], self.level))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.done[-1]["bytes"] += len(data)

    def _end(self) -> None:
        if self.stream:
            self.stream.close()
            self.stream = None
            self.done[-1]["sha256"] = self.sha.hexdigest()

    def close(self) -> list[dict]:
        self._end()
        return self.done


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    rest = stream.read(size)
    while rest:
        unpack, out = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(size)):
                raise ValueError("an archive ends within a record")
            out.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(out)
        rest = rest or stream.read(size)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, with lower-case names, and its block; raises if its length or digest is not what it says."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    return headers, block


def read_archives(manifest: DataFrame, folder: str, *, payloads: bool = False) -> DataFrame:
    """The records of a manifest's files: page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id and, if asked for, payload (of revisits null).

    Lengths and digests of records and payloads are checked; a revisit's length is that of the HTTP headers it repeats. A task reads the files of one shard.
    """
    more = ", payload binary" if payloads else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                system, path = _open(f"{folder}/{name}")
                out, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for record in members(stream):
                        headers, block = parse(record)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length, digest = int(http.rpartition(b"Content-Length: ")[2]), headers["warc-payload-digest"].removeprefix("sha1:")
                        whole = headers["warc-type"] == "response"
                        if whole and (length != len(payload) or digest != base32_sha1(payload)):
                            raise ValueError(f"damaged payload of {headers['warc-record-id']}")
                        number = lambda k: int(headers[k]) if k in headers else None  # noqa: E731, B023
                        out.append((number("x-page-id"), headers.get("warc-target-uri"), length, digest, headers["warc-type"], number("x-refers-to-page-id"), headers["warc-record-id"], *([payload if whole else None] if payloads else [])))
                        size += len(payload) if payloads else 100
                        if size >= 4 << 20:
                            yield batch(out)
                            out, size = [], 0
                if out:
                    yield batch(out)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), *([pa.binary()] if payloads else [])]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", *(["payload"] if payloads else [])]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1
    parts = min(shards, 10_000)
    return manifest.repartitionById(parts, F.col("shard") % parts).select("name").mapInArrow(read, f"page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string{more}")
