"""Operator 8: deterministic sharded WARC writer and reader.

Records are range-sorted by page id over shards whose bounds depend on the
data alone.  A task writes its shards record by record (a gzip member each)
and rolls to a new file once the compressed size is reached; a file gets its
name only when it is whole, and it counts only when the manifest, written
last, lists it.  A task that runs twice writes the same bytes to the same
names.  Files go through the file system of the output path, so executors
need no folder in common but that one.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.llm.common import materialize, shuffle_partitions
from prefdata.session import scratch_path

#: Compressed bytes after which a file is rolled; payload bytes aimed at per shard; shards at most.
FILE_BYTES, SHARD_BYTES, MAX_SHARDS = 64 << 20, 8 << 20, 50_000
#: Ids sampled per shard to find the bounds (all go to the driver: 16 x 50,000 integers at most).
SAMPLES = 16
#: Payloads of at least so many bytes become revisits of an equal one.
MIN_REVISIT = 0
#: Records carry this date, so that a rerun writes the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>"


def _clean(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, uncompressed; ``refers_to`` makes it a revisit without payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("Refers-To-Page-ID", str(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", str(len(payload))),
             ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; raises if a digest or a length does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and (len(payload) != int(fields["Payload-Length"]) or fields["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}"):
        raise ValueError(f"damaged payload {fields.get('WARC-Record-ID')}")
    return fields, payload


class _Roller:
    """Writes the records of one shard to files that are renamed when they are whole."""

    def __init__(self, root: str, shard: int, file_bytes: int):
        self.fs, self.root = pafs.FileSystem.from_uri(root)
        self.shard, self.file_bytes, self.seq, self.out = shard, file_bytes, 0, None

    def add(self, data: bytes) -> dict | None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temp = posixpath.join(self.root, "_temporary", f"{self.name}.{uuid.uuid4().hex}")
            self.fs.create_dir(posixpath.dirname(self.temp), recursive=True)
            self.out, self.size, self.records, self.hash = self.fs.open_output_stream(self.temp), 0, 0, hashlib.sha256()
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)
        self.records += 1
        return self.close() if self.size >= self.file_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, posixpath.join(self.root, self.name))
        self.out, self.seq = None, self.seq + 1
        return {"file": self.name, "shard": self.shard, "records": self.records, "bytes": self.size, "sha256": self.hash.hexdigest()}


MANIFEST = "file string, shard int, records long, bytes long, sha256 string"
_MANIFEST_ARROW = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def shard_bounds(sizes: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """Page ids at which shards begin, from a hash-chosen sample of (page_id, n) rows; the same for any partitioning."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    shards = max(1, min(MAX_SHARDS, -(-total["n"] // shard_bytes)))
    every = max(1, total["rows"] // (shards * SAMPLES))
    ids = [r[0] for r in sizes.filter(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
           .select("page_id").distinct().orderBy(F.xxhash64("page_id")).limit(4 * MAX_SHARDS * SAMPLES).collect()]
    ids.sort()
    return sorted({ids[len(ids) * i // shards] for i in range(1, shards)}) if ids else []


def write_warc(pages: DataFrame, out: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) under ``out``; returns the manifest.

    A null html is an empty payload; a null url gives no target; rows without
    a page id come first and are never referred to.  Of equal payloads of at
    least ``min_revisit`` bytes the smallest page id is the response (each row,
    if that id is repeated) and the others revisit it.  Extra columns are not
    looked at.  ``out`` must be new: a folder that has a manifest is refused.
    """
    spark = pages.sparkSession
    fs, root = pafs.FileSystem.from_uri(out)
    if fs.get_file_info(posixpath.join(root, "_manifest")).type != pafs.FileType.NotFound:
        raise FileExistsError(f"{out} has a manifest already")
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"))
    narrow = materialize(rows.select("page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n")), "warc-digests")
    bounds = shard_bounds(narrow, shard_bytes)
    first = narrow.filter(F.col("n") >= min_revisit).groupBy("sha1", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    revisits = materialize(narrow.join(first.filter("copies > 1").select("sha1", "n", "first"), ["sha1", "n"])
                           .filter("page_id <> first").select("page_id", "sha1", F.col("first").alias("refers_to")).distinct(), "warc-revisits")
    keyed = rows.withColumn("sha1", F.sha1("payload")).join(revisits, ["page_id", "sha1"], "left")

    def to_shards(batches):
        import numpy as np
        edges = np.array(bounds, np.int64)
        for batch in batches:
            ids = batch.column(0)
            at = np.searchsorted(edges, ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *batch.columns], names=["shard", *batch.schema.names])

    def write(batches):
        roller, done = None, []
        for batch in batches:
            shard, page_id, _, url, payload, refers = (batch.column(n) for n in ("shard", "page_id", "sha1", "url", "payload", "refers_to"))
            for i in range(batch.num_rows):
                if roller is None or roller.shard != shard[i].as_py():
                    done += [roller.close()] if roller else []
                    roller = _Roller(out, shard[i].as_py(), file_bytes)
                body = payload[i].as_py()
                done.append(roller.add(record(page_id[i].as_py(), url[i].as_py(), body, base32_sha1(body), refers[i].as_py())))
            yield pa.RecordBatch.from_pylist([x for x in done if x], schema=_MANIFEST_ARROW)
            done = []
        if roller:
            yield pa.RecordBatch.from_pylist([x for x in [roller.close()] if x], schema=_MANIFEST_ARROW)

    dealt = keyed.select("page_id", "sha1", "url", "payload", "refers_to").mapInArrow(
        to_shards, "shard int, page_id long, sha1 string, url string, payload binary, refers_to long")
    parts = max(1, min(len(bounds) + 1, 4 * shuffle_partitions(spark)))
    ordered = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "page_id", "sha1", "url")
    ordered.mapInArrow(write, MANIFEST).write.parquet(posixpath.join(out, "_manifest"))
    temp = posixpath.join(root, "_temporary")
    if fs.get_file_info(temp).type != pafs.FileType.NotFound:
        fs.delete_dir(temp)  # what lost attempts have left
    return spark.read.parquet(posixpath.join(out, "_manifest"))


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(spark: SparkSession, out: str, payload: bool = True) -> DataFrame:
    """Records of the files that the manifest lists; every digest is checked.  ``payload=False`` leaves payloads out (null)."""
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def members(stream):
        z, buffer = zlib.decompressobj(31), []
        while data := stream.read(1 << 20):
            while data:
                buffer.append(z.decompress(data))
                data = b""
                if z.eof:
                    yield b"".join(buffer)
                    data, z, buffer = z.unused_data, zlib.decompressobj(31), []
        if buffer and any(buffer):
            raise ValueError("a file ends inside a record")

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, root = pafs.FileSystem.from_uri(out)
                rows, size = [], 0
                with fs.open_input_stream(posixpath.join(root, name), compression=None) as stream:
                    for data in members(stream):
                        head, body = parse(data)
                        number = lambda k, head=head: int(head[k]) if k in head else None
                        rows.append({"page_id": number("Page-ID"), "url": head.get("WARC-Target-URI"), "payload_bytes": number("Payload-Length"),
                                     "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": head["WARC-Type"],
                                     "refers_to": number("Refers-To-Page-ID"), "payload": body if payload and head["WARC-Type"] == "response" else None})
                        size += len(body) if payload else 0
                        if len(rows) >= 5000 or size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=fields)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)

    files = spark.read.parquet(posixpath.join(out, "_manifest")).select("file")
    return files.repartition(4 * shuffle_partitions(spark), "file").mapInArrow(read, READ)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new scratch folder and read the records back, without payloads."""
    out = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, out, **options)
    return read_warc(pages.sparkSession, out, payload=False).drop("payload")


def round_trip_sql() -> str:
    """DuckDB text of the digest columns of :func:`round_trip`."""
    five = "('0x' || substr(h, {at}, 5))::INT"
    chars = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({five.format(at=5 * i + 1)} >> {s}) & 31) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, {chars} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM s"""
