"""A deterministic writer of sharded WARC archives, and a reader.

1. Digests of all payloads name the first page of each payload of at least REVISIT_BYTES bytes: it becomes a
   response record, later pages with that payload revisit it.
2. Shards are ranges of page_id with nearly equal bytes; the bounds come from exact counts, so that a rerun
   cuts the same. Each shard is one task's, which sorts its records.
3. A task regenerates headers and digests, compresses each record on its own and rolls to the next file by
   compressed size. It writes under a temporary name and renames a whole file to its final one, which depends
   on nothing but shard and number: a repeated attempt writes the same bytes.
4. The names, sizes and digests of the files go into a manifest that Spark commits at the end. Readers take
   the files that the manifest names and check them against it.

Records with equal payloads move nowhere together: a task holds one record and one compressor.

Defined cases: a null html is an empty payload. Rows that repeat page_id and payload repeat the record.
Null page_ids come first, and a payload's response is the smallest page_id that isn't null. Other columns
aren't read. An empty table gives a manifest without files and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, split_bytes
from postloom.llm.sharding import splitters

REVISIT_BYTES = 100
ROLL_BYTES = 16 << 20
#: Shards at most; a task rolls as many files as its range fills.
MOST_SHARDS = 4096
#: Digests of repeated payloads that are broadcast at most; beyond it the join shuffles.
BROADCAST_DIGESTS = 500_000
#: What every record says.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

_MANIFEST_DDL = "file string, records long, bytes long, sha256 string, first_page long, last_page long"
_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_page", pa.int64()), ("last_page", pa.int64())])
_RECORD_DDL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def file_system(uri: str):
    """pyarrow's file system for a path as Spark names it, and the path there."""
    from pyarrow import fs

    if re.match(r"file:/", uri):
        uri = "file:///" + re.sub(r"^file:/+", "", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of the page `first`."""
    revisit = first is not None and first != page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\s]", "%20", url or "urn:none"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "X-Page-Id": "" if page_id is None else page_id,
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(first, digest), "X-Refers-To-Page-Id": first, "X-Payload-Length": len(payload)}
    head["Content-Length"] = len(block)
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return lines.encode() + CRLF + block + CRLF + CRLF


def compressed(data: bytes, level: int = 6) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The contents of the gzip members of a file."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(view):
                raise ValueError("a gzip member is cut short")
            parts.append(z.decompress(view[at : at + step]))
            at += min(step, len(view) - at) - len(z.unused_data)
        yield b"".join(parts)


def _write(folder: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = file_system(folder)
        shard, attempt, number = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        out, done = None, []

        def close() -> None:
            nonlocal out
            stream.close()
            name = f"part-{shard:05d}-{number:05d}.warc.gz"
            try:
                store.move(temporary, f"{base}/{name}")
            except OSError:  # another attempt has renamed the same bytes to it
                if store.get_file_info(f"{base}/{name}").size != size:
                    raise
                store.delete_file(temporary)
            done.append((name, records, size, digest.hexdigest(), first, last))
            out = None

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    temporary, size, records, digest, first = f"{base}/.tmp-{shard:05d}-{number:05d}-{attempt}", 0, 0, hashlib.sha256(), r["page_id"]
                    out = stream = store.open_output_stream(temporary, compression=None)
                data = compressed(record(r["page_id"], r["url"], r["payload"], r["digest"], r["first"]))
                stream.write(data)
                digest.update(data)
                size, records, last = size + len(data), records + 1, r["page_id"]
                if size >= roll:
                    close()
                    number += 1
        if out is not None:
            close()
        cols = list(zip(*done)) or [[]] * len(_MANIFEST)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _MANIFEST)], schema=_MANIFEST)

    return run


def _range_of(key: Column, bounds: list[int], low: int = 0) -> Column:
    """How many of the bounds a key reaches, by halving."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    if bounds[mid] >= 1 << 63:
        return _range_of(key, bounds[:mid], low)
    return F.when(key >= F.lit(max(bounds[mid], -(1 << 63))), _range_of(key, bounds[mid + 1 :], low + mid + 1)).otherwise(_range_of(key, bounds[:mid], low))


def write_warc(pages: DataFrame, folder: str, shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archives and their manifest to `folder`; returns the manifest."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "key": F.coalesce("page_id", F.lit(-(1 << 63)))})
    light = scratch.table(rows.select("page_id", "key", "digest", F.octet_length("payload").cast("long").alias("size")), "light")
    repeated = light.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = scratch.table(repeated, "repeated")
    known = F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated
    total = light.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = int(max(1, min(MOST_SHARDS, -(-total // (shard_bytes or split_bytes(spark))))))
    bounds = splitters(light.withColumn("weight", F.col("size") + 300), "key", "weight", shards)
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    dealt = rows.join(known, "digest", "left").repartitionById(shards, _range_of(F.col("key"), bounds).cast("int"))
    written = dealt.sortWithinPartitions("key", "digest").select("page_id", "url", "payload", "digest", "first").mapInArrow(_write(folder, roll_bytes), _MANIFEST_DDL)
    written.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST_DDL).parquet(f"{folder}/manifest")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content, size, sha in zip(*(batch.column(k) for k in ("path", "content", "bytes", "sha256"))):
            data = content.as_py()
            if len(data) != size.as_py() or hashlib.sha256(data).hexdigest() != sha.as_py():
                raise ValueError(f"{path.as_py()} isn't what the manifest says")
            out, held = [], 0
            for member in members(data):
                out.append(_record(member))
                held += len(member)
                if held > 8 << 20:
                    yield _records(out)
                    out, held = [], 0
            yield _records(out)


def _record(data: bytes) -> tuple:
    head, _, rest = data.partition(CRLF + CRLF)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
        raise ValueError(f"the block of {fields['WARC-Record-ID']} is damaged")
    page = int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        return page, fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, "revisit", int(fields["X-Refers-To-Page-Id"]), None
    payload = block.partition(CRLF + CRLF)[2]
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return page, fields["WARC-Target-URI"], len(payload), digest, "response", None, payload


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    cols = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest in `folder` names, checked against it and their own digests."""
    manifest = spark.read.schema(_MANIFEST_DDL).parquet(f"{folder}/manifest").select("file", "bytes", "sha256")
    if not manifest.take(1):
        return spark.createDataFrame([], _RECORD_DDL)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder).select("path", "content")
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(manifest), "file")
    return named.select("path", "content", "bytes", "sha256").mapInArrow(_parse, _RECORD_DDL)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "warc-archive").path("archive")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha256(b) as h from p),
f as (select h, min(page_id) as first from d where n >= {REVISIT_BYTES} group by h)
select page_id, n::bigint as payload_bytes, h as payload_digest,
  case when first <> page_id then 'revisit' else 'response' end as record_type,
  case when first <> page_id then first end as refers_to
from d left join f using (h)"""
