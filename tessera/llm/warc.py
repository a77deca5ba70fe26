"""WARC: a deterministic sharded writer and its reader.

Records are range-sorted by page id into shards whose cut points depend on the rows alone. A shard's
records follow each other into files of gzip members (one for each record); a file that has reached
``file_bytes`` compressed is closed and the next begins. Record ids, digests and lengths are
regenerated from the payload, so the same table always gives the same bytes.

A task writes under ``_temporary`` with names of its own attempt. The driver renames the files of
the attempts that ended (one row for each file comes back, never records) and writes the manifest
last; a reader only opens files that the manifest lists.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the largest page id is
the response; the others are revisits and carry the response's record id instead of the payload.
Which pages revisit is found on (digest, page id) alone; these rows meet the payloads by sorting
with them, so payloads are shuffled once.

Cases: a null payload is empty; a page without an id is a response that nothing revisits; rows that
repeat the response's id and payload revisit it; a null URL becomes ``about:blank``; an empty table
gives a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (open_fs, python_ready, query, range_shards, read_table, shared_path,
                                shuffle_partitions, written)

FILE_BYTES = 256 << 20
MIN_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def warc_record(key, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One uncompressed WARC/1.1 record."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    url = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", "Content-Type: application/http; msgtype=response"]
    if key is not None:
        head.append(f"X-Page-Id: {key}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _File:
    """A WARC file under its temporary name."""

    def __init__(self, fs, folder: str, shard: int, number: int, level: int):
        self.row = {"shard": shard, "number": number, "attempt": uuid.uuid4().hex, "records": 0, "bytes": 0}
        self.level, self.digest = level, hashlib.sha256()
        self.stream = fs.open_output_stream(f"{folder}/_temporary/{shard:06d}-{number:05d}-{self.row['attempt']}")

    def add(self, record: bytes) -> None:
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        raw = packer.compress(record) + packer.flush()
        self.stream.write(raw)
        self.digest.update(raw)
        self.row["records"] += 1
        self.row["bytes"] += len(raw)

    def close(self) -> dict:
        self.stream.close()
        return self.row | {"sha256": self.digest.hexdigest()}


def write_warc(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", html: str = "html",
               shards: int | None = None, file_bytes: int = FILE_BYTES, min_revisit: int = MIN_REVISIT,
               level: int = 6, name: str = "pages") -> list[dict]:
    """Write ``pages`` into ``folder``; returns the manifest (a row for each file)."""
    spark = pages.sparkSession
    python_ready(spark)
    given = pages.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b"")).alias("payload"))
    given = given.withColumn("digest", F.sha1("payload"))
    large = given.where((F.octet_length("payload") >= min_revisit) & F.col("k").isNotNull()).select("k", "digest")
    copies = written(large.groupBy("digest").agg(F.max("k").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    roles = large.join(copies, "digest").where("k <> refers_to").distinct()
    rows = given.select("k", "digest", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("bigint").alias("refers_to"))
    rows = rows.unionByName(roles.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = range_shards(rows, "k", shards or shuffle_partitions(spark), keys=given.select("k"))
    dealt = dealt.sortWithinPartitions("_shard", F.asc_nulls_first("k"), "digest", "kind", "url")
    fs, path = open_fs(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        out, done, role, last = None, [], None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    here = (r["k"], r["digest"])
                    if r["kind"] == 0:
                        role = (here, r["refers_to"])
                        continue
                    refers = role[1] if role and role[0] == here else None
                    if refers is None and here == last and r["k"] is not None and len(r["payload"]) >= min_revisit:
                        refers = r["k"]
                    last = here
                    if out is None or out.row["shard"] != r["_shard"] or out.row["bytes"] >= file_bytes:
                        number = out.row["number"] + 1 if out is not None and out.row["shard"] == r["_shard"] else 0
                        if out is not None:
                            done.append(out.close())
                        out = _File(fs, path, r["_shard"], number, level)
                    out.add(warc_record(r["k"], r["url"], r["payload"], r["digest"], refers))
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
                [("shard", pa.int32()), ("number", pa.int32()), ("attempt", pa.string()), ("records", pa.int64()),
                 ("bytes", pa.int64()), ("sha256", pa.string())]))

    files = [r.asDict() for r in dealt.mapInArrow(write, "shard int, number int, attempt string, records bigint, bytes bigint, sha256 string").collect()]
    manifest = []
    for f in sorted(files, key=lambda f: (f["shard"], f["number"])):
        f["file"] = f"{name}-{f['shard']:06d}-{f['number']:05d}.warc.gz"
        fs.move(f"{path}/_temporary/{f['shard']:06d}-{f['number']:05d}-{f['attempt']}", f"{path}/{f['file']}")
        manifest.append({k: f[k] for k in ("file", "shard", "number", "records", "bytes", "sha256")})
    with fs.open_output_stream(f"{path}/manifest.json.part") as out:
        out.write(json.dumps(manifest).encode())
    fs.move(f"{path}/manifest.json.part", f"{path}/manifest.json")
    return manifest


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a compressed WARC file, one at a time."""
    with gzip.GzipFile(fileobj=stream) as raw, io.BufferedReader(raw, 1 << 16) as f:
        while line := f.readline():
            if not line.strip():
                continue
            headers = {"": line.strip().decode()}
            while (line := f.readline()).strip():
                k, _, v = line.decode().partition(":")
                headers[k.strip().lower()] = v.strip()
            yield headers, f.read(int(headers["content-length"]))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of the folder: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A response's payload is hashed again, and a digest that differs from its header is an error. A
    revisit's length and digest are those that its headers give for the payload it refers to.
    """
    python_ready(spark)
    fs, path = open_fs(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        files = json.loads(f.read())
    rows = spark.createDataFrame([(i, f["file"]) for i, f in enumerate(files)], "i int, file string")
    tasks = min(max(1, len(files)), 4 * spark.sparkContext.defaultParallelism)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, path = open_fs(folder)
                found = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for h, block in records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-type"] == "response":
                            if hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"{name}: payload of {h['warc-record-id']} does not match its digest")
                            size = len(payload)
                        else:
                            size = int(http.lower().rpartition(b"content-length:")[2])
                        found.append((number(h.get("x-page-id")), size, digest, h["warc-type"], number(h.get("x-refers-to-page-id")), h["warc-target-uri"]))
                        if len(found) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)
                            found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)

    return rows.repartitionById(tasks, F.col("i")).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') h, url FROM pages),
g AS (SELECT h, max(page_id) m FROM p WHERE strlen(h) >= {MIN_REVISIT} GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) payload_bytes, sha1(p.h) payload_digest,
  CASE WHEN m <> page_id THEN 'revisit' ELSE 'response' END record_type, CASE WHEN m <> page_id THEN m END refers_to, url
FROM p LEFT JOIN g ON p.h = g.h
"""


@query("op2_warc", ORACLE)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into WARC files and back."""
    folder = shared_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder)
