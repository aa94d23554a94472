"""Deterministic sharded WARC writer and its reader.

Records are dealt to shards by ranges of their id (bounds from a hash-drawn sample of ids, so the same rows give the
same shards anywhere), sorted inside a shard, and written as one gzip member each. A file rolls before the record that
would take it past ``roll_bytes`` compressed. Headers are made anew (WARC and HTTP, fixed date, name-based record ids)
with SHA-1 digests of payload and block. Of records with equal payloads of at least ``revisit_from`` bytes the one with
the largest id is the response; the others are revisits of it and carry no payload.

Commit: a task writes under temporary names, unique per attempt, and returns manifest rows; the manifest is written by
Spark, so it lists exactly the attempts that count. A second job renames the listed files (done already: skipped) and
writes the final manifest; what lost attempts left under temporary names is then deleted. Readers go by the manifest.

The folder must be one that all executors reach: a shared file system path, or any store pyarrow's file systems open.

Defined cases: a null payload is an empty one; a null url is left out of the headers, control characters in a url are
percent-encoded; records without an id are dealt to shards by their payload's digest, which names them, come first in
their shard, and are never referred to while an id exists (equal payloads with only null ids are all responses); a very long payload
is one record, held whole by the task that writes it; repeated rows are written each, and rows that share the largest id are all responses; an empty
table gives an empty manifest; columns other than id, url and payload are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.functions.files import Folder
from vistasieve.llm.common import partitions_for
from vistasieve.session import scratch_path

ROLL_BYTES = 64 << 20
SHARD_BYTES = 256 << 20     # of payload, on average
BOUND_ROWS = 100_000        # ids drawn to set the shards' bounds
REVISIT_FROM = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, seq int, temporary string, name string, records bigint, bytes bigint, sha256 string"


def record_id(page, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{copy}')}>"


def safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def member(kind: str, ident: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    sha1 = hashlib.sha1(block).hexdigest()
    head = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", f"sha1:{sha1}"), ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 6, mtime=0)


def page_record(page, url, body: bytes, digest: str, refers_to, copy: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", None if url is None else safe_url(url)), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", page)]
    ident = record_id(digest if page is None else page, copy)
    if refers_to is None:
        return member("response", ident, fields, http + body)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", refers_to)]
    return member("revisit", ident, fields, http)


class Roller:
    """Writes one shard's records to files that roll by compressed size."""

    def __init__(self, folder: Folder, shard: int, roll_bytes: int):
        self.folder, self.shard, self.roll, self.seq, self.out = folder, shard, roll_bytes, 0, None
        self.attempt = uuid.uuid4().hex

    def add(self, data: bytes):
        done = self.close() if self.out and self.size + len(data) > self.roll else None
        if self.out is None:
            self.temporary = f"_temporary/{self.shard:06d}-{self.seq:06d}-{self.attempt}"
            self.name = f"part-{self.shard:06d}-{self.seq:06d}.warc.gz"
            self.out, self.size, self.records, self.sha = self.folder.write(self.temporary), 0, 0, hashlib.sha256()
            self._put(member("warcinfo", record_id(self.name), [("WARC-Filename", self.name),
                             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(data)
        self.records += 1
        return done

    def _put(self, data: bytes):
        self.out.write(data)
        self.size += len(data)
        self.sha.update(data)

    def close(self):
        self.out.close()
        self.out, self.seq = None, self.seq + 1
        return (self.shard, self.seq - 1, self.temporary, self.name, self.records, self.size, self.sha.hexdigest())


def shard_bounds(rows: DataFrame, shards: int, n: int) -> list:
    every = max(1, n // BOUND_ROWS)
    drawn = rows.where(F.col("page").isNotNull() & (F.pmod(F.xxhash64("page"), F.lit(every)) == 0)).select("page")
    ids = np.sort(np.array([r.page for r in drawn.limit(4 * BOUND_ROWS).collect()], np.int64))
    at = np.arange(1, shards) * len(ids) // shards
    return sorted(set(ids[at].tolist())) if len(ids) else []


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """``page``, ``url``, ``body`` and ``digest``."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), body.alias("body"))
    return rows.withColumn("digest", F.sha1("body"))


def references(rows: DataFrame, revisit_from: int) -> DataFrame:
    """``page``, ``digest`` and ``refers_to`` of the revisits. Payloads stay behind: only digests are shuffled."""
    long = rows.where(F.length("body") >= revisit_from).select("page", "digest")
    first = long.groupBy("digest").agg(F.max("page").alias("refers_to"), F.count("*").alias("c")).where("c > 1").drop("c")
    return long.join(first, "digest").where(F.col("refers_to").isNotNull() & ~F.col("page").eqNullSafe(F.col("refers_to")))


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", roll_bytes: int = ROLL_BYTES, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the archive below ``folder`` (default: a new one in the shared scratch folder); returns its manifest
    (``folder``, ``name``, ``records``, ``bytes``, ``sha256``)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = records(pages, id_col, url_col, payload_col)
    n, size = pages.agg(F.count("*"), F.sum(F.length(F.col(payload_col)))).first()
    shards = max(partitions_for(spark), 1 + (size or 0) // SHARD_BYTES)
    bounds = shard_bounds(pages.select(F.col(id_col).cast("long").alias("page")), shards, n)
    edges = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<long>")
    # rows without an id go to shards by their payload
    shard = F.when(F.col("page").isNull(), F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")).otherwise(F.size(F.filter(edges, lambda b: b <= F.col("page"))))
    # A revisit's reference comes just before its record, as a row without a body, so payloads are shuffled once.
    refs = references(rows, revisit_from).select("page", F.lit(None).cast("string").alias("url"),
                                                 F.lit(None).cast("binary").alias("body"), "digest", "refers_to")
    both = rows.withColumn("refers_to", F.lit(None).cast("long")).unionByName(refs)
    dealt = (both.withColumn("shard", shard).repartitionById(shards, "shard")
             .sortWithinPartitions("shard", "page", "digest", F.col("refers_to").asc_nulls_last(), "url"))

    def write(batches):
        target, roller, done, last, copy, known = Folder(folder), None, [], None, 0, (None, None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for page, url, body, digest, refers_to, own in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns)):
                    if body is None:
                        known = (page, digest, refers_to)
                        continue
                    refers_to = known[2] if known[:2] == (page, digest) else None
                    if roller is None or roller.shard != own:
                        done += [roller.close()] if roller else []
                        roller = Roller(target, own, roll_bytes)
                    copy = copy + 1 if page == last else 0
                    last = page
                    rolled = roller.add(page_record(page, url, body, digest, refers_to, copy))
                    done += [rolled] if rolled else []
        done += [roller.close()] if roller else []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (
                pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["shard", "seq", "temporary", "name", "records", "bytes", "sha256"])

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")

    def commit(batches):
        target = Folder(folder)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
                if target.exists(old):
                    target.rename(old, new)
                elif not target.exists(new):
                    raise FileNotFoundError(f"{folder}: neither {old} nor {new} is there")
            yield batch

    listed.mapInArrow(commit, MANIFEST).select("name", "records", "bytes", "sha256").write.parquet(f"{folder}/manifest")
    left = Folder(folder)
    left.delete(left.names("_temporary"))
    final = spark.read.schema("name string, records bigint, bytes bigint, sha256 string").parquet(f"{folder}/manifest")
    return final.select(F.lit(folder).alias("folder"), "*")


def read_members(stream, chunk: int = 1 << 20):
    """The decompressed gzip members of a file, one at a time."""
    data = b""
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            parts.append(unzip.decompress(data))
            data = unzip.unused_data if unzip.eof else stream.read(chunk)
            if not data and not unzip.eof:
                raise EOFError("the file ends inside a record")
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    return fields, block


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row per page record: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` and ``payload`` (null for revisits). Digests are checked against the bytes read."""
    shape = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
             "refers_to bigint, payload binary")
    names = [x.split()[0] for x in shape.split(", ")]

    def as_row(fields, block):
        http, _, body = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
        page, to = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
        size = int(http.rpartition(b"Content-Length: ")[2])
        return (None if page is None else int(page), fields.get("WARC-Target-URI"), size, digest, kind,
                None if to is None else int(to), body if kind == "response" else None)

    def read(batches):
        for batch in batches:
            for folder, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                with Folder(folder).read(name) as stream:
                    for raw in read_members(stream):
                        fields, block = parse_record(raw)
                        if fields["WARC-Type"] != "warcinfo":
                            rows.append(as_row(fields, block))
                            held += len(raw)
                        if held > 4 << 20:
                            yield as_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    files = manifest.select("folder", "name")
    return files.repartition(partitions_for(manifest.sparkSession), "name").mapInArrow(read, shape)
