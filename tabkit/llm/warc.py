"""Deterministic sharded WARC writer and its reader.

``write`` turns rows (id, url, payload) into WARC 1.1 archives:

* records stand in the order of their id; the id range is cut into shards of
  about ``shard_bytes`` of payload at the borders of fixed cells, from exact sums
  per cell, so the same rows always give the same shards;
* of records with equal payloads the one with the smallest id is written as a
  response, the others as revisits that refer to it (payloads below
  ``min_revisit`` bytes are always responses);
* headers, record ids and digests are made anew from id and payload, and every
  date is the ``date`` parameter, so archives are equal byte for byte when written
  again;
* each record is a gzip member; a file is closed when its compressed size
  reaches ``file_bytes``;
* a task writes under temporary names and renames a file when it is whole, then
  writes the shard's manifest the same way; names do not depend on the attempt, so a
  task that is run again replaces its own files.  When all shards are done the
  manifests become one table, which the reader goes by: files without a
  manifest line are never read.

Spark work: a first pass reduces each payload to its digest and size; equal
payloads are found by a partial aggregate over digests; revisit marks (a few
bytes per copy) meet the records in the one shuffle that sorts them into
shards, so a payload with a third of all rows needs no join.  Files are written
through ``pyarrow.fs``, which takes the URI of the shared folder.

Results for odd input: a null payload is an empty one; rows without id are
written first and revisit any equal payload that has an id; of rows equal in id
and payload one is the response, the others revisit that id; a null url gets a
``urn`` from the id; an empty table gives an empty manifest; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.llm.common import col, slices

#: Cells of the id range whose payload sums decide the shard borders.
CELLS = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file string, bytes bigint, records bigint, sha256 string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{payload_digest}')}>"


def _uri(url: str | None, page: int | None) -> str:
    """The url without what would end a header line."""
    if not url:
        return f"urn:page:{page}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace"))
                   for c in url)


def make_record(page: int | None, url: str | None, payload: bytes, first: int | None, is_revisit: bool, date: str) -> bytes:
    """One record.  ``first`` is the id of the response that a revisit
    refers to."""
    sha = digest(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not is_revisit:
        block += payload
    head = {"WARC-Type": "revisit" if is_revisit else "response", "WARC-Record-ID": record_id(page, f"{sha}/{is_revisit}"),
            "WARC-Date": date, "WARC-Target-URI": _uri(url, page),
            "Content-Type": "application/http; msgtype=response",
            "WARC-Payload-Digest": f"sha1:{sha}", "WARC-Block-Digest": f"sha1:{digest(block)}"}
    if is_revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(first, f"{sha}/False"),
                 "X-Refers-To-Page": json.dumps(first)}
    head |= {"X-Page": json.dumps(page), "X-Payload-Length": str(len(payload)), "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop writes local ones with one
    slash."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class _Folder:
    """Whole files under a URI, by temporary name and rename."""

    def __init__(self, uri: str):
        self.fs, self.root = _open(uri)
        self.fs.create_dir(self.root, recursive=True)

    def put(self, name: str, data: bytes) -> None:
        temp = f"{self.root}/.{name}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(temp, compression=None) as out:
            out.write(data)
        self.fs.move(temp, f"{self.root}/{name}")


class _ShardWriter:
    """Rolling files of one shard.  A file is held in memory until it is
    whole (``file_bytes`` and one record at most)."""

    def __init__(self, folder: _Folder, shard: int, file_bytes: int, level: int):
        self.folder, self.shard, self.file_bytes, self.level = folder, shard, file_bytes, level
        self.parts: list[bytes] = []
        self.size = self.records = 0
        self.lines: list[tuple] = []

    def add(self, record: bytes) -> None:
        gzip = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = gzip.compress(record) + gzip.flush()
        self.parts.append(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.file_bytes:
            self.roll()

    def roll(self) -> None:
        if not self.parts:
            return
        data, name = b"".join(self.parts), f"shard-{self.shard:06d}-{len(self.lines):05d}.warc.gz"
        self.folder.put(name, data)
        self.lines.append((self.shard, name, len(data), self.records, hashlib.sha256(data).hexdigest()))
        self.parts, self.size, self.records = [], 0, 0

    def close(self) -> list[tuple]:
        self.roll()
        self.folder.put(f"shard-{self.shard:06d}.manifest.json", json.dumps(self.lines).encode())
        return self.lines


def _shard_of_cell(cells: list[int], shard_bytes: int) -> list[int]:
    """Shard of each cell: a new one where the bytes so far pass the next
    multiple of ``shard_bytes``; numbered without gaps."""
    before = np.concatenate([[0], np.cumsum(cells)[:-1]])
    return np.unique(before // max(1, shard_bytes), return_inverse=True)[1].tolist()


def write(df: DataFrame, path: str, page: str = "page_id", url: str = "url", payload: str = "html",
          shard_bytes: int = 64 * 1024 * 1024, file_bytes: int = 32 * 1024 * 1024, min_revisit: int = 0,
          date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write archives of all rows under ``path`` (a folder that all executors
    share) and return the manifest, which is also stored there."""
    rows = df.select(col(page).cast("bigint").alias("page"), col(url).cast("string").alias("url"),
                     F.coalesce(col(payload), F.lit("")).cast("binary").alias("payload"))
    seen = materialize(rows.select("page", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("bigint").alias("size")))
    low, high = seen.agg(F.min("page"), F.max("page")).first()
    low, high = low or 0, high or 0
    width = (high - low) // CELLS + 1
    # null ids in the first cell
    cell = F.coalesce(F.floor((F.col("page") - low) / F.lit(width)), F.lit(0)).cast("int")
    sums = {r.cell: r.bytes for r in seen.groupBy(cell.alias("cell")).agg(F.sum(F.col("size") + 1000).alias("bytes")).collect()}
    shard_of = _shard_of_cell([sums.get(c, 0) for c in range(CELLS)], shard_bytes)
    shards = max(shard_of) + 1
    shard = F.element_at(F.lit(shard_of), cell + 1).alias("shard")

    repeated = (seen.where(F.col("size") >= min_revisit).groupBy("sha")
                .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1"))
    marks = (seen.join(repeated.select("sha", "first"), "sha")
             .select("page", shard, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                     F.unhex("sha").alias("payload"), "first").distinct())
    records = rows.select("page", shard, F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("bigint").alias("first"))
    both = marks.unionByName(records).repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", F.col("page").asc_nulls_first(), "kind", "payload", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, writer, lines = _Folder(path), None, []
        at, marked, met = None, {}, set()
        for batch in chain.from_iterable(map(slices, batches)):
            for page_id, shard_id, kind, link, data, origin in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None or writer.shard != shard_id:
                    if writer is not None:
                        lines += writer.close()
                    writer, at = _ShardWriter(folder, shard_id, file_bytes, level), None
                if at != (page_id,):
                    at, marked, met = (page_id,), {}, set()
                if kind == 0:
                    marked[data] = origin
                    continue
                sha = hashlib.sha1(data).digest()
                again = sha in marked and (marked[sha] != page_id or sha in met)
                met.add(sha)
                writer.add(make_record(page_id, link, data, marked.get(sha), again, date))
        if writer is not None:
            lines += writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in lines], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["shard", "file", "bytes", "records", "sha256"])

    both.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a compressed archive, member by
    member."""
    unzip, data, rest = zlib.decompressobj(31), b"", b""
    while True:
        if not rest:
            rest = stream.read(1 << 20)
            if not rest:
                break
        data += unzip.decompress(rest)
        rest = unzip.unused_data
        if unzip.eof:
            head, _, body = data.partition(b"\r\n\r\n")
            version, *lines = head.decode("utf-8").split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            block = body[:int(fields["Content-Length"])]
            if not version.startswith("WARC/") or body[len(block):] != b"\r\n\r\n":
                raise ValueError("not a whole WARC record")
            yield fields, block
            unzip, data = zlib.decompressobj(31), b""
    if data:
        raise ValueError("the archive ends inside a record")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives in the manifest of ``path``, one task per file:
    ``page``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest``,
    ``refers_to``, ``payload`` (null for revisits).  Block digests are checked,
    and payload digests of responses."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, root = _open(path)
        names = ("page", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))

        for name in (n for b in batches for n in b.column(0).to_pylist()):
            rows, held = [], 0
            with shared.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for fields, block in parse_records(stream):
                    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload = block.split(b"\r\n\r\n", 1)[1] if fields["WARC-Type"] == "response" else None
                    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}" or payload is not None and digest(payload) != sha:
                        raise ValueError(f"{name}: a digest does not match")
                    size = int(fields["X-Payload-Length"]) if payload is None else len(payload)
                    rows.append((json.loads(fields["X-Page"]), fields["WARC-Target-URI"], fields["WARC-Type"], size, sha,
                                 json.loads(fields.get("X-Refers-To-Page", "null")), payload))
                    held += len(payload or b"")
                    if held > 4 * 1024 * 1024:
                        yield out(rows)
                        rows, held = [], 0
            yield out(rows)

    schema = ("page bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
              "refers_to bigint, payload binary")
    n = max(1, files.count())
    numbered = files.select("file", (F.row_number().over(Window.orderBy("file")) - 1).alias("k"))
    return numbered.repartitionById(n, F.col("k")).select("file").mapInArrow(run, schema)
