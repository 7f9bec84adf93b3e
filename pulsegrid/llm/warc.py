"""Web archives: a writer of record-wise compressed WARC files and a splittable reader.

Every record is a gzip member of its own. The reader cuts files into byte ranges; a task looks
for gzip's first bytes in its range, takes a place for a member if the data unpack to a
WARC header there, and owns the records that start inside, reading on past the range's end for
the last. Paths are opened through Arrow's file systems, so that archives may lie wherever
executors reach.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.batches import small_batches
from pulsegrid.operators.joins import attach
from pulsegrid.session import materialise, scratch_path

#: Bytes of an archive file, roughly, and of a range that one task reads.
FILE_BYTES, RANGE_BYTES = 256 << 20, 16 << 20
#: Payloads below so many bytes are never replaced by a reference.
LEAST_REVISIT = 100
#: Bytes read at a time, unpacked to recognise a header, and held before they are passed on.
BLOCK, PROBE, HELD = 1 << 16, 16, 1 << 20

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record(row: dict) -> bytes:
    """A gzip member with one record: an HTTP response, or a revisit that holds its head only."""
    revisit = row["refers_to"] is not None
    payload = row["payload"]
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Target-URI": "".join(c for c in row["url"] or "" if c >= " "),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": f"<{row['refers_to']}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    parts = (VERSION + b"\r\n" + lines.encode() + b"\r\n", block, b"\r\n\r\n")
    return b"".join([*map(packer.compress, parts), packer.flush()])


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write `records` (record_id, url, payload, digest, refers_to) and return `path`, `bytes` of the files.

    A task writes files of its own, named at random, as one stream each: an attempt that fails
    or is repeated leaves files that the returned table doesn't name. A null url is empty, a null payload too; refers_to
    makes a revisit record.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: BinaryIO | None = None
        names: list[str] = []
        sizes: list[int] = []
        system, root = _opened(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    names.append(f"{folder}/{uuid.uuid4().hex}.warc.gz")
                    sizes.append(0)
                    out = system.open_output_stream(f"{root}/{os.path.basename(names[-1])}", compression=None)
                row = {c: batch.column(c)[i].as_py() for c in ("record_id", "url", "payload", "digest", "refers_to")}
                member = _record(row | {"payload": row["payload"] or b""})
                out.write(member)
                sizes[-1] += len(member)
                if sizes[-1] >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], ["path", "bytes"])

    spark = records.sparkSession
    small_batches(spark)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    return materialise(records.mapInArrow(put, "path string, bytes long"), "archives")


class _Window:
    """A file's bytes from some place on, read block by block as they are needed."""

    def __init__(self, file, at: int, end: int):
        self.file, self.at, self.end = file, at, end
        self.data = b""

    def upto(self, stop: int) -> None:
        """Hold the bytes up to `stop`, or to the file's end."""
        while self.at + len(self.data) < min(stop, self.end):
            start = self.at + len(self.data)
            more = self.file.read_at(min(BLOCK, self.end - start), start)
            if not more:  # shorter than said
                self.end = start
            self.data += more

    def drop(self, before: int) -> None:
        self.data = self.data[before - self.at:]
        self.at = before


def _is_member(data: bytes) -> bool:
    """Whether a member that unpacks to a record's first line starts here."""
    try:
        return zlib.decompressobj(31).decompress(data, PROBE).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The unpacked member at a place and where it ends; None if the data are no whole member."""
    unpacker, parts = zlib.decompressobj(31), []
    while not unpacker.eof:
        window.upto(at + BLOCK)
        block = window.data[at - window.at:]
        if not block:
            return None
        try:
            parts.append(unpacker.decompress(block))
        except zlib.error:
            return None
        at += len(block) - len(unpacker.unused_data)
        window.drop(at)
    return b"".join(parts), at


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, unpacked bytes) of the members that start in [start, end) of an open file."""
    window, at = _Window(file, start, size), start
    while at < end:
        # a magic number may straddle two blocks; a header is known from its first hundreds of bytes
        window.upto(at + BLOCK)
        found = window.data.find(MAGIC, at - window.at)
        if found < 0:
            last = window.at + len(window.data)
            if last >= size:
                return
            at = last - len(MAGIC) + 1
            window.drop(at)
            continue
        at = window.at + found
        if at >= end:
            return
        window.drop(at)
        window.upto(at + 4096)
        if _is_member(window.data[:4096]) and (got := _member(window, at)):
            yield at, got[0]
            at = got[1]
        else:
            window = _Window(file, at + 1, size)
            at += 1


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower case) and block of an unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    return fields, rest[:int(length)] if length.isdigit() else rest


READ = "path string, place long, type string, record_id string, url string, digest string, refers_to string, payload_bytes long, payload binary"


def read(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of archive files (`path`, `bytes`), one row each, whatever the ranges.

    payload is an HTTP block's body, and payload_bytes the length its head declares, which for
    revisits is that of the payload they leave out. Damaged stretches between members are
    passed over; other fields a record lacks are null. Empty files have no records.
    """
    spark = files.sparkSession
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                system, name = _opened(path)
                with system.open_input_file(name) as file:
                    rows, held = [], 0
                    for place, record in members(file, size, start, min(size, start + range_bytes)):
                        rows.append((path, place, *_columns(*parse(record))))
                        held += len(record)
                        if held > HELD:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return dealt.mapInArrow(scan, READ)


def _columns(fields: dict[str, str], block: bytes) -> tuple:
    payload, declared = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        lengths = [x.split(b":")[1].strip() for x in head.lower().split(b"\r\n") if x.startswith(b"content-length:")]
        declared = int(lengths[0]) if lengths and lengths[0].isdigit() else len(payload)
    plain = lambda name: fields[name].strip("<>") if name in fields else None
    return (
        fields.get("warc-type"), plain("warc-record-id"), fields.get("warc-target-uri"),
        fields.get("warc-payload-digest"), plain("warc-refers-to"), declared, payload,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = [c.split() for c in READ.split(", ")]
    arrays = [pa.array(v, kinds[kind]) for v, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in columns])


def with_revisits(pages: DataFrame) -> DataFrame:
    """Records to write for `pages` (page_id, url, html): all but the first of equal payloads refer to it.

    The first is the row with the smallest page_id; null ids come last. Rows with equal ids keep a
    record each. Only digests that occur twice are attached: by broadcast after they are counted, else
    salted, so a hot payload isn't dealt to one task.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    size = F.octet_length("payload")
    first = rows.where(size >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    copies = first.where("n > 1").select("digest", "first")
    joined = attach(rows, copies, ["digest"], spread_by=["page_id"])
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        _urn("page_id").alias("record_id"), "url", "payload", "digest",
        F.when(later, _urn("first")).alias("refers_to"),
    )


def _urn(column: str) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")))


def _page(column: str) -> Column:
    return F.regexp_extract(column, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write a record per row of `pages`, read the archives back, and describe what they hold.

    `page_id`, `payload_bytes` and `payload_digest` of the full payload, `record_type` and
    `refers_to` (the response's page_id). A null html is an empty payload; a null page_id stays null.
    Other columns are ignored.
    """
    files = write(with_revisits(pages), scratch_path(spark, "warc"))
    return read(files).select(
        _page("record_id").alias("page_id"),
        "payload_bytes",
        F.when(F.col("type") == "response", F.sha2("payload", 256))
        .otherwise(F.regexp_replace("digest", "^sha256:", ""))
        .alias("payload_digest"),
        F.col("type").alias("record_type"),
        _page("refers_to").alias("refers_to"),
    )


SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p),
r AS (SELECT *, n >= {LEAST_REVISIT} AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS later FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN later THEN first END AS refers_to FROM r"""
