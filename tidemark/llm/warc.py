"""WARC archives: a deterministic sharded writer and its reader.

Records are dealt to shards by ranges of their page id, in two levels.  The bounds are quantiles of
samples taken by hash, so they depend on the rows alone; row counts decide how many there are.  A
shard is sorted and written as gzip members, one a record; a file is closed once its compressed
bytes reach ``roll_bytes``.  Headers and digests are made anew from the payload.  Of equal
payloads of ``revisit_bytes`` or more, the smallest page id is written in full (``response``) and
the rest refer to it (``revisit``).

A task writes under a temporary name with the attempt in it (in a folder that is removed before the
manifest is written), renames the finished file and returns its line of the manifest: file, records, bytes, SHA-256.  The manifest, written last,
lists what counts.  Contents depend on the rows alone, so a task that runs again, on another
executor too, replaces a file by the same bytes.  Files go through ``pyarrow.fs``, so the folder
may be any store that it opens; a folder without a scheme is on Spark's default file system.

Defined cases: a null html is the empty payload; null page ids sort first in the archive, but
last when a response is chosen; rows with the same page id and payload: one is the response and
the rest revisit it (they are in one shard); an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_ROWS, join_counted, ship_by_value, stage, staging_dir

ship_by_value(__name__)

# Fixed values of the format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_TEMPORARY = "_temporary"

#: rows of a shard, about; sampled rows per shard that choose the bounds
SHARD_ROWS = 4_000
_SAMPLED = 64

_MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
_RECORD = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string, file string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool, copy: int) -> bytes:
    """One record; ``copy`` tells rows apart that share page id and payload."""
    digest = payload_digest(payload)
    target = "".join(c for c in (url or "") if c not in "\r\n ") or "urn:none"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        _VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, json.dumps([page_id, digest, copy]))}>",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if revisit:
        lines.append(f"WARC-Profile: {_PROFILE}")
        if refers_to is not None:
            lines.append(f"Refers-To-Page-Id: {refers_to}")
            lines.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_SPACE, json.dumps([refers_to, digest, 0]))}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def resolved(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and authority, as Spark itself resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store and path of a resolved folder."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class _Roll:
    """Files of one shard: temporary while open, renamed when closed."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.store, self.path = _open(folder)
        self.shard, self.roll_bytes, self.number = shard, roll_bytes, 0
        self.attempt, self.out, self.lines = uuid.uuid4().hex, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.path}/{_TEMPORARY}/{self.attempt}-{self.name}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.records, self.size, self.hash = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        self.hash.update(member)
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.path}/{self.name}")
            self.lines.append((self.shard, self.name, self.records, self.size, self.hash.hexdigest()))
            self.out, self.number = None, self.number + 1


def _writer(folder: str, roll_bytes: int):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll: _Roll | None = None
        lines: list[tuple] = []
        last, copy = None, 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                if roll is None or roll.shard != row.shard:
                    if roll is not None:
                        roll.close()
                        lines += roll.lines
                    roll = _Roll(folder, int(row.shard), roll_bytes)
                payload = bytes(row.payload)
                # rows that share page id and payload follow one another; they are numbered
                same = (row.page_id, payload)
                last, copy = same, copy + 1 if same == last else 0
                revisit = bool(row.grouped) and not (row.page_id == row.first and copy == 0)
                data = record_bytes(row.page_id, row.url, payload, row.first if revisit else None, revisit, copy)
                roll.add(_gzip_member(data))
        if roll is not None:
            roll.close()
            lines += roll.lines
        yield pd.DataFrame(lines, columns=["shard", "file", "records", "bytes", "sha256"])
    return write


def _sampled(ids: DataFrame, every: int) -> DataFrame:
    return ids.where(F.pmod(F.xxhash64("page_id"), F.lit(max(1, every))) == 0).distinct()


def _quantiles(ids: Column, count: int | Column) -> Column:
    """``count - 1`` of the sorted ids, at even distances, without equal ones."""
    at = F.sequence(F.lit(1), F.greatest(F.lit(count) - 1, F.lit(1)))
    picked = F.array_distinct(F.transform(at, lambda k: F.get(ids, F.floor(F.size(ids) * k / F.lit(count)).cast("int"))))
    return F.when(F.lit(count) > 1, picked).otherwise(F.slice(ids, 1, 0))


def with_shards(pages: DataFrame, dealt: DataFrame) -> tuple[DataFrame, int]:
    """Adds ``shard``, increasing with the page id, and the number of shards.

    Ranges of two levels, so that the driver holds the square root of the number of shards: coarse
    bounds from a sample by hash, then, in a table, the bounds of every coarse range from a sample
    of its own and its row count.  Nulls are in the first shard.
    """
    ids = pages.where(F.col("page_id").isNotNull()).select("page_id")
    rows = ids.count()
    wide = max(1, math.isqrt(-(-rows // SHARD_ROWS)))
    found = sorted(r["page_id"] for r in _sampled(ids, rows // (wide * _SAMPLED)).collect()) if wide > 1 else []
    coarse = sorted({found[len(found) * k // wide] for k in range(1, wide)}) if found else []
    range_of = lambda df: df.withColumn("_coarse", _at_or_below(F.col("page_id"), F.lit(coarse), len(coarse)) if coarse else F.lit(0))
    counted = range_of(ids).groupBy("_coarse").agg(F.count(F.lit(1)).alias("_n"))
    sample = range_of(_sampled(ids, SHARD_ROWS // _SAMPLED)).groupBy("_coarse").agg(F.sort_array(F.collect_list("page_id")).alias("_ids"))
    parts = F.ceil(F.col("_n") / SHARD_ROWS).cast("int")
    fine = stage(counted.join(sample, "_coarse").select("_coarse", _quantiles(F.col("_ids"), parts).alias("_bounds")))
    most = fine.agg(F.max(F.size("_bounds"))).first()[0] or 0
    # a range a row: as many as coarse bounds, each with the ids of its shards
    joined = range_of(dealt).join(F.broadcast(fine) if len(coarse) <= BROADCAST_ROWS and rows <= BROADCAST_ROWS * SHARD_ROWS else fine, "_coarse", "left")
    at = _at_or_below(F.col("page_id"), F.coalesce("_bounds", F.array_repeat(F.col("page_id"), 0)), most)
    shard = F.col("_coarse") * (most + 1) + at
    numbered = joined.withColumn("shard", F.coalesce(F.when(F.col("page_id").isNotNull(), shard), F.lit(0)).cast("int"))
    return numbered.drop("_coarse", "_bounds"), (len(coarse) + 1) * (most + 1)


def _at_or_below(value: Column, bounds: Column, most: int) -> Column:
    """How many of the sorted bounds, ``most`` at most, are at or below the value, by binary search."""
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        right = (acc["low"] < acc["high"]) & (F.get(bounds, middle) <= value)
        return F.struct(F.when(right, middle + 1).otherwise(acc["low"]).alias("low"), F.when(right, acc["high"]).otherwise(middle).alias("high"))

    steps = F.lit(list(range(most.bit_length() + 1)))
    return F.aggregate(steps, start, halve)["low"]


def with_revisits(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, grouped, first`` for every row.

    Payloads are grouped by SHA-256 as counts and the smallest id, so a payload that a third of
    all pages share is combined before the shuffle, and payloads themselves are not shuffled;
    the groups of two or more rows are joined back.  ``first`` is the group's response.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    large = keyed.where(F.octet_length("payload") >= revisit_bytes)
    groups = stage(large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1").select("digest", "first", F.lit(True).alias("grouped")))
    return join_counted(keyed, groups, ["digest"], "left").select("page_id", "url", "payload", "digest", F.coalesce("grouped", F.lit(False)).alias("grouped"), "first")


def write_archive(pages: DataFrame, folder: str, revisit_bytes: int = 0, roll_bytes: int = 16 << 20) -> DataFrame:
    """Writes the archive and returns its manifest, which is also written to ``folder/manifest``."""
    spark = pages.sparkSession
    folder = resolved(spark, folder)
    store, path = _open(folder)
    store.create_dir(f"{path}/{_TEMPORARY}", recursive=True)
    dealt, shards = with_shards(pages, with_revisits(pages, revisit_bytes))
    ordered = dealt.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "url")
    text = ordered.select("shard", F.col("page_id").cast("string").alias("page_id"), "url", "payload", "grouped", F.col("first").cast("string").alias("first"))
    lines = stage(text.mapInPandas(_writer(folder, roll_bytes), _MANIFEST))
    # what attempts that were lost have left behind
    store.delete_dir(f"{path}/{_TEMPORARY}")
    lines.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _headers(data: io.BufferedIOBase) -> dict[str, str] | None:
    first = data.readline()
    if not first:
        return None
    if first.strip().decode() != _VERSION:
        raise ValueError(f"no record starts here: {first[:40]!r}")
    out = {}
    while (line := data.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        out[name] = value
    return out


def read_file(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, one gzip member after the other."""
    unpack, pending, data = zlib.decompressobj(31), b"", []
    while True:
        if not pending:
            pending = stream.read(1 << 20)
            if not pending:
                if data:
                    raise ValueError("the last member is cut off")
                return
        data.append(unpack.decompress(pending))
        pending = b""
        if unpack.eof:
            pending, record = unpack.unused_data, io.BytesIO(b"".join(data))
            unpack, data = zlib.decompressobj(31), []
            headers = _headers(record)
            yield headers, record.read(int(headers["Content-Length"]))


def _reader(folder: str):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _open(folder)
        for frame in frames:
            for name in frame["file"]:
                out = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in read_file(stream):
                        if headers["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
                            raise ValueError(f"{name}: a block differs from its digest")
                        http, _, body = block.partition(b"\r\n\r\n")
                        size = int(http.decode().split("Content-Length: ")[1].split("\r\n")[0])
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (len(body) != size or payload_digest(body) != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        out.append((headers.get("Page-Id"), size, digest, kind, headers.get("Refers-To-Page-Id"), headers["WARC-Target-URI"], name))
                        if len(out) >= 5000:
                            yield pd.DataFrame(out, columns=_RECORD_NAMES)
                            out = []
                yield pd.DataFrame(out, columns=_RECORD_NAMES)
    return read


_RECORD_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files in the manifest, digests verified; ids as strings."""
    folder = resolved(spark, folder)
    files = spark.read.parquet(f"{folder}/manifest").select("file")
    return files.repartition(max(1, files.count()), "file").mapInPandas(_reader(folder), _RECORD)


def archived(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Writes the pages to a new folder among the staged tables and reads them back."""
    spark = pages.sparkSession
    folder = f"{staging_dir(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(pages, folder, revisit_bytes)
    kind = pages.schema["page_id"].dataType
    back = read_archive(spark, folder)
    as_id = lambda c: F.col(c).cast(kind if not isinstance(kind, T.NullType) else "string")
    return back.select(as_id("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to"))
