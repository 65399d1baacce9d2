"""Deterministic sharded WARC writer and reader.

Records are sorted by (page_id, digest) into shards whose bounds are quantiles
of a bounded sample of page_ids, chosen by hash, so the same pages always give
the same shards. A task writes the records of its shards one gzip member each,
rolls to a new file once the compressed size passes a limit, and regenerates
every header and digest from the payload alone: equal input gives equal bytes.
A file is written under a temporary name and renamed when it is whole; the
rename replaces an equal file, so a repeated task does no harm. The manifest
lists the files with records, bytes and SHA-256. It is written last, and readers
open only what it lists: files of tasks that did not finish are never read.

Bodies move once, to their shard. Which record answers for equal payloads is
found on digests alone; that decision travels in the same shuffle, as a narrow
row ahead of its body.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest"


@dataclass(frozen=True)
class WarcConfig:
    """``roll_bytes``: compressed size at which a file is closed.
    ``shard_bytes``: payload bytes a shard should hold. ``sample_ids`` bounds
    the sample behind the shard bounds. ``min_revisit``: shortest payload that
    another record may stand for. ``date``: the fixed WARC-Date."""

    roll_bytes: int = 64 << 20
    shard_bytes: int = 32 << 20
    sample_ids: int = 20_000
    min_revisit: int = 100
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _header_value(value: object) -> str:
    """One line, so that no value can end a header."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


def record_bytes(page_id: object, url: str | None, payload: bytes, digest: str, refers: object, config: WarcConfig) -> bytes:
    """A whole record; one with ``refers`` holds no payload but names its digest."""
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {config.date}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    body = payload
    if refers is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers, digest)}", f"X-Refers-To-Page: {refers}"]
        body = b""
    lines += [
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip_member(data: bytes, level: int) -> bytes:
    """Without a time stamp, so equal data gives equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Files of one shard; ``close`` gives the manifest row of the open one."""

    def __init__(self, folder: str, shard: int, config: WarcConfig):
        self.fs, self.folder = _filesystem(folder)
        self.shard, self.config, self.part, self.out = shard, config, 0, None

    def add(self, member: bytes) -> dict | None:
        if self.out is None:
            self.name = f"warc-{self.shard:08d}-{self.part:05d}.warc.gz"
            self.temp = posixpath.join(self.folder, f".{self.name}.{uuid.uuid4().hex}")
            self.out, self.sha, self.bytes, self.records = self.fs.open_output_stream(self.temp, compression=None), hashlib.sha256(), 0, 0
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1
        return self.close() if self.bytes >= self.config.roll_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, posixpath.join(self.folder, self.name))
        row = {"file": self.name, "shard": self.shard, "part": self.part, "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()}
        self.part, self.out = self.part + 1, None
        return row


_MANIFEST_ROW = "file string, shard long, part long, records long, bytes long, sha256 string"


def _writer(folder: str, config: WarcConfig):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, role = None, None

        def out(rows):
            names = [c.split()[0] for c in _MANIFEST_ROW.split(", ")]
            found = [r for r in rows if r]
            return pa.RecordBatch.from_pydict(
                {n: pa.array([r[n] for r in found], pa.string() if n in ("file", "sha256") else pa.int64()) for n in names}
            )

        for batch in batches:
            for shard, page_id, digest, kind, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if kind == 0:  # a decision, ahead of its bodies
                    role = (page_id, digest, refers)
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        yield out([roller.close()])
                    roller = _Roller(folder, shard, config)
                payload = (html or "").encode()
                target = role[2] if role is not None and role[:2] == (page_id, digest) else None
                done = roller.add(_gzip_member(record_bytes(page_id, url, payload, digest, target, config), config.level))
                if done:
                    yield out([done])
        if roller is not None:
            yield out([roller.close()])

    return write


def _shard_bounds(pages: DataFrame, shards: int, config: WarcConfig) -> np.ndarray:
    """Quantiles of the page_ids with the smallest hashes: a sample that does not
    depend on how the rows are split. At most ``sample_ids`` come to the driver."""
    sample = pages.select("page_id").where(F.col("page_id").isNotNull())
    ids = sorted(r[0] for r in sample.orderBy(F.xxhash64("page_id"), "page_id").limit(config.sample_ids).collect())
    cuts = [ids[len(ids) * k // shards] for k in range(1, shards)] if ids else []
    return np.unique(np.array(cuts, dtype="int64"))


def revisits(pages: DataFrame, config: WarcConfig = WarcConfig()) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the records that another answers for."""
    html = F.coalesce("html", F.lit(""))
    narrow = pages.select("page_id", F.octet_length(html).alias("_n"), F.sha2(html, 256).alias("digest"))
    narrow = narrow.where(F.col("_n") >= config.min_revisit).select("page_id", "digest")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1")
    found = narrow.join(first.select("digest", "refers_to"), "digest").distinct()
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())


def write_archive(pages: DataFrame, folder: str, config: WarcConfig = WarcConfig()) -> None:
    """Write ``pages(page_id, url, html)`` to ``folder`` and commit the manifest.

    Null html is an empty payload, a null url leaves its header out. Rows without
    page_id form the first shard and never answer for others while one with an id
    exists. Rows that repeat page_id and payload get equal records, and all are
    responses if they hold the smallest page_id. Extra columns are not stored.
    """
    pages = pages.select("page_id", "url", "html")
    size = pages.agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))))).first()[0] or 0
    shards = max(1, math.ceil(size / config.shard_bytes))
    bounds = _shard_bounds(pages, shards, config)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids, side="right") + 1, dtype="int32")

    known = F.when(F.col("page_id").isNull(), F.lit(0)).otherwise(shard_of(F.coalesce("page_id", F.lit(0))))
    bodies = pages.select(
        "page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"), F.lit(1).alias("kind"), "url", "html",
        F.lit(None).cast("long").alias("refers_to"),
    )
    roles = revisits(pages, config).select(
        "page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to"
    )
    rows = bodies.unionByName(roles).withColumn("shard", known)
    rows = rows.select("shard", "page_id", "digest", "kind", "url", "html", "refers_to")
    placed = rows.repartition(shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    placed.mapInArrow(_writer(folder, config), _MANIFEST_ROW).write.mode("overwrite").parquet(posixpath.join(folder, MANIFEST))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_ROW).parquet(posixpath.join(folder, MANIFEST))


def parse_records(stream, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and body of each record of a multi-member gzip stream.

    Holds one record at a time; Content-Length, not a blank line, ends a body.
    """
    data, unzip, raw = bytearray(), zlib.decompressobj(31), b""

    def more() -> bool:
        nonlocal unzip, raw
        while True:
            if unzip.eof:
                raw, unzip = unzip.unused_data or raw, zlib.decompressobj(31)
            if not raw:
                raw = stream.read(chunk)
                if not raw:
                    return False
            got, raw = unzip.decompress(raw), b""
            if got:
                data.extend(got)
                return True
            if not unzip.eof and not unzip.unconsumed_tail:
                continue

    while True:
        while (at := data.find(b"\r\n\r\n")) < 0:
            if not more():
                if data.strip():
                    raise ValueError("a record ends in its header")
                return
        lines = data[:at].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = at + 4 + int(headers["Content-Length"])
        while len(data) < end + 4:
            if not more():
                raise ValueError("a record ends in its body")
        yield headers, bytes(data[at + 4 : end])
        del data[: end + 4]


def read_archive(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of the files that the manifest lists.

    A response's digest and length are taken from its payload and must agree
    with its header; a revisit's are those of the payload it stands for. A file
    whose size differs from the manifest is an error.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, size in zip(batch["file"], batch["bytes"], strict=True):
                fs, path = _filesystem(posixpath.join(folder, name))
                if fs.get_file_info(path).size != size:
                    raise ValueError(f"{name} is not as its manifest says")
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for h, body in parse_records(stream):
                        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        length = int(h["X-Payload-Length"])
                        if h["WARC-Type"] == "response":
                            length, found = len(body), hashlib.sha256(body).hexdigest()
                            if found != digest:
                                raise ValueError(f"{name}: a payload differs from its digest")
                        to, of = h.get("X-Refers-To-Page"), h.get("X-Page-ID")
                        rows.append((
                            int(of) if of else None, h.get("WARC-Target-URI"), length, digest, h["WARC-Type"], int(to) if to else None,
                            body.decode() if payloads else None,
                        ))
                        held += len(body) if payloads else 200
                        if held > 8 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows)

    files = manifest(spark, folder).select("file", "bytes")
    spread = files.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    found = spread.mapInPandas(read, schema)
    return found if payloads else found.drop("payload")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})
