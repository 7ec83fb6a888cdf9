"""Media columns: payloads live as image members of zip archives, which a Spark data source writes and reads by byte range."""

from __future__ import annotations

import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from galenus.llm.shared import bounded_batches, shared_dir

#: Bytes of a row of samples; payloads are padded to a positive multiple.
UNIT = 64

#: A writing task starts a new archive beyond this size, and a reading task takes about this many bytes.
ARCHIVE_BYTES, RANGE_BYTES = 256 << 20, 16 << 20

#: Members of one Arrow batch end at this many payload bytes.
BATCH_BYTES = 8 << 20

RETRIES, WAIT_S = 3, 0.2
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + b"\0" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def to_image(payload: bytes) -> bytes:
    """An 8-bit grey PNG, UNIT samples wide, without row filters."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT)
    lines = np.zeros((len(rows), UNIT + 1), dtype=np.uint8)
    lines[:, 1:] = rows

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", UNIT, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def from_image(image: bytes) -> bytes:
    """The samples of ``to_image``; raises ValueError if a check sum or the format is wrong."""
    if image[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, data, size = 8, [], (0, 0)
    while at < len(image):
        n, kind = struct.unpack_from(">I4s", image, at)
        body = image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            size = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(size[1], size[0] + 1)
    if lines[:, 0].any():
        raise ValueError("row filters are not used here")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Mean, standard deviation and entropy of the samples, and the share of neighbours on either side of the middle."""
    x = np.frombuffer(payload, dtype=np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    level, mean = np.arange(256), float(share @ np.arange(256))
    spread = float(share @ (level - mean) ** 2) ** 0.5
    used = share[share > 0]
    high = x >= 128
    return f"mean={mean:.4f};std={spread:.4f};entropy={float(-(used * np.log2(used)).sum()):.4f};cross={float((high[1:] != high[:-1]).mean()):.4f}"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class Archives(WriterCommitMessage):
    names: list[str]
    sizes: list[int]


@dataclass
class ByteRange(InputPartition):
    path: str
    size: int
    start: int
    end: int


class ArchiveWriter(DataSourceArrowWriter):
    """Each task attempt writes archives under names of its own; the commit lists those that count."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Archives:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        names, sizes, archive, out, number = [], [], None, None, 0

        def close() -> None:
            if archive is not None:
                archive.close()
                sizes.append(out.tell())
                out.close()

        for b in iterator:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if archive is None or out.tell() > ARCHIVE_BYTES:
                    close()
                    names.append(f"media-{uuid.uuid4().hex}.zip")
                    out = pa.PythonFile(store.open_output_stream(f"{root}/{names[-1]}"), mode="w")
                    archive = zipfile.ZipFile(_Forward(out), "w", zipfile.ZIP_STORED)
                raw_size = len((text or "").encode())
                info = zipfile.ZipInfo(f"{number:010d}.png")
                info.comment = json.dumps({"doc_id": doc, "n_bytes": raw_size}).encode()
                archive.writestr(info, to_image(padded(text)))
                number += 1
        close()
        return Archives(names, sizes)

    def commit(self, messages: list[Archives | None]) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        listed = [{"name": n, "size": s} for m in messages if m for n, s in zip(m.names, m.sizes, strict=True)]
        with store.open_output_stream(f"{root}/_archives.json") as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages: list[Archives | None]) -> None:
        store, root = _open(self.path)
        for m in messages:
            for n in m.names if m else ():
                store.delete_file(f"{root}/{n}")


class _Forward(io.RawIOBase):
    """A forward-only file for zipfile, which then writes sizes behind its members."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


def _in_block(block: bytes, start: int, info: zipfile.ZipInfo) -> bytes | None:
    """A member's stored bytes out of a block that begins at ``start``; None if they aren't whole there or fail their check sum."""
    at = info.header_offset - start
    if len(block) < at + 30:
        return None
    name, extra = struct.unpack_from("<HH", block, at + 26)
    data = block[at + 30 + name + extra : at + 30 + name + extra + info.compress_size]
    return data if len(data) == info.compress_size and zlib.crc32(data) == info.CRC else None


class ArchiveReader(DataSourceReader):
    """Plans byte ranges of the listed archives. A task reads its archive's directory (at the end of the file) and takes
    the members that start in its range, so the driver never holds members' names."""

    def __init__(self, path: str, range_bytes: int, on_error: str):
        self.path, self.range_bytes, self.on_error = path, range_bytes, on_error

    def partitions(self) -> list[ByteRange]:
        store, root = _open(self.path)
        with store.open_input_file(f"{root}/_archives.json") as f:
            listed = json.loads(f.read())
        return [ByteRange(f"{root}/{a['name']}", a["size"], at, at + self.range_bytes) for a in listed for at in range(0, a["size"], self.range_bytes)] or [ByteRange("", 0, 0, 0)]

    def _block(self, f, start: int, end: int) -> bytes:
        """All members of a range in one request; nothing if it fails, as members are then read one by one."""
        try:
            f.seek(start)
            return f.read(end - start)
        except OSError:
            return b""

    def _member(self, path: str, info: zipfile.ZipInfo) -> bytes:
        """The stored bytes of one member, by its offset; each try opens the file anew and checks the member alone."""
        store, _ = _open(self.path)
        for left in range(RETRIES - 1, -1, -1):
            try:
                with store.open_input_file(path) as f:
                    f.seek(info.header_offset)
                    name, extra = struct.unpack_from("<HH", f.read(30), 26)
                    f.seek(info.header_offset + 30 + name + extra)
                    data = f.read(info.compress_size)
                if zlib.crc32(data) != info.CRC:
                    raise OSError(f"{path} at {info.header_offset}: wrong check sum")
                return data
            except OSError:
                if not left:
                    raise
                time.sleep(WAIT_S)
        raise AssertionError

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = _open(self.path)
        with store.open_input_file(partition.path) as f, zipfile.ZipFile(f) as archive:
            every = sorted(archive.infolist(), key=lambda i: i.header_offset)
            ends = [*(i.header_offset for i in every[1:]), archive.start_dir]
            taken = [(i, end) for i, end in zip(every, ends, strict=True) if partition.start <= i.header_offset < partition.end]
            block = self._block(f, taken[0][0].header_offset, taken[-1][1]) if taken else b""
        rows: list[tuple] = []
        held = 0
        for info, _ in taken:
            about = json.loads(info.comment)
            try:
                data, error = _in_block(block, taken[0][0].header_offset, info), None
                if data is None:
                    data = self._member(partition.path, info)
            except OSError as e:
                if self.on_error != "null":
                    raise
                data, error = None, str(e)
            rows.append((about["doc_id"], about["n_bytes"], data, info.header_offset, error))
            held += len(data or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


SCHEMA = "doc_id long, n_bytes long, content binary, member_offset long, error string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])


class MediaArchives(DataSource):
    """``format("media_archives")``: option path; range_bytes; on_error "fail" or "null" (an unreadable member's row keeps its error)."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)), self.options.get("on_error", "fail"))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])


def write_media(docs: DataFrame, path: str) -> None:
    """Store every row's whole text as an image member of archives below ``path``."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaArchives)
    bounded_batches(spark)
    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).write.format("media_archives").mode("append").option("path", path).save()


def read_media(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").options(path=path, **options).load()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for b in batches:
        out = []
        for doc, n, content in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            p = from_image(content)
            out.append((doc, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:]), len(content), hashlib.sha256(content).hexdigest(), feature(p)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def media_features(docs: DataFrame) -> DataFrame:
    """Write every row of ``docs`` (doc_id, text) to archives in the shared folder, read them back, and describe what was read.

    A null text is empty and has UNIT zero bytes; repeated rows are members of
    their own; a null doc_id stays null; no rows, no archives and no result.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "media")
    write_media(docs, path)
    bounded_batches(spark)
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return read_media(spark, path).select("doc_id", "n_bytes", "content").mapInArrow(_features, schema)
