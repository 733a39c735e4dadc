"""A1 and E1 without reading whole files: a listing source and ranged header
reads.

``voxtab_listing`` is a Python data source. The driver expands directories
only until there are enough of them to deal out; each task lists its own
below. A non-recursive listing looks at one level. ``media_headers`` then
reads the header fields of any table of paths, dealt by path so that a
directory with a third of all files is read by all tasks: a few ranged reads
of some bytes per file, whatever its size.

Paths are those of a folder that executors share, or URIs that Arrow can open
(``file``, ``s3``, ``gs``, ``hdfs``). For stores that only Spark's readers
reach, ``voxtab.sources.files`` has the forms over ``binaryFile``."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voxtab.functions.columns import path_sort_key

#: Directories that the driver expands to at least, files of a listing task from the top level.
DIRECTORIES, FILES = 64, 10_000
LISTING = "path string, rel string, length bigint, modified timestamp"
HEADER = "format string, frames bigint, rate int, channels int, bits int, bytes_read bigint, error string"


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root:
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root.removeprefix("file:")


@dataclass
class _Part(InputPartition):
    """A directory to list, or files that are listed already."""

    folder: str | None
    files: list[tuple]


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/") or "/"
        self.recursive = options.get("recursive", "true").lower() == "true"
        wanted = options.get("extensions")
        self.extensions = None if wanted is None else set(wanted.split(","))

    def partitions(self) -> list[InputPartition]:
        store, base = _open(self.root)
        if store.get_file_info(base).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no directory {self.root}")
        folders, files = [base], []
        level = 0
        while folders and (level == 0 or len(folders) < DIRECTORIES):
            below = []
            for folder in folders:
                for info in store.get_file_info(fs.FileSelector(folder)):
                    if info.type == fs.FileType.Directory:
                        below.append(info.path)
                    elif info.type == fs.FileType.File:
                        files.append((info.path, info.size, info.mtime))
            folders = below if self.recursive else []
            level += 1
        parts = [_Part(None, files[i : i + FILES]) for i in range(0, len(files), FILES)]
        return [*parts, *(_Part(folder, []) for folder in folders)] or [_Part(None, [])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        store, base = _open(self.root)
        found = partition.files
        if partition.folder is not None:
            infos = store.get_file_info(fs.FileSelector(partition.folder, recursive=True))
            found = ((i.path, i.size, i.mtime) for i in infos if i.type == fs.FileType.File)
        for path, size, modified in found:
            rel = path[len(base.rstrip("/")) + 1 :]
            name = rel.rsplit("/", 1)[-1]
            last = name[name.rfind(".") :] if "." in name[1:] else ""
            if self.extensions is None or last in self.extensions:
                yield path, rel, size, modified


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voxtab_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def list_files(spark: SparkSession, root: str, exts=None, recursive: bool = True) -> DataFrame:
    """A1: ``(path, rel, length, modified)`` of the files under ``root`` whose
    last suffix is in ``exts`` (case-sensitive), by path components. A missing
    root fails."""
    spark.dataSource.register(Listing)
    reader = spark.read.format("voxtab_listing").option("recursive", str(recursive).lower())
    if exts is not None:
        reader = reader.option("extensions", ",".join(exts))
    return reader.load(root).orderBy(path_sort_key("rel"))


ReadAt = Callable[[int, int], bytes]


def _riff(read: ReadAt, length: int, head: bytes) -> tuple:
    """WAVE in RIFF, or in RF64, where 64-bit sizes stand in a chunk of their
    own."""
    at, fmt, wide = 12, None, None
    while at + 8 <= length:
        chunk = read(at, 8)
        name, size = chunk[:4], struct.unpack("<I", chunk[4:8])[0]
        body = at + 8
        if name == b"ds64":
            wide = struct.unpack("<QQQ", read(body, 24))[1]
        elif name == b"fmt ":
            _, channels, rate, _, align, bits = struct.unpack("<HHIIHH", read(body, 16))
            fmt = channels, rate, align, bits
        elif name == b"data":
            if fmt is None or not fmt[2]:
                raise ValueError("no format before the samples")
            size = wide if size == 0xFFFFFFFF and wide is not None else size
            return "wav", min(size, max(0, length - body)) // fmt[2], fmt[1], fmt[0], fmt[3]
        at = body + size + (size & 1)
    raise ValueError("no samples")


def _extended(raw: bytes) -> float:
    """An 80-bit float: sign and exponent, then the whole mantissa."""
    exponent, mantissa = struct.unpack(">HQ", raw)
    return mantissa * 2.0 ** ((exponent & 0x7FFF) - 16383 - 63)


def _aiff(read: ReadAt, length: int, head: bytes) -> tuple:
    at = 12
    while at + 8 <= length:
        chunk = read(at, 8)
        name, size = chunk[:4], struct.unpack(">I", chunk[4:8])[0]
        if name == b"COMM":
            channels, frames, bits = struct.unpack(">hIh", (body := read(at + 8, 18))[:8])
            return "aiff", frames, int(_extended(body[8:18])), channels, bits
        at += 8 + size + (size & 1)
    raise ValueError("no common chunk")


def _flac(read: ReadAt, length: int, head: bytes) -> tuple:
    info = read(8, 34)
    packed = int.from_bytes(info[10:18], "big")  # 20 bits rate, 3 channels less one, 5 bits less one, 36 frames
    return "flac", packed & ((1 << 36) - 1), packed >> 44, ((packed >> 41) & 7) + 1, ((packed >> 36) & 31) + 1


def parse_header(read: ReadAt, length: int) -> tuple:
    """(format, frames, rate, channels, bits) by ranged reads."""
    head = read(0, 12)
    if len(head) < 12:
        raise ValueError("too short")
    if head[:4] in (b"RIFF", b"RF64") and head[8:12] == b"WAVE":
        return _riff(read, length, head)
    if head[:4] == b"FORM" and head[8:12] in (b"AIFF", b"AIFC"):
        return _aiff(read, length, head)
    if head[:4] == b"fLaC":
        return _flac(read, length, head)
    raise ValueError("unknown format")


def media_headers(files: DataFrame, path: str = "path", length: str = "length", tasks: int | None = None) -> DataFrame:
    """``files`` plus ``format``, ``frames``, ``rate``, ``channels``,
    ``bits``, the ``bytes_read`` for them, and ``error`` (null where the
    header was read). RIFF and RF64 WAVE, AIFF and FLAC. A file that cannot be
    read becomes a row with its error."""
    from pyspark.sql import types as T

    fields = T._parse_datatype_string(HEADER).fields
    at, size = files.columns.index(path), files.columns.index(length)
    schema = T.StructType([*files.schema.fields, *fields])
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]

    def one(name: str, total: int) -> tuple:
        taken = 0
        try:
            store, place = _open(name)
            with store.open_input_file(place) as f:

                def read(offset: int, n: int) -> bytes:
                    nonlocal taken
                    f.seek(offset)
                    got = f.read(n)
                    taken += len(got)
                    return got

                return (*parse_header(read, total if total is not None else f.size()), taken, None)
        except (OSError, ValueError, struct.error, OverflowError) as e:
            return (None,) * 5 + (taken, f"{type(e).__name__}: {e}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(p, n) for p, n in zip(b.column(at).to_pylist(), b.column(size).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=schema.names)

    dealt = files.repartition(tasks, path) if tasks else files.repartition(path)
    return dealt.mapInArrow(run, schema)


def media_infos(spark: SparkSession, root: str, exts=(".wav", ".aiff", ".aif", ".flac"), recursive: bool = True) -> DataFrame:
    """E1 source: ``(path, rel, frames, rate, channels, seconds)`` of the
    files under ``root`` whose header can be read."""
    read = media_headers(list_files(spark, root, exts, recursive)).where(F.col("error").isNull())
    return read.select("path", "rel", "frames", "rate", "channels", (F.col("frames") / F.col("rate")).alias("seconds"))
