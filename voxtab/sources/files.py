"""File sources: directory scans (A1), transcripts with charset fallback
(A15) and WAV header fields (E1).

Scans use Spark's ``binaryFile`` source; ``content`` is pruned from the read
unless a caller selects it, so listing never reads audio bytes. Decoding
that built-in functions cannot do (GBK text, RIFF chunk walk) is a small
Arrow-batched pandas UDF over the bytes Spark already read."""

from __future__ import annotations

import re
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.functions.columns import path_sort_key, suffix


def _root_pattern(root: str) -> str:
    norm = root.rstrip("/")
    if "://" not in norm and not norm.startswith("file:"):
        import os

        norm = os.path.abspath(norm)
    norm = re.sub(r"^file:(//)?", "", norm)
    return re.escape(norm) + "/(.*)$"


def scan_files(spark: SparkSession, root: str, exts=None, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """A1: files under ``root`` (``path`` as listed, ``rel`` relative to the
    root, ``length``, ``modificationTime``), optionally only those whose last
    suffix is in ``exts`` (case-sensitive), sorted by path components. A
    missing root fails the read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root).select("path", "length", "modificationTime")
    df = df.withColumn("rel", F.regexp_extract("path", _root_pattern(root), 1))
    if not recursive:
        df = df.where(~F.col("rel").contains("/"))
    if exts is not None:
        df = df.where(suffix("rel").isin(list(exts)))
    return df.orderBy(path_sort_key("rel"))


@F.pandas_udf(T.StringType())
def _decode_gbk(b: pd.Series) -> pd.Series:
    def one(x):
        if x is None:
            return None
        try:
            return bytes(x).decode("gbk")
        except (UnicodeDecodeError, ValueError):
            return None

    return b.map(one)


def read_transcripts(spark: SparkSession, root: str, glob: str = "*.lab") -> DataFrame:
    """Transcript files as ``(path, rel, text, encoding)``: UTF-8 when
    the bytes are valid UTF-8, else GBK; undecodable files are dropped."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    as_str = F.col("content").cast("string")
    utf8 = F.is_valid_utf8(as_str)
    out = df.select(
        "path",
        F.regexp_extract("path", _root_pattern(root), 1).alias("rel"),
        F.when(utf8, as_str).otherwise(_decode_gbk(F.when(~utf8, F.col("content")))).alias("text"),  # Python gets the other files only
        F.when(utf8, F.lit("utf-8")).otherwise(F.lit("gbk")).alias("encoding"),
    )
    return out.where(F.col("text").isNotNull())


_HEADER_SCHEMA = T.StructType([
    T.StructField("frames", T.LongType()),
    T.StructField("rate", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("bits", T.IntegerType()),
])


def parse_wav_header(data: bytes, total_length: int | None = None):
    """RIFF/WAVE chunk walk: ``(frames, rate, channels, bits)`` or ``None``."""
    if data is None or len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    pos, fmt, frames = 12, None, None
    while pos + 8 <= len(data):
        cid, size = data[pos:pos + 4], struct.unpack("<I", data[pos + 4:pos + 8])[0]
        body = pos + 8
        if cid == b"fmt " and body + 16 <= len(data):
            _tag, ch, rate, _br, align, bits = struct.unpack("<HHIIHH", data[body:body + 16])
            fmt = (ch, rate, align, bits)
        elif cid == b"data" and fmt is not None:
            avail = size
            if total_length is not None:
                avail = min(size, max(0, total_length - body))
            frames = avail // fmt[2] if fmt[2] else None
            break
        pos = body + size + (size & 1)
    if fmt is None or frames is None:
        return None
    return frames, fmt[1], fmt[0], fmt[3]


@F.pandas_udf(_HEADER_SCHEMA)
def _wav_header(head: pd.Series, length: pd.Series) -> pd.DataFrame:
    rows = [parse_wav_header(None if h is None else bytes(h), int(n) if n is not None else None) for h, n in zip(head, length)]
    return pd.DataFrame(
        [r if r is not None else (None, None, None, None) for r in rows], columns=["frames", "rate", "channels", "bits"]
    )


def media_infos_from_files(spark: SparkSession, root: str, exts=(".wav",)) -> DataFrame:
    """E1 source: ``(path, rel, frames, rate, channels, seconds)`` of WAV
    files. The header walk gets the first 4 KB; files whose ``data`` chunk
    starts later (long metadata before it) are walked whole. Files without a
    readable header give no row."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    df = df.withColumn("rel", F.regexp_extract("path", _root_pattern(root), 1)).where(suffix("rel").isin(list(exts)))
    head = df.withColumn("h", _wav_header(F.substring("content", 1, 4096), F.col("length")))
    late = df.join(head.where(F.col("h.frames").isNull()).select("path"), "path", "left_semi")
    late = late.withColumn("h", _wav_header(F.col("content"), F.col("length")))
    h = head.select("path", "rel", "h").unionByName(late.select("path", "rel", "h"))
    return h.select("path", "rel", "h.frames", "h.rate", "h.channels").where(F.col("frames").isNotNull()).withColumn(
        "seconds", F.col("frames") / F.col("rate")
    )
