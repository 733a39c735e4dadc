"""Listing and ranged header reads; ingest with its ledger as state."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from voxtab.sources import media
from voxtab.sources.files import read_transcripts
from voxtab.streaming.ingest import ingest_once


def _wav(frames, rate=16000, ch=1, extra=b"", rf64=False, data=None):
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, ch, rate, rate * ch * 2, ch * 2, 16)
    size = frames * ch * 2
    if rf64:
        head = b"RF64" + struct.pack("<I", 0xFFFFFFFF) + b"WAVE" + b"ds64" + struct.pack("<IQQQI", 28, size + 72, size, frames, 0)
        return head + extra + fmt + b"data" + struct.pack("<I", 0xFFFFFFFF)
    return b"RIFF" + struct.pack("<I", 36 + size) + b"WAVE" + extra + fmt + b"data" + struct.pack("<I", size) + (b"\0" * size if data is None else data)


def _aiff(frames, rate, ch):
    exponent = rate.bit_length() - 1
    extended = struct.pack(">HQ", 16383 + exponent, rate << (63 - exponent))
    return b"FORM" + struct.pack(">I", 46) + b"AIFF" + b"NAME" + struct.pack(">I", 3) + b"abc\0" + b"COMM" + struct.pack(">IhIh", 18, ch, frames, 16) + extended


def _flac(frames, rate, ch):
    packed = rate << 44 | (ch - 1) << 41 | 15 << 36 | frames
    return b"fLaC" + b"\x80\0\0\x22" + b"\0" * 10 + packed.to_bytes(8, "big") + b"\0" * 16


@pytest.fixture()
def tree(tmpdir_fresh):
    big = b"LIST" + struct.pack("<I", 300_001) + b"x" * 300_002  # odd size, padded
    files = {
        "x.wav": _wav(1600), "a/y.wav": _wav(800, 48000, 2), "a/b/late.wav": _wav(50, extra=big), "a/b/z.aiff": _aiff(4410, 44100, 2),
        "c/f.flac": _flac((1 << 35) + 5, 96000, 6), "c/junk.wav": b"junk", "c/empty.wav": b"", "c/t.WAV": _wav(10), "d.e/none": b"1", ".wav": b"",
    }
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{tmpdir_fresh}/{name}"), exist_ok=True)
        with open(f"{tmpdir_fresh}/{name}", "wb") as f:
            f.write(data)
    with open(f"{tmpdir_fresh}/a/huge.wav", "wb") as f:  # over 4 GB, sparse
        head = _wav(1 << 31, 48000, 1, rf64=True)
        f.write(head)
        f.truncate(len(head) + (1 << 32))
    return tmpdir_fresh


def test_listing(spark, tree, monkeypatch):
    rel = lambda *a, **k: [r.rel for r in media.list_files(spark, tree, *a, **k).collect()]
    everything = rel()
    assert len(everything) == 11 and everything == sorted(everything, key=lambda p: p.split("/"))
    assert rel([".wav"]) == [x for x in everything if x.endswith(".wav") and x != ".wav"]
    assert rel(recursive=False) == [".wav", "x.wav"]
    monkeypatch.setattr(media, "DIRECTORIES", 1)  # tasks list everything below the first level
    assert rel() == everything
    with pytest.raises(Exception, match="no directory"):
        media.list_files(spark, f"{tree}/nowhere").collect()


def test_headers_take_few_bytes(spark, tree):
    got = {r.rel: r for r in media.media_headers(media.list_files(spark, tree), tasks=3).collect()}
    told = lambda r: (r.format, r.frames, r.rate, r.channels, r.bits, r.error)
    assert told(got["x.wav"]) == ("wav", 1600, 16000, 1, 16, None)
    assert told(got["a/y.wav"]) == ("wav", 800, 48000, 2, 16, None)
    assert told(got["a/b/late.wav"]) == ("wav", 50, 16000, 1, 16, None)
    assert told(got["a/huge.wav"]) == ("wav", 1 << 31, 48000, 1, 16, None) and got["a/huge.wav"].length > 1 << 32
    assert told(got["a/b/z.aiff"]) == ("aiff", 4410, 44100, 2, 16, None)
    assert told(got["c/f.flac"]) == ("flac", (1 << 35) + 5, 96000, 6, 16, None)
    assert got["c/junk.wav"].error and got["c/empty.wav"].error == "ValueError: too short"
    assert max(r.bytes_read for r in got.values()) < 120
    infos = {r.rel: r.seconds for r in media.media_infos(spark, tree).collect()}
    assert infos["x.wav"] == 0.1 and "c/junk.wav" not in infos and len(infos) == 6


def test_transcripts_keep_both_charsets(spark, tmpdir_fresh):
    for name, data in {"u.lab": "héllo", "g.lab": "你好"}.items():
        with open(f"{tmpdir_fresh}/{name}", "wb") as f:
            f.write(data.encode("utf-8" if name == "u.lab" else "gbk"))
    assert {(r.text, r.encoding) for r in read_transcripts(spark, tmpdir_fresh).collect()} == {("héllo", "utf-8"), ("你好", "gbk")}


def test_ingest_with_state(spark, tmpdir_fresh):
    base = tmpdir_fresh
    rows = lambda ks: spark.createDataFrame([(k, f"2024-01-01 00:0{k % 10}:00") for k in ks], "path long, at string").select("path", F.to_timestamp("at").alias("at"))
    schema = rows([1]).schema
    for ks in ([1, 2, 2], [2, 3], [], [1, 4, None, None]):
        spark_rows = rows([k for k in ks if k is not None]).unionByName(spark.createDataFrame([(None, None)] * ks.count(None), schema))
        spark_rows.write.mode("append").parquet(f"{base}/src")
        ingest_once(spark, f"{base}/src", schema, f"{base}/state", f"{base}/out")
    out = spark.read.parquet(f"{base}/out")
    assert sorted((r.path or 0) for r in out.collect()) == [0, 1, 2, 3, 4]
    ingest_once(spark, f"{base}/src", schema, f"{base}/timed", f"{base}/out2", time="at", expire="1 hour")
    assert sorted((r.path or 0) for r in spark.read.parquet(f"{base}/out2").collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="event-time"):
        ingest_once(spark, f"{base}/src", schema, f"{base}/x", f"{base}/y", expire="1 hour")
