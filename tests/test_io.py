"""Sources, sinks, batch inference and the incremental stream."""

import os
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxtab.operators.infer import batch_infer
from voxtab.sources import sinks
from voxtab.sources.files import media_infos_from_files, parse_wav_header, read_transcripts, scan_files
from voxtab.streaming.ingest import ingest_stream


def _wav(frames, rate=16000, ch=1, bits=16):
    data = b"\x00" * (frames * ch * bits // 8)
    fmt = struct.pack("<HHIIHH", 1, ch, rate, rate * ch * bits // 8, ch * bits // 8, bits)
    body = b"WAVE" + b"fmt " + struct.pack("<I", 16) + fmt + b"LIST" + struct.pack("<I", 4) + b"abcd"
    body += b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_scan_transcripts_and_headers(spark, tmpdir_fresh):
    root = tmpdir_fresh
    os.makedirs(f"{root}/a/b")
    files = {"a/x.wav": _wav(1600), "a/b/y.wav": _wav(800, 48000, 2), "a/z.WAV": b"junk", "a/t.mp3": b"id3",
             "a/x.lab": "你好。".encode("utf-8"), "a/b/y.lab": "中文".encode("gbk")}
    for rel, data in files.items():
        with open(f"{root}/{rel}", "wb") as f:
            f.write(data)
    got = scan_files(spark, root, exts=[".wav", ".mp3"]).toPandas()
    assert got["rel"].tolist() == ["a/b/y.wav", "a/t.mp3", "a/x.wav"]
    flat = scan_files(spark, f"{root}/a", exts=[".wav"], recursive=False).toPandas()
    assert flat["rel"].tolist() == ["x.wav"]
    tr = read_transcripts(spark, root).toPandas().set_index("rel")
    assert tr.loc["a/x.lab", "text"] == "你好。" and tr.loc["a/x.lab", "encoding"] == "utf-8"
    assert tr.loc["a/b/y.lab", "text"] == "中文" and tr.loc["a/b/y.lab", "encoding"] == "gbk"
    infos = media_infos_from_files(spark, root).toPandas().set_index("rel")
    assert infos.loc["a/x.wav", "frames"] == 1600 and infos.loc["a/x.wav", "rate"] == 16000
    assert infos.loc["a/b/y.wav", "channels"] == 2 and infos.loc["a/b/y.wav", "frames"] == 800
    assert parse_wav_header(b"junk") is None
    with pytest.raises(Exception):
        scan_files(spark, f"{root}/missing").count()


def test_sinks_round_trip(spark, tmpdir_fresh):
    scores = spark.createDataFrame(
        [("a.wav", 10.0, 3.0, 3.0, 3.6, 3.1, 2), ("b.wav", 9.5, 2.0, 2.0, 2.5, 2.1, 1)],
        "audio_filepath string, duration double, SIG double, BAK double, OVRL double, P808_MOS double, valid_hops long",
    )
    from voxtab.operators.quality import split_by_quality

    sinks.write_scores_csv(scores, f"{tmpdir_fresh}/csv")
    back = spark.read.option("header", True).csv(f"{tmpdir_fresh}/csv")
    assert back.count() == 2 and back.columns == sinks.SCORE_COLUMNS
    sinks.write_manifests(split_by_quality(scores, 3.5), f"{tmpdir_fresh}/m")
    passed = spark.read.json(f"{tmpdir_fresh}/m/filter_pass.manifest").toPandas()
    assert passed["audio_filepath"].tolist() == ["a.wav"]
    sinks.write_manifests(split_by_quality(scores, None), f"{tmpdir_fresh}/m2")
    assert os.path.isdir(f"{tmpdir_fresh}/m2/filter_pass.manifest") and os.path.isdir(f"{tmpdir_fresh}/m2/filter_fail.manifest")
    clips = spark.createDataFrame([("u1", b"x"), ("u2", b"y"), ("u3", b"z")], "utt_id string, content binary")
    spk = spark.createDataFrame([("u1", "spk0"), ("u2", "spk-1")], "utt_id string, spk string")
    sinks.write_by_speaker(clips, spk, f"{tmpdir_fresh}/spk")
    dirs = sorted(d for d in os.listdir(f"{tmpdir_fresh}/spk") if d.startswith("spk="))
    assert dirs == ["spk=spk-1", "spk=spk0"]


def _lines(folder):
    """The lines of an output folder, and the names in its parent."""
    parts = [open(f"{folder}/{f}", encoding="utf-8").read().splitlines() for f in sorted(os.listdir(folder))]
    return sorted(line for part in parts for line in part), sorted(os.listdir(os.path.dirname(folder)))


def test_manifests_at_once(spark, tmpdir_fresh):
    """One job for both files, replaced together; empty ones are there too."""
    from voxtab.operators.quality import split_by_quality

    scores = spark.range(0, 200, 1, 5).selectExpr(
        "concat('a', id, '.wav') AS audio_filepath", "1.0D AS duration", "3.0D AS SIG", "3.0D AS BAK", "id / 50 AS OVRL", "3.0D AS P808_MOS", "2L AS valid_hops"
    )
    both = ["filter_fail.manifest", "filter_pass.manifest"]
    sinks.write_manifests(split_by_quality(scores, 3.0), f"{tmpdir_fresh}/two")
    spark.sparkContext.setJobGroup("at-once", "manifests")
    try:
        sinks.write_manifests_at_once(split_by_quality(scores, 3.0), f"{tmpdir_fresh}/one")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("at-once")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for name in both:
        exp = sorted(r.value for r in spark.read.text(f"{tmpdir_fresh}/two/{name}").collect())
        assert _lines(f"{tmpdir_fresh}/one/{name}") == (exp, both) and exp
    sinks.write_manifests_at_once(split_by_quality(scores, 9.0), f"{tmpdir_fresh}/one")
    assert _lines(f"{tmpdir_fresh}/one/filter_pass.manifest") == ([], both)
    assert len(_lines(f"{tmpdir_fresh}/one/filter_fail.manifest")[0]) == 200


def test_lines_all_or_nothing(spark, tmpdir_fresh):
    """A failing task or commit leaves what was there, and no staged files."""
    from voxtab.sources.lines import LinesWriter, Staged, write_lines

    path = f"{tmpdir_fresh}/out"
    rows = spark.range(40).selectExpr("if(id % 4 = 0, 'b', 'a') AS output", "if(id = 3, NULL, concat('é', id)) AS value", "1 AS extra").repartition(4)
    write_lines(rows, path, ["a", "b", "none"])
    exp = {"a": sorted("" if i == 3 else f"é{i}" for i in range(40) if i % 4), "b": sorted(f"é{i}" for i in range(0, 40, 4)), "none": []}
    names = ["a", "b", "none"]
    assert all(_lines(f"{path}/{o}") == (exp[o], names) for o in names)
    bad = spark.range(40).repartition(4).selectExpr("'a' AS output", "if(id = 17, raise_error('broken'), 'x') AS value")
    for broken in (bad, rows.withColumn("output", F.lit("other"))):
        with pytest.raises(Exception, match="broken|no output"):
            write_lines(broken, path, names)
        assert all(_lines(f"{path}/{o}") == (exp[o], names) for o in names)
    write_lines(rows.where("output = 'b'"), path, ["b"], mode="append")
    assert _lines(f"{path}/b") == (sorted(2 * exp["b"]), names)
    writer = LinesWriter({"path": path, "outputs": "a,b"}, overwrite=True)
    moves = []

    def move(store, source, target, done):
        moves.append(source)
        if len(moves) == 3:
            raise OSError("store is gone")
        LinesWriter._move(store, source, target, done)

    writer._move = move
    with pytest.raises(OSError):
        writer.commit([None, Staged([])])
    writer.abort([])
    assert _lines(f"{path}/a") == (exp["a"], names) and _lines(f"{path}/b")[0] == sorted(2 * exp["b"])
    write_lines(spark.createDataFrame([], "output string, value string"), f"{tmpdir_fresh}/none", ["a"])
    assert _lines(f"{tmpdir_fresh}/none/a") == ([], ["a"])
    with pytest.raises(ValueError):
        write_lines(rows, path, [])


def test_batch_infer_counts_failures(spark):
    df = spark.createDataFrame(pd.DataFrame({"id": range(20), "x": [1.0] * 19 + [-1.0]})).repartition(3)

    def predict(model, pdf):
        if (pdf["x"] < 0).any():
            raise ValueError("negative")
        return pd.DataFrame({"y": pdf["x"] * model})

    out = batch_infer(df, lambda: 2.0, predict, "y double", ["id"]).toPandas()
    assert len(out) == 20
    assert (out["status"] == "failed").sum() == 1 and out.loc[out.status == "failed", "id"].tolist() == [19]
    assert (out.loc[out.status == "success", "y"] == 2.0).all()


def test_ingest_stream_adds_only_new_rows(spark, tmpdir_fresh):
    src, ck, out, led = (f"{tmpdir_fresh}/{n}" for n in ("src", "ck", "out", "ledger"))
    schema = "path string, n long"
    spark.createDataFrame([(f"f{i}", i) for i in range(5)], schema).write.parquet(f"{src}/p1")
    from pyspark.sql import types as T

    st = T._parse_datatype_string(schema)
    ingest_stream(spark, f"{src}/*", st, ck, out, led)
    assert spark.read.parquet(out).count() == 5
    ingest_stream(spark, f"{src}/*", st, ck, out, led)
    assert spark.read.parquet(out).count() == 5
    spark.createDataFrame([(f"f{i}", i) for i in range(3, 9)], schema).write.parquet(f"{src}/p2")
    ingest_stream(spark, f"{src}/*", st, ck, out, led)
    got = spark.read.parquet(out)
    assert got.count() == 9 and got.select("path").distinct().count() == 9
    assert spark.read.parquet(led).where(F.col("status") == "success").count() == 9
