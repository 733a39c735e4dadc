"""Cases the fixtures lack: wide integers, null keys, hot values, empty
recordings, windows shorter than a hop, late WAV data, string ids."""

import os
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxtab.operators import segments as C
from voxtab.operators import signal as D
from voxtab.operators import silence as S
from voxtab.operators import speakers as SP
from voxtab.plans.chain import chain_walk
from voxtab.plans.scan import exact_median, ordered_scan
from voxtab.sources.files import media_infos_from_files
from voxtab.streaming.ingest import ingest_stream


def test_scan_keeps_wide_integers(spark):
    big = 2**60 + 1
    rows = [(1, 0, big), (1, 1, None), (1, 2, big + 2)]
    got = ordered_scan(spark.createDataFrame(rows, "k long, i long, v long"), ["k"], ["i"], sums=["v"], ffills=["v"], prevs=["v"]).orderBy("i").collect()
    assert [r.v for r in got] == [big, None, big + 2]
    assert [r.ffill_v for r in got] == [big, big, big + 2]
    assert [r.prev_v for r in got] == [None, big, None]
    assert [r.cum_v for r in got] == [big, big, 2 * big + 2]


def test_scan_null_and_nan_keys_are_groups(spark):
    rows = [(None, None, i) for i in range(40)] + [("a", float("nan"), i) for i in range(40)] + [("a", 1.0, i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, x double, i long").repartition(7)
    for parts in (None, 5):
        got = ordered_scan(df, ["k", "x"], ["i"], sums=["i"], partitions=parts).collect()
        assert len(got) == 120 and all(r.pos == r.i and r.cum_i == r.i * (r.i + 1) // 2 for r in got)


def test_median_with_a_value_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.zeros(1000), rng.normal(size=2001) * 3 - 0.5])
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    assert exact_median(df, "v").first()["median"] == np.median(x)
    keyed = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0)], "k string, v double")
    assert {r.k: r["median"] for r in exact_median(keyed, "v", ["k"]).collect()} == {None: 1.5, "a": 5.0}


def test_chain_walk_over_many_runs(spark):
    rng = np.random.default_rng(4)
    rows, starts, exp = [], [], set()
    for key, n in (("hot", 3000), ("b", 10), ("c", 1)):
        step = rng.integers(1, 9, n)
        for i in range(n):
            rows.append((key, i, int(i + step[i]) if i + step[i] < n else None))
        starts.append((key, 0))
        at = 0
        while at is not None:
            exp.add((key, at))
            at = int(at + step[at]) if at + step[at] < n else None
    nxt = spark.createDataFrame(rows, "k string, node long, next long")
    for run in (7, 4096):  # a run is crossed hundreds of times, or never
        got = chain_walk(nxt, spark.createDataFrame(starts, "k string, node long"), ["k"], run=run).collect()
        assert sorted((r.k, r.node) for r in got) == sorted(exp)


def test_empty_recording_has_no_segment(spark):
    infos = spark.createDataFrame([("a", 0, 10), ("b", 25, 10)], "path string, frames long, rate int")
    got = C.segment_fixed(infos, 1.0).collect()
    assert sorted((r.path, r.seg_idx, r.start, r.end) for r in got) == [("b", 0, 0, 10), ("b", 1, 10, 20), ("b", 2, 20, 25)]


def test_window_shorter_than_hop(spark):
    n, win, hop = 35, 4, 10
    x = np.full(n, 0.5)
    df = spark.createDataFrame(pd.DataFrame({"utt_id": 0, "idx": np.arange(n), "sample": x}))
    got = {r.frame_idx: r.rms for r in S.frame_rms(df, win, hop).collect()}
    padded = np.concatenate([np.zeros(win // 2), x, np.zeros(win)])
    exp = {t: float(np.sqrt((padded[t * hop : t * hop + win] ** 2).mean())) for t in range(1 + n // hop)}
    assert got.keys() == exp.keys() and all(abs(got[t] - exp[t]) < 1e-12 for t in exp)


def test_merge_of_different_rates_fails(spark):
    infos = spark.createDataFrame([("a/1", "en", 5, 10), ("a/2", "en", 5, 20)], "path string, lang string, frames long, rate int")
    with pytest.raises(Exception, match="sample rates differ"):
        C.merge_short_corpus(infos, key=("lang",)).collect()


def test_spikes_of_a_window_below_one_sample(spark):
    got = D.repair_spikes(spark.createDataFrame([(0, 0, 0.9)], "utt_id long, idx long, sample double"), rate=10).first()
    assert got.repaired == 0.9 and got.was_spike is False


def _wav(path, extra):
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, 16000, 32000, 2, 16)
    junk = struct.pack("<4sI", b"LIST", extra) + b"x" * extra
    data = struct.pack("<4sI", b"data", 3200) + b"\0" * 3200
    body = b"WAVE" + fmt + junk + data
    with open(path, "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", len(body)) + body)


def test_wav_data_after_long_metadata(spark, tmpdir_fresh):
    _wav(f"{tmpdir_fresh}/near.wav", 10)
    _wav(f"{tmpdir_fresh}/late.wav", 5000)
    with open(f"{tmpdir_fresh}/no.wav", "wb") as f:
        f.write(b"nothing")
    got = {r.rel: (r.frames, r.rate) for r in media_infos_from_files(spark, tmpdir_fresh).collect()}
    assert got == {"near.wav": (1600, 16000), "late.wav": (1600, 16000)}


def test_string_ids(spark):
    rows = [("b/2.wav", [1.0, 0.0]), ("a/1.wav", [0.99, 0.05]), ("c/3.wav", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "utt_id string, vec array<double>")
    assert {r.utt_id: r.label for r in SP.dbscan_speakers(df, eps=0.1).collect()} == {"a/1.wav": 0, "b/2.wav": 0, "c/3.wav": -1}
    assert {r.utt_id: r.label for r in SP.ward_speakers(df, threshold=0.5).collect()} == {"a/1.wav": 0, "b/2.wav": 0, "c/3.wav": 1}
    assert SP.cosine_stats(df, "utt_id").first().n_pairs == 3


def test_unreadable_ledger_fails_and_new_checkpoint_keeps_output(spark, tmpdir_fresh):
    src, out, ledger = (f"{tmpdir_fresh}/{x}" for x in ("src", "out", "ledger"))
    df = spark.createDataFrame([("p1",), ("p2",)], "path string")
    df.write.parquet(src)
    ingest_stream(spark, src, df.schema, f"{tmpdir_fresh}/c1", out, ledger)
    spark.createDataFrame([("p3",)], "path string").write.mode("append").parquet(src)
    ingest_stream(spark, src, df.schema, f"{tmpdir_fresh}/c2", out, ledger)  # batch numbers start again
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["p1", "p2", "p3"]
    bad = f"{tmpdir_fresh}/bad"
    spark.createDataFrame([(1,)], "x int").write.parquet(bad)
    for name in os.listdir(bad):
        if name.endswith(".parquet"):
            with open(f"{bad}/{name}", "wb") as f:
                f.write(b"not parquet")
            os.remove(f"{bad}/.{name}.crc")
    with pytest.raises(Exception):
        ingest_stream(spark, src, df.schema, f"{tmpdir_fresh}/c3", f"{tmpdir_fresh}/out3", bad)


def test_label_rounds_write_files_by_their_rows(spark, monkeypatch):
    """A round of label propagation on some rows is one file and one task, not
    one for each shuffle partition; many rows still make several."""
    from voxtab.plans import graph

    parts, plain = [], graph.cut_lineage

    def cut(*args):
        out = plain(*args)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(graph, "cut_lineage", cut)
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60, 2)] + [(1, 2), (2, 59)], "src long, dst long")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    expected = {i: 0 if i in (0, 1, 2, 3, 58, 59) else i - i % 2 for i in range(60)}
    for rows, most in ((1 << 18, 1), (10, 8)):
        monkeypatch.setattr(graph, "PART_ROWS", rows, raising=False)
        parts.clear()
        found = {r.node: r.label for r in graph.connected_components(nodes, edges).collect()}
        assert found == expected
        assert len(parts) > 2 and max(parts) <= most and (rows > 10 or max(parts) > 1)
    empty = graph.connected_components(nodes.limit(0), edges.limit(0))
    assert empty.count() == 0
