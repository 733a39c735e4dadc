"""Edge cases named in the test strategy: empty and NaN embeddings,
threshold equality, degenerate histograms, empty recordings."""

import math

import pandas as pd

from voxtab.operators import quality as Q
from voxtab.operators import segments as C
from voxtab.operators import speakers as SP
from voxtab.operators import stats as E


def test_valid_embeddings_flags_empty_and_nan(spark):
    emb = spark.createDataFrame(
        [(1, 0, [0.1, 0.2]), (1, 1, [0.3, 0.4]), (2, 0, [float("nan"), 0.1])], "utt_id long, chunk_idx long, vec array<double>"
    )
    utts = spark.createDataFrame([(1,), (2,), (3,)], "utt_id long")
    got = SP.valid_embeddings(SP.mean_pool(emb), utts).toPandas().set_index("utt_id")
    assert got.loc[1, "status"] == "success" and pd.isna(got.loc[1, "reason"])
    assert got.loc[2, "reason"] == "embedding is NaN" and got.loc[3, "reason"] == "empty embedding"
    pooled = SP.mean_pool(emb).toPandas().set_index("utt_id")
    assert [round(v, 12) for v in pooled.loc[1, "vec"]] == [0.2, 0.3]


def test_quality_threshold_is_inclusive_and_report_strict(spark):
    scores = spark.createDataFrame(
        [("a", 10.0, 3.5), ("b", 20.0, 3.49), ("c", 30.0, 4.0)], "audio_filepath string, duration double, OVRL double"
    )
    v = Q.split_by_quality(scores, 3.5).toPandas().set_index("audio_filepath")["verdict"]
    assert v.to_dict() == {"a": "pass", "b": "fail", "c": "pass"}
    r = Q.quality_report(scores).first()
    # median 3.5: only c is strictly above
    assert r["median_ovrl"] == 3.5 and r["above_median_seconds"] == 30.0
    assert math.isclose(r["above_median_pct"], 50.0)
    none = Q.quality_totals(Q.split_by_quality(scores, None)).count()
    assert none == 0


def test_longer_is_strict_and_histogram_degenerate(spark):
    infos = spark.createDataFrame([("a", 5.0, 16000), ("b", 5.0, 16000)], "path string, seconds double, rate int")
    assert E.longer_than(infos, 5.0).count() == 0 and E.shorter_than(infos, 5.0).count() == 0
    h = E.duration_histogram(infos, 10).toPandas().sort_values("bin")
    assert h["n"].sum() == 2 and h.loc[h.n == 2, "bin"].tolist() == [5]
    assert math.isclose(h["bin_lo"].iloc[0], 4.5) and math.isclose(h["bin_hi"].iloc[-1], 5.5)


def test_loop_pad_and_hops(spark):
    infos = spark.createDataFrame([("empty", 0), ("short", 1000), ("long", 200000)], "path string, n long")
    got = C.loop_pad(infos).toPandas().set_index("path")
    assert got.loc["empty", "status"] == "failed"
    assert got.loc["short", "padded"] == 1000 * 2 ** 8 and got.loc["long", "doublings"] == 0
    hops = C.sliding_hops(C.loop_pad(infos)).toPandas()
    assert set(hops.path) == {"short", "long"}
    assert ((hops["end"] - hops["start"]) >= 144160).all()


def test_hz_to_note_drops_invalid(spark):
    pitch = spark.createDataFrame([(1, 440.0), (1, 0.0), (1, float("nan")), (1, float("inf")), (1, 261.63)], "utt_id long, f0 double")
    got = E.hz_to_note(pitch).toPandas()
    assert sorted(got["note"]) == ["A4", "C4"]


def test_ledger_shape_and_invariant(spark):
    from voxtab.operators import ledger as B

    led = spark.createDataFrame(
        [("convert_to_wav", "/d/a.mp4", "success", None), ("convert_to_wav", "/d/b.mp3", "skipped", "output exists"),
         ("convert_to_wav", "/d/c.wav", "skipped", "output exists")],
        "stage string, file string, status string, reason string",
    )
    s = B.stage_summary(led).first()
    assert (s["total"], s["success"], s["skipped"], s["failed"]) == (3, 1, 2, 0)
    shards = [led.where(led.file == f) for f in ("/d/a.mp4", "/d/b.mp3", "/d/c.wav")]
    m = B.stage_summary(B.merge_ledgers(*shards, stage="separate")).first()
    assert m["stage"] == "separate" and m["total"] == m["success"] + m["skipped"] + m["failed"] == 3
    assert B.stage_details(led).count() == 2


def test_single_speaker_keeps_count_zero(spark):
    verdicts = spark.createDataFrame([("u0", False, 0), ("u1", False, 1), ("u2", True, 2)],
                                     "utt_id string, multi_speaker boolean, spk_count int")
    segs = spark.createDataFrame([("u0",), ("u1",), ("u2",), ("u3",)], "utt_id string")
    assert sorted(r.utt_id for r in SP.single_speaker(segs, verdicts).collect()) == ["u0", "u1"]
    assert [r.utt_id for r in SP.single_speaker(segs, verdicts, min_count=1).collect()] == ["u1"]


def test_contiguous_shards_follow_divmod(spark):
    from voxtab.operators import files as A

    for n_rows, n in ((10, 3), (2, 5), (7, 7)):
        df = spark.createDataFrame([(f"d/f{i:02d}.wav",) for i in range(n_rows)], "path string")
        got = A.shard_contiguous(df, n).toPandas().sort_values("pos")["shard"].tolist()
        k, m = divmod(n_rows, n)
        exp = []
        for s in range(n):
            exp += [s] * (k + (1 if s < m else 0))
        assert got == exp, (n_rows, n)


def test_pad_intervals_head_and_clamp(spark):
    segs = spark.createDataFrame([(1, 1000, 2000, 10000), (1, 5000, 9900, 10000)], "k long, start long, end long, total long")
    got = C.pad_intervals(segs, "k", 1000.0).toPandas().sort_values("start")
    # first interval: 2.5 s head pad clamps at 0; later: 0.3 s; ends +0.3 s, clamped to the total
    assert got[["pad_start", "pad_end"]].to_numpy().tolist() == [[0, 2300], [4700, 10000]]
