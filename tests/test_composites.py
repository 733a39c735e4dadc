"""The whole first slicer against a loop over samples, model keys of any
value, speaker folders of repeated assignments, and the entry without its
optional libraries."""

import math
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxtab.operators import segments as C
from voxtab.operators import speakers as SP
from voxtab.operators.infer import batch_infer
from voxtab.sources import sinks


def _even(x, most):
    if len(x) <= most:
        return [x]
    n = math.ceil(len(x) / most)
    step = math.ceil(len(x) / n)
    return [x[i : i + step] for i in range(0, len(x), step)]


def _sliced(audio, intervals, least, pad, most):
    if len(audio) < least:
        return _even(audio, most)
    out, line, held = [], [], 0
    for s, e in intervals:
        held += e - s
        line.append(audio[s:e])
        if held >= least:
            out += _even(np.concatenate(line), most)
            line, held = [], 0
        else:
            line.append(np.zeros(pad))
    return out + (_even(np.concatenate(line), most) if held else [])


def test_first_slicer_equals_a_loop_over_samples(spark):
    rng = np.random.default_rng(3)
    audio, ivs, rows = {}, {}, []
    for utt in range(12):
        n = int(rng.integers(5, 90)) if utt % 3 == 0 else int(rng.integers(200, 900))
        audio[utt] = rng.normal(size=n) + 10
        cuts = np.unique(rng.integers(0, n, int(rng.integers(2, 24))))
        ivs[utt] = [(int(s), int(e)) for s, e in zip(cuts[::2], cuts[1::2])]
        rows += [(utt, s, e) for s, e in ivs[utt]]
    intervals = spark.createDataFrame(rows, "utt_id long, start long, end long").repartition(3)
    totals = spark.createDataFrame([(u, len(x)) for u, x in audio.items()] + [(99, 0)], "utt_id long, n long")
    least, pad, most = 100, 7, 60
    got: dict = {}
    for r in C.slice_accumulated(intervals, totals, least, pad, most).collect():
        got.setdefault(r.utt_id, {}).setdefault(r.seg_idx, []).append(r)
    assert 99 not in got
    for utt, x in audio.items():
        want = _sliced(x, ivs[utt], least, pad, most)
        assert sorted(got.get(utt, {})) == list(range(len(want)))
        for i, segment in enumerate(want):
            pieces = sorted(got[utt][i], key=lambda r: r["at"])
            line = [np.zeros(r.length) if r.src_start is None else x[r.src_start : r.src_start + r.length] for r in pieces]
            assert [r["at"] for r in pieces] == np.cumsum([0, *map(len, line)])[:-1].tolist()
            np.testing.assert_array_equal(np.concatenate(line), segment)


def test_model_keys_and_outputs_keep_their_values(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(big, "a", 1.5), (None, "b", None), (7, None, float("nan"))], "id long, name string, x double").coalesce(1)

    def predict(_, pdf):
        if pdf["name"].isna().any():
            raise ValueError("no name")
        return pd.DataFrame({"twin": pdf["id"], "n": pdf["name"].str.len()})

    rows = {r["name"]: r for r in batch_infer(df, lambda: None, predict, "twin long, n int", ["id", "name", "x"]).collect()}
    assert rows["a"].id == rows["a"].twin == big and rows["a"].n == 1 and rows["a"].status == "success"
    assert rows["b"].id is None and rows["b"].twin is None and rows["b"].x is None
    assert rows[None].id == 7 and rows[None].x != rows[None].x and rows[None].reason == "ValueError: no name" and rows[None].n is None


def test_speaker_folders(spark, tmpdir_fresh):
    clips = spark.createDataFrame([(f"u{i}", i) for i in range(60)] + [("lost", 1)], "utt_id string, n int")
    assigned = spark.createDataFrame([(f"u{i}", "spk0" if i < 40 else "spk1") for i in range(60)] * 2, "utt_id string, spk string")
    sinks.write_by_speaker(clips, assigned, f"{tmpdir_fresh}/spk", files=3)
    back = spark.read.parquet(f"{tmpdir_fresh}/spk")
    assert back.count() == 60 and back.where("spk = 'spk0'").count() == 40
    assert 1 <= back.where("spk = 'spk0'").select(F.input_file_name()).distinct().count() <= 3
    twice = assigned.unionByName(spark.createDataFrame([("u1", "spk1")], "utt_id string, spk string"))
    with pytest.raises(Exception, match="two speakers for u1"):
        sinks.assigned_clips(clips, twice).collect()


def test_speaker_counts_of_small_and_large_utterances_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(u, i, rng.normal(size=5).tolist()) for u in range(8) for i in range(3 + 9 * (u % 3))]
    df = spark.createDataFrame(rows, "utt_id long, chunk_idx long, vec array<double>")
    one = sorted(tuple(r) for r in SP.speaker_count(df, eps=0.3).collect())
    assert one == sorted(tuple(r) for r in SP.speaker_count(df, eps=0.3, block=4).collect())


def test_entry_without_an_optional_library():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=sys.path[0] or ".",
                         env={**__import__("os").environ, "PYTHONPATH": __import__("os").path.dirname(__import__("os").path.dirname(__file__))})
    n, training = out.stdout.split()
    assert int(n) >= 85 and training == "False"
