"""Signal operators on blocked samples."""

import numpy as np
import pandas as pd

from voxtab.operators import signal as D


def _blocks(spark, x, block, utt=0):
    pdf = pd.DataFrame({"utt_id": utt, "idx": np.arange(len(x)), "sample": x})
    return D.to_blocks(spark.createDataFrame(pdf), block)


def _flatten(df):
    pdf = df.toPandas().sort_values("start")
    return np.concatenate([np.asarray(s) for s in pdf["samples"]])


def test_resample_keeps_frequency(spark):
    rate_from, rate_to, f = 48000, 16000, 440.0
    t = np.arange(48000) / rate_from
    x = np.sin(2 * np.pi * f * t)
    y = _flatten(D.resample(_blocks(spark, x, 4800), rate_from, rate_to))
    assert len(y) == 16000
    spec = np.abs(np.fft.rfft(y * np.hanning(len(y))))
    assert abs(np.argmax(spec) * rate_to / len(y) - f) < 2.0
    # pass band keeps the amplitude (away from the edges)
    assert abs(np.max(np.abs(y[2000:-2000])) - 1.0) < 0.01


def test_resample_up(spark):
    x = np.sin(2 * np.pi * 1000 * np.arange(16000) / 16000)
    y = _flatten(D.resample(_blocks(spark, x, 3000), 16000, 44100))
    assert len(y) == 44100
    spec = np.abs(np.fft.rfft(y * np.hanning(len(y))))
    assert abs(np.argmax(spec) * 44100 / len(y) - 1000) < 2.0


def test_k_weighted_loudness_of_reference_sine(spark):
    rate = 48000
    x = np.sin(2 * np.pi * 997 * np.arange(rate * 3) / rate)
    kw = D.k_weight(_blocks(spark, x, rate), rate)
    z = D.gating_blocks(kw, rate)
    lufs = D.integrated_loudness(z).first()["lufs"]
    assert abs(lufs - (-3.01)) < 0.05


def test_blocked_filter_equals_whole_signal(spark):
    rate = 16000
    rng = np.random.default_rng(0)
    x = rng.normal(size=rate * 3) * 0.1
    kw = _flatten(D.k_weight(_blocks(spark, x, rate), rate))
    (sb, sa), (hb, ha) = D.k_weighting_coefficients(rate)
    whole = D._biquad(hb, ha, D._biquad(sb, sa, x))
    np.testing.assert_allclose(kw, whole, atol=1e-9)


def test_recursive_filter_over_short_and_uneven_blocks(spark, monkeypatch):
    """Blocks of any length, many chunks and levels, several recordings, one
    of them a null key: as if each were filtered whole."""
    from voxtab.plans import recursive

    monkeypatch.setattr(recursive, "FAN", 4)
    rng = np.random.default_rng(1)
    signals = {"a": rng.normal(size=700), "b": rng.normal(size=3), None: np.r_[1.0, np.zeros(400)]}
    rows = []
    for key, x in signals.items():
        cuts = np.unique(np.r_[0, rng.integers(0, len(x), 150), len(x)])
        rows += [(key, i, int(s), x[s:e].tolist()) for i, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    df = spark.createDataFrame(rows, "utt_id string, block_no long, start long, samples array<double>").repartition(5)
    out = D.k_weight(df, 48000).toPandas()
    (sb, sa), (hb, ha) = D.k_weighting_coefficients(48000)
    for key, x in signals.items():
        got = out[out["utt_id"].isna()] if key is None else out[out["utt_id"] == key]
        got = np.concatenate(got.sort_values("block_no")["samples"].tolist())
        np.testing.assert_allclose(got, D._biquad(hb, ha, D._biquad(sb, sa, x)), atol=1e-10)
    assert D.k_weight(df.limit(0), 48000).count() == 0


def test_peak_and_spikes_edges(spark):
    df = spark.createDataFrame(pd.DataFrame({"utt_id": [0] * 5 + [1] * 5, "idx": list(range(5)) * 2,
                                             "sample": [0.0] * 5 + [0.1, -0.5, 0.2, 0.0, 0.3]}))
    g = D.peak_gain(df, -3.0).toPandas().set_index("utt_id")
    assert g.loc[0, "status"] == "failed" and pd.isna(g.loc[0, "gain"])
    assert abs(g.loc[1, "gain"] * 0.5 - 10 ** (-3 / 20)) < 1e-12
    x = np.zeros(50)
    x[25] = 0.95
    rep = D.repair_spikes(spark.createDataFrame(pd.DataFrame({"utt_id": 0, "idx": np.arange(50), "sample": x})), 1000.0)
    rep = rep.toPandas().set_index("idx")
    assert rep.loc[25, "repaired"] == 0.0 and bool(rep.loc[25, "was_spike"])
    assert (rep.drop(index=25)["repaired"] == 0.0).all()
