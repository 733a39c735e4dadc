"""Blocked signal operators equal their long form."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxtab.operators import blocks as B
from voxtab.operators import signal as D
from voxtab.operators import silence as S

N, BLOCK = 2300, 256


@pytest.fixture(scope="module")
def long(spark):
    rng = np.random.default_rng(0)
    rows = []
    for utt in range(3):
        for channel in range(2):
            x = rng.normal(size=N - 500 * utt) * 0.2
            x[rng.integers(0, len(x), 25)] = 0.95
            rows.append(pd.DataFrame({"utt_id": utt, "channel": channel, "idx": np.arange(len(x)), "sample": x}))
    return spark.createDataFrame(pd.concat(rows)).cache()


@pytest.fixture(scope="module")
def blocked(long):
    return D.to_blocks(long, BLOCK, ["utt_id", "channel"]).cache()


def flat(df, column="samples", keys=("utt_id",)):
    rows = df.select(*keys, "start", F.posexplode(column).alias("o", "v")).toPandas()
    rows["idx"] = rows["start"] + rows["o"]
    return rows.sort_values([*keys, "idx"])[[*keys, "idx", "v"]].to_numpy(float)


def rows_of(df, column, keys=("utt_id",)):
    return df.select(*keys, "idx", column).toPandas().sort_values([*keys, "idx"]).to_numpy(float)


def test_downmix(long, blocked):
    assert np.allclose(flat(B.downmix(blocked)), rows_of(D.downmix(long), "sample"))
    assert np.allclose(flat(B.downmix(blocked, how="first")), rows_of(D.downmix(long, how="first"), "sample"))


def test_standardise(long, blocked):
    a, b = B.standardise(blocked), D.standardise(long)
    for c in ("standardised", "restored"):
        assert np.allclose(flat(a, c, ("utt_id", "channel")), rows_of(b, c, ("utt_id", "channel")), atol=1e-9)


def test_mix(long, blocked):
    stems = long.withColumnRenamed("channel", "track").withColumn("channel", F.lit(0)).withColumn("track", F.concat(F.lit("t"), "track"))
    packed = blocked.withColumn("track", F.concat(F.lit("t"), "channel")).withColumn("channel", F.lit(0))
    for keep in (["t1"], None, []):
        assert np.allclose(flat(B.mix_tracks(packed, keep)), rows_of(D.mix_tracks(stems, keep), "sample"))


def test_peak_and_gain(long, blocked):
    gains = B.peak_gain(blocked, -6.0)
    keys = ("utt_id", "channel")
    exp = rows_of(D.peak_normalise(long, -6.0), "out", keys)
    assert np.allclose(flat(B.apply_gain(blocked, gains), "samples", keys), exp)


def test_frames(long, blocked):
    mono, packed = long.where("channel = 0"), blocked.where("channel = 0")
    got = B.frame_rms(packed, 64, 16).toPandas().sort_values(["utt_id", "frame_idx"]).to_numpy(float)
    exp = S.frame_rms(mono, 64, 16).toPandas().sort_values(["utt_id", "frame_idx"]).to_numpy(float)
    assert np.allclose(got, exp)


def test_spikes(long, blocked):
    keys = ("utt_id", "channel")
    got = B.repair_spikes(blocked, 4000, -3.0, 3.0, list(keys))
    exp = D.repair_spikes(long, 4000, -3.0, 3.0, list(keys))
    assert np.allclose(flat(got, "repaired", keys), rows_of(exp, "repaired", keys))
    assert got.agg(F.sum("n_spikes")).first()[0] == exp.where("was_spike").count() > 0


def test_short_block_fails(spark):
    df = spark.createDataFrame([(0, 0, 0, [0.1] * 5), (0, 1, 5, [0.1] * 5)], "utt_id long, block_no long, start long, samples array<double>")
    with pytest.raises(Exception, match="shorter than the halo"):
        D.with_halo(df, 10).collect()
