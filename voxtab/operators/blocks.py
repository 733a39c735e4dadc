"""Sample operators on blocked audio ``(key, [channel,] block_no, start,
samples)``: arrays of bounded length, so a sample is never a row. A block has
the same ``start`` in every channel and track of its recording.

Element-wise work on one block runs in the row (D3, D6, D8) or in one Arrow
pass per group of blocks that share a place (D1, D4). Statistics are partial
sums per block. Windows that cross a block border read halos of the
neighbours (D5); framing (C3) adds partial sums of squares per hop.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.operators.signal import loudness_gains, power_by_bucket, with_halo

_ARRAY = T.ArrayType(T.DoubleType())


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _combined(blocks: DataFrame, by: list[str], mean: bool) -> DataFrame:
    """Sum or mean of the blocks that share ``by`` and their place; shorter
    ones count as far as they reach."""
    schema = T.StructType([*[blocks.schema[c] for c in [*by, "block_no", "start"]], T.StructField("samples", _ARRAY)])

    def fn(group: pa.Table) -> pa.Table:
        arrays = [np.asarray(x, float) for x in group["samples"].to_pylist()]
        total, n = np.zeros(max(map(len, arrays))), np.zeros(max(map(len, arrays)))
        for x in arrays:
            total[: len(x)] += x
            n[: len(x)] += 1
        out = total / n if mean else total
        return group.select([*by, "block_no", "start"]).slice(0, 1).append_column("samples", pa.array([out], pa.list_(pa.float64())))

    return blocks.select(*by, "block_no", "start", "samples").groupBy(*by, "block_no", "start").applyInArrow(fn, schema)


def downmix(blocks: DataFrame, key="utt_id", how: str = "mean") -> DataFrame:
    """Mono blocks by the mean over channels, or channel 0."""
    keys = _keys(key)
    if how == "first":
        return blocks.where(F.col("channel") == 0).select(*keys, "block_no", "start", "samples")
    return _combined(blocks, keys, mean=True)


def mix_tracks(blocks: DataFrame, keep: list[str] | None = None, key="utt_id") -> DataFrame:
    """Sum of the tracks in ``keep`` per channel; places where no kept
    track has a sample stay, as 0."""
    keys = _keys(key)
    silent = F.transform("samples", lambda x: F.lit(0.0))
    kept = F.lit(True) if keep is None else F.col("track").isin(list(keep))
    return _combined(blocks.withColumn("samples", F.when(kept, F.col("samples").cast(_ARRAY)).otherwise(silent)), [*keys, "channel"], mean=False)


def _moments(blocks: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``(key, <name>_mean, <name>_std)``: count, mean and squared deviations
    of each block, merged by the parallel-variance rule."""
    x, n = F.col("samples").cast(_ARRAY), F.size("samples").cast("double")
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    per = blocks.where(F.size("samples") > 0).select(*keys, x.alias("samples"), n.alias("n"), (total / n).alias("m"))
    dev = F.aggregate("samples", F.lit(0.0), lambda a, v: a + (v - F.col("m")) * (v - F.col("m")))
    per = per.select(*keys, "n", "m", dev.alias("d"))
    whole = per.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias(f"{name}_mean"))
    between = F.col("n") * F.pow(F.col("m") - F.col(f"{name}_mean"), 2)
    spread = per.join(whole, keys).groupBy(*keys, f"{name}_mean", "_n").agg(F.sum(F.col("d") + between).alias("_d"))
    std = F.when(F.col("_n") > 1, F.sqrt(F.col("_d") / (F.col("_n") - 1)))
    return spread.select(*keys, f"{name}_mean", std.alias(f"{name}_std"))


def standardise(blocks: DataFrame, key="utt_id") -> DataFrame:
    """D3: adds ``standardised`` and ``restored`` arrays (definitions as in
    the long form)."""
    keys = _keys(key)
    ref = _moments(downmix(blocks, keys), keys, "ref")
    every = _moments(blocks, keys, "all").select(*keys, "all_std")
    j = blocks.join(ref, keys).join(every, keys)
    unit = F.transform(F.col("samples").cast(_ARRAY), lambda v: (v - F.col("ref_mean")) / F.col("all_std"))
    back = F.transform(unit, lambda v: v * F.col("ref_std") + F.col("ref_mean"))
    return j.withColumn("standardised", unit).withColumn("restored", back)


def peak_gain(blocks: DataFrame, peak_db: float, key="utt_id") -> DataFrame:
    """``(key, peak, gain)``; a silent recording has a null gain."""
    keys = _keys(key)
    top = F.array_max(F.transform("samples", lambda v: F.abs(v.cast("double"))))
    g = blocks.groupBy(*keys).agg(F.max(top).alias("peak"))
    return g.withColumn("gain", F.when(F.col("peak") > 0, F.lit(10 ** (peak_db / 20.0)) / F.col("peak")))


def apply_gain(blocks: DataFrame, gains: DataFrame, key="utt_id", gain: str = "gain") -> DataFrame:
    """Every sample times its recording's gain."""
    keys = _keys(key)
    scaled = F.transform("samples", lambda v: v.cast("double") * F.col("_gain"))
    return blocks.join(gains.select(*keys, F.col(gain).alias("_gain")), keys).withColumn("samples", scaled).drop("_gain")


def normalise_loudness(blocks: DataFrame, energies: DataFrame, target: float, peak_db: float, measure: str = "before", key="utt_id") -> DataFrame:
    """D8 on blocks (definitions as in the long form)."""
    keys = _keys(key)
    gains = loudness_gains(peak_gain(blocks, peak_db, keys), energies, target, measure, keys)
    return apply_gain(blocks, gains.select(*keys, (F.col("gain") * F.col("loud_gain")).alias("gain")), keys)


def frame_rms(blocks: DataFrame, win: int, hop: int, key="utt_id") -> DataFrame:
    """C3 for windows of whole hops: partial sums of squares per hop, each
    added into the frames that cover it."""
    if (win // 2) % hop or win % hop:
        raise ValueError("the blocked form needs a window and half window of whole hops")
    keys, half = _keys(key), win // 2
    n = blocks.groupBy(*keys).agg(F.max(F.col("start") + F.size("samples")).alias("_n"))
    sums = power_by_bucket(blocks, hop, keys).groupBy(*keys, "bucket").agg(F.sum("ss").alias("ss"))
    feeds = F.explode(F.sequence(F.col("bucket") - (win - half) // hop + 1, F.col("bucket") + half // hop))
    rms = sums.select(*keys, "ss", feeds.alias("frame_idx")).groupBy(*keys, "frame_idx").agg(F.sqrt(F.sum("ss") / win).alias("rms"))
    inside = (F.col("frame_idx") >= 0) & (F.col("frame_idx") <= F.floor(F.col("_n") / hop))
    return rms.join(n, keys).where(inside).select(*keys, "frame_idx", "rms")


def repair_spikes(blocks: DataFrame, rate: float, threshold_db: float = -3.0, window_ms: float = 3.0, key="utt_id") -> DataFrame:
    """Adds ``repaired`` and ``n_spikes`` (definitions as in the long
    form); windows at a block's border read the neighbours' halos."""
    keys, w, limit = _keys(key), int(rate * window_ms / 1000), 10 ** (threshold_db / 20)
    if w < 1:
        return blocks.withColumn("repaired", F.col("samples").cast(_ARRAY)).withColumn("n_spikes", F.lit(0).cast("long"))
    names = blocks.columns
    schema = T.StructType([*blocks.schema.fields, T.StructField("repaired", _ARRAY), T.StructField("n_spikes", T.LongType())])

    def fn(batches):
        for b in batches:
            repaired, counts = [], []
            for x, before, after in zip(b["samples"].to_pylist(), b["prev_tail"].to_pylist(), b["next_head"].to_pylist()):
                own, left = np.asarray(x, float), len(before or [])
                line = np.concatenate([np.asarray(before or [], float), own, np.asarray(after or [], float)])
                out = own.copy()
                at = np.flatnonzero(np.abs(own) > limit) + left
                at = at[(at >= w) & (at < len(line) - w)]
                fixed = 0
                for some in np.array_split(at, max(1, len(at) // 4096 + 1)):
                    if len(some):
                        near = line[some[:, None] + np.arange(-w, w + 1)]
                        mid = np.median(near, axis=1)
                        bad = np.abs(line[some]) > mid + 2.5 * near.std(axis=1)
                        out[some[bad] - left] = mid[bad]
                        fixed += int(bad.sum())
                repaired.append(out)
                counts.append(fixed)
            cols = [b[c] for c in names] + [pa.array(repaired, pa.list_(pa.float64())), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "repaired", "n_spikes"])

    return with_halo(blocks, w, keys).select(*names, "prev_tail", "next_head").mapInArrow(fn, schema)
