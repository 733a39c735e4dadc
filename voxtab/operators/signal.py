"""Operators on sample tables.

Samples live in two layouts: long ``(key, idx, sample)`` rows (fixtures and
SQL checks) and ``blocks`` of bounded arrays ``(key, block_no, start,
samples)`` for real audio. Per-recording statistics are hash aggregations
joined back on the key (one row per recording), not windows over the
recording; local windows (spike repair) are computed only around candidate
samples by an equi-join on ``(key, idx)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.plans.recursive import recursive_filter


def to_blocks(samples: DataFrame, block: int, key="utt_id", idx: str = "idx", value: str = "sample") -> DataFrame:
    """Pack long samples into arrays of at most ``block`` samples
    (``block_no = idx div block``); absent samples inside a block are not
    filled."""
    keys = [key] if isinstance(key, str) else list(key)
    b = F.floor(F.col(idx) / block).cast("bigint")
    packed = samples.groupBy(*keys, b.alias("block_no")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(value).cast("double").alias("v")))).alias("_p")
    )
    return packed.select(
        *keys, "block_no", F.col("_p")[0]["i"].alias("start"), F.transform("_p", lambda x: x["v"]).alias("samples")
    )


def gather_blocks(blocks: DataFrame, segs: DataFrame, block: int, key="utt_id") -> DataFrame:
    """The samples of each segment ``[start, end)``, as array slices per
    (segment, block): each segment is exploded to the block numbers it
    spans (bounded by its own length) and equi-joined on ``(key,
    block_no)``; no range join."""
    keys = [key] if isinstance(key, str) else list(key)
    spans = segs.where(F.col("end") > F.col("start")).select(
        *keys, "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / block).cast("bigint"),
                             F.floor((F.col("end") - 1) / block).cast("bigint"))).alias("block_no"),
    )
    j = spans.join(blocks.withColumnRenamed("start", "_bstart"), [*keys, "block_no"])
    lo = F.greatest(F.col("start") - F.col("_bstart"), F.lit(0))
    hi = F.least(F.col("end") - F.col("_bstart"), F.size("samples"))
    return j.select(
        *keys, "start", "end", "block_no", (F.col("_bstart") + lo).alias("first_idx"),
        F.slice("samples", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("samples"),
    )


def gather(samples: DataFrame, segs: DataFrame, block: int = 16000, key="utt_id") -> DataFrame:
    """C18 in long form: ``(key, start, end, idx, sample)``."""
    keys = [key] if isinstance(key, str) else list(key)
    g = gather_blocks(to_blocks(samples, block, keys), segs, block, keys)
    return g.select(*keys, "start", "end", "first_idx", F.posexplode("samples").alias("_o", "sample")).select(
        *keys, "start", "end", (F.col("first_idx") + F.col("_o")).alias("idx"), "sample"
    )


def downmix(samples: DataFrame, key=("utt_id",), how: str = "mean") -> DataFrame:
    """Mono by the mean over channels (``how='mean'``) or channel 0
    (``how='first'``, the VAD path)."""
    keys = list(key) if not isinstance(key, str) else [key]
    if how == "first":
        return samples.where(F.col("channel") == 0).select(*keys, "idx", "sample")
    return samples.groupBy(*keys, "idx").agg(F.avg("sample").alias("sample"))


def standardise(samples: DataFrame, key=("utt_id",)) -> DataFrame:
    """D3: ``x_std = (x − mean(ref)) / std(x)`` with ``ref`` the mono mix
    (mean over channels) and ``std`` unbiased over all samples of the
    recording; ``restored = x_std · std(ref) + mean(ref)`` (so the round trip
    is not the identity)."""
    keys = list(key) if not isinstance(key, str) else [key]
    ref = samples.groupBy(*keys, "idx").agg(F.avg("sample").alias("_ref"))
    ref_stats = ref.groupBy(*keys).agg(F.avg("_ref").alias("ref_mean"), F.stddev_samp("_ref").alias("ref_std"))
    all_stats = samples.groupBy(*keys).agg(F.stddev_samp("sample").alias("all_std"))
    j = samples.join(ref_stats, keys).join(all_stats, keys)
    x_std = (F.col("sample") - F.col("ref_mean")) / F.col("all_std")
    return j.withColumn("standardised", x_std).withColumn("restored", x_std * F.col("ref_std") + F.col("ref_mean"))


def mix_tracks(stems: DataFrame, keep: list[str] | None = None, key=("utt_id",)) -> DataFrame:
    """Sum of the tracks named in ``keep`` (``None`` = all) per sample
    and channel; positions where no kept track has a sample stay, as 0."""
    keys = list(key) if not isinstance(key, str) else [key]
    pos = stems.select(*keys, "idx", "channel").distinct()
    kept = stems if keep is None else stems.where(F.col("track").isin(list(keep)))
    sums = kept.groupBy(*keys, "idx", "channel").agg(F.sum("sample").alias("sample"))
    return pos.join(sums, [*keys, "idx", "channel"], "left").withColumn("sample", F.coalesce("sample", F.lit(0.0)))


def repair_spikes(samples: DataFrame, rate: float, threshold_db: float = -3.0, window_ms: float = 3.0,
                  key=("utt_id",)) -> DataFrame:
    """A sample with ``|x| > 10^(db/20)`` and ``|x| > median + 2.5·std``
    of its window ``[i−w, i+w]`` (``w = int(rate·ms/1000)``, population std)
    is replaced by the window median; the first and last ``w`` samples are
    untouched; statistics read the original signal, per channel.

    Only samples above the amplitude threshold can be repaired, so window
    statistics are computed for those alone: each candidate is exploded to
    its ``2w+1`` neighbours and equi-joined on ``(key, idx)``."""
    keys = list(key) if not isinstance(key, str) else [key]
    thr = 10 ** (threshold_db / 20)
    w = int(rate * window_ms / 1000)
    out = samples.withColumn("repaired", F.col("sample"))
    if w < 1:
        return out.withColumn("was_spike", F.lit(False))
    n = samples.groupBy(*keys).agg((F.max("idx") + 1).alias("_n"))
    cand = (
        samples.where(F.abs("sample") > thr)
        .join(n, keys)
        .where((F.col("idx") >= w) & (F.col("idx") < F.col("_n") - w))
        .select(*keys, F.col("idx").alias("_c"), F.col("sample").alias("_x"))
    )
    nb = cand.select(*keys, "_c", "_x", F.explode(F.sequence(F.col("_c") - w, F.col("_c") + w)).alias("idx"))
    stats = nb.join(samples.select(*keys, "idx", "sample"), [*keys, "idx"]).groupBy(*keys, "_c", "_x").agg(
        F.percentile("sample", 0.5).alias("_med"), F.stddev_pop("sample").alias("_sd")
    )
    fix = stats.where(F.abs("_x") > F.col("_med") + 2.5 * F.col("_sd")).select(*keys, F.col("_c").alias("idx"), "_med")
    return (
        out.join(fix, [*keys, "idx"], "left")
        .withColumn("repaired", F.coalesce(F.col("_med"), F.col("sample")))
        .withColumn("was_spike", F.col("_med").isNotNull())
        .drop("_med")
    )


def peak_gain(samples: DataFrame, peak_db: float, key=("utt_id",), value: str = "sample") -> DataFrame:
    """Per-recording gain ``10^(db/20) / max|x|``; a silent recording gets
    a null gain and status ``failed``."""
    keys = list(key) if not isinstance(key, str) else [key]
    g = samples.groupBy(*keys).agg(F.max(F.abs(value)).alias("peak"))
    gain = F.when(F.col("peak") > 0, F.lit(10 ** (peak_db / 20.0)) / F.col("peak"))
    return g.withColumn("gain", gain).withColumn("status", F.when(F.col("peak") > 0, "ok").otherwise("failed"))


def peak_normalise(samples: DataFrame, peak_db: float, key=("utt_id",), value: str = "sample") -> DataFrame:
    """D6 applied: ``out = gain · x``."""
    keys = list(key) if not isinstance(key, str) else [key]
    g = peak_gain(samples, peak_db, keys, value).select(*keys, "gain")
    return samples.join(g, keys).withColumn("out", F.col(value) * F.col("gain"))


def integrated_loudness(blocks: DataFrame, key=("utt_id",), energy: str = "z", weight: str | None = None,
                        abs_gate: float = -70.0, rel_gate: float = -10.0) -> DataFrame:
    """D7 gating (BS.1770-4) over block mean squares ``z`` (K-weighted,
    summed over channels with weights): block loudness
    ``l = −0.691 + 10·log10(z)``; absolute gate ``l >= −70``; relative gate
    ``−0.691 + 10·log10(mean z of kept) − 10``; result
    ``−0.691 + 10·log10(mean z over blocks above both gates)``.
    Two chained aggregations; one row per recording."""
    keys = list(key) if not isinstance(key, str) else [key]
    z = F.col(energy) * (F.col(weight) if weight else F.lit(1.0))
    b = blocks.withColumn("_z", z).withColumn("_l", F.lit(-0.691) + F.lit(10.0) * F.log10(F.col("_z")))
    first = b.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.avg(F.when(F.col("_l") >= abs_gate, F.col("_z"))).alias("_zabs"),
    ).withColumn("_rel", F.lit(-0.691) + F.lit(10.0) * F.log10(F.col("_zabs")) + F.lit(rel_gate))
    second = b.join(first.select(*keys, "_rel"), keys).groupBy(*keys).agg(
        F.count(F.when((F.col("_l") > F.col("_rel")) & (F.col("_l") > abs_gate), 1)).alias("n_gated"),
        F.avg(F.when((F.col("_l") > F.col("_rel")) & (F.col("_l") > abs_gate), F.col("_z"))).alias("_zg"),
    )
    lufs = F.when(F.col("_zg") > 0, F.lit(-0.691) + F.lit(10.0) * F.log10(F.col("_zg"))).otherwise(F.lit(float("-inf")))
    return first.join(second, keys, "left").select(*keys, "n_blocks", F.coalesce("n_gated", F.lit(0)).cast("bigint").alias("n_gated"),
                                                    lufs.alias("lufs"))


def normalise_loudness(samples: DataFrame, energies: DataFrame, target: float, peak_db: float, measure: str = "before",
                       key=("utt_id",)) -> DataFrame:
    """Peak-normalise to ``peak_db`` then apply the loudness gain
    ``10^((target − measured)/20)``. ``measure='before'`` (the file
    pipeline) measures the input *before* peak scaling, so the output misses
    the target by the peak gain; ``'after'`` measures the peak-scaled signal.
    ``energies``: the block table ``(key, z)`` of the input."""
    keys = list(key) if not isinstance(key, str) else [key]
    gains = loudness_gains(peak_gain(samples, peak_db, keys), energies, target, measure, keys)
    return samples.join(gains, keys).withColumn("out", F.col("sample") * F.col("gain") * F.col("loud_gain"))


def loudness_gains(peaks: DataFrame, energies: DataFrame, target: float, measure: str, keys: list[str]) -> DataFrame:
    """``(key, gain, loud_gain)`` of every recording, from its peak gain
    and its gating energies."""
    pg = peaks.select(*keys, "gain")
    if measure == "before":
        meas = integrated_loudness(energies, keys)
    elif measure == "after":
        meas = integrated_loudness(energies.join(pg, keys).withColumn("z", F.col("z") * F.col("gain") * F.col("gain")), keys)
    else:
        raise ValueError(measure)
    lg = meas.select(*keys, F.pow(F.lit(10.0), (F.lit(float(target)) - F.col("lufs")) / 20.0).alias("loud_gain"))
    return pg.join(lg, keys)


def loudness_report(before: DataFrame, after: DataFrame, key=("utt_id",)) -> DataFrame:
    """Loudness before and after, side by side."""
    keys = list(key) if not isinstance(key, str) else [key]
    return before.select(*keys, F.col("lufs").alias("before_lufs")).join(
        after.select(*keys, F.col("lufs").alias("after_lufs")), keys, "full"
    )



# ----------------------------------------------------------------- blocks with halos
def with_halo(blocks: DataFrame, halo: int, key=("utt_id",)) -> DataFrame:
    """Attach the last ``halo`` samples of the previous block and the first
    ``halo`` of the next (equi-joins on ``block_no ± 1``). A block that has a
    successor must hold at least ``halo`` samples; a shorter one fails the job
    when its tail is read."""
    keys = list(key) if not isinstance(key, str) else [key]
    tail = F.when(
        F.size("samples") < halo, F.raise_error(F.concat(F.lit(f"a block is shorter than the halo of {halo} samples: "), F.size("samples")))
    ).otherwise(F.slice("samples", F.greatest(F.size("samples") - halo + 1, F.lit(1)), halo))
    last = blocks.groupBy(*keys).agg(F.max("block_no").alias("_last"))
    held = blocks.join(last, keys).where(F.col("block_no") < F.col("_last"))
    prev = held.select(*keys, (F.col("block_no") + 1).alias("block_no"), tail.alias("prev_tail"))
    nxt = blocks.select(*keys, (F.col("block_no") - 1).alias("block_no"), F.slice("samples", 1, halo).alias("next_head"))
    return blocks.join(prev, [*keys, "block_no"], "left").join(nxt, [*keys, "block_no"], "left")


def resample_taps(up: int, down: int, half_width: int = 10, beta: float = 5.0):
    """Windowed-sinc low-pass for rational conversion (gain ``up``), at the
    up-sampled rate: ``2·half_width·max(up, down) + 1`` taps, Kaiser window."""
    import numpy as np

    m = max(up, down)
    n = 2 * half_width * m + 1
    c = (n - 1) / 2
    fc = 0.5 / m
    t = np.arange(n) - c
    return (2 * fc * up * np.sinc(2 * fc * t) * np.kaiser(n, beta)).astype(np.float64)


def resample(blocks: DataFrame, rate_from: int, rate_to: int, key=("utt_id",), half_width: int = 10,
             beta: float = 5.0, totals: DataFrame | None = None) -> DataFrame:
    """D2 (re-aimed): rational FIR resampling on blocked samples. Output
    sample ``k`` is ``Σ x[n]·h[k·M − n·L + c]`` (``L/M = to/from`` reduced),
    computed in the block holding input ``floor(k·M/L)`` with halos from the
    neighbouring blocks; no recording is gathered anywhere. Output
    ``(key, block_no, start, samples)`` at the target rate; the recording has
    ``ceil(n·L/M)`` output samples (``totals``: ``(key, n)``, else taken as
    the end of the last block)."""
    import math

    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    keys = list(key) if not isinstance(key, str) else [key]
    g = math.gcd(rate_from, rate_to)
    up, down = rate_to // g, rate_from // g
    h = resample_taps(up, down, half_width, beta)
    c = (len(h) - 1) // 2
    halo = c // up + 2
    if totals is None:
        totals = blocks.groupBy(*keys).agg(F.max(F.col("start") + F.size("samples")).alias("n"))
    src = with_halo(blocks, halo, keys).join(totals.select(*keys, "n"), keys)
    schema = T.StructType(
        [blocks.schema[k] for k in keys]
        + [T.StructField("block_no", T.LongType()), T.StructField("start", T.LongType()),
           T.StructField("samples", T.ArrayType(T.DoubleType()))]
    )

    def fn(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                r = r._asdict()
                x = np.asarray(r["samples"], dtype=np.float64)
                s0, n_total = int(r["start"]), int(r["n"])
                pt = np.asarray(r["prev_tail"] if r["prev_tail"] is not None else [], dtype=np.float64)
                nh = np.asarray(r["next_head"] if r["next_head"] is not None else [], dtype=np.float64)
                ext = np.concatenate([pt, x, nh])
                ext_start = s0 - len(pt)
                k0 = -(-s0 * up // down)
                k1 = min(-(-(s0 + len(x)) * up // down), -(-n_total * up // down))
                ys = np.zeros(max(k1 - k0, 0))
                taps = np.arange((len(h) - 1) // up + 1)  # of one output's phase, newest input first
                for i in range(0, len(ys), 4096):
                    newest, phase = np.divmod(np.arange(k0 + i, min(k0 + i + 4096, k1)) * down + c, up)
                    n, t = newest[:, None] - taps, phase[:, None] + taps * up
                    idx = n - ext_start
                    ok = (t < len(h)) & (n >= 0) & (n < n_total) & (idx >= 0) & (idx < len(ext))
                    x_at, h_at = ext[np.where(ok, idx, 0)], h[np.where(ok, t, 0)]
                    ys[i : i + len(newest)] = (np.where(ok, x_at, 0.0) * h_at).sum(axis=1)
                out.append({**{k_: r[k_] for k_ in keys}, "block_no": r["block_no"], "start": k0, "samples": ys.tolist()})
            if out:
                yield pd.DataFrame(out)

    return src.mapInPandas(fn, schema)


def _biquad(b, a, x, zi=None):
    """Direct form II transposed biquad (a[0] normalised)."""
    import numpy as np

    b0, b1, b2 = (v / a[0] for v in b)
    a1, a2 = a[1] / a[0], a[2] / a[0]
    y = np.empty_like(x)
    z1, z2 = (0.0, 0.0) if zi is None else zi
    for i, xi in enumerate(x):
        yi = b0 * xi + z1
        z1 = b1 * xi - a1 * yi + z2
        z2 = b2 * xi - a2 * yi
        y[i] = yi
    return y


def k_weighting_coefficients(rate: float):
    """BS.1770 pre-filter as two RBJ biquads: high shelf (+4 dB, 1500 Hz,
    Q 1/√2) then high pass (38 Hz, Q 0.5)."""
    # Fixed values of the K-weighting pre-filter.
    G, Q1, FC1 = 4.0, 1.0 / math.sqrt(2.0), 1500.0
    Q2, FC2 = 0.5, 38.0
    A = 10 ** (G / 40.0)
    w0 = 2 * math.pi * FC1 / rate
    alpha = math.sin(w0) / (2 * Q1)
    cw = math.cos(w0)
    shelf_b = [A * ((A + 1) + (A - 1) * cw + 2 * math.sqrt(A) * alpha), -2 * A * ((A - 1) + (A + 1) * cw),
               A * ((A + 1) + (A - 1) * cw - 2 * math.sqrt(A) * alpha)]
    shelf_a = [(A + 1) - (A - 1) * cw + 2 * math.sqrt(A) * alpha, 2 * ((A - 1) - (A + 1) * cw),
               (A + 1) - (A - 1) * cw - 2 * math.sqrt(A) * alpha]
    w0 = 2 * math.pi * FC2 / rate
    alpha = math.sin(w0) / (2 * Q2)
    cw = math.cos(w0)
    hp_b = [(1 + cw) / 2, -(1 + cw), (1 + cw) / 2]
    hp_a = [1 + alpha, -2 * cw, 1 - alpha]
    return (shelf_b, shelf_a), (hp_b, hp_a)


def k_weight(blocks: DataFrame, rate: int, key=("utt_id",)) -> DataFrame:
    """D7 pre-filter on blocked samples, exact for blocks of any length: the
    filter's states at the block starts are a prefix scan over the blocks
    (``voxtab.plans.recursive``), so blocks are independent tasks."""
    keys = list(key) if not isinstance(key, str) else [key]
    return recursive_filter(blocks, k_weighting_coefficients(rate), keys)


def loudness(blocks: DataFrame, rate: int, key=("utt_id",), block_s: float = 0.4, overlap: float = 0.75) -> DataFrame:
    """D7 from samples: K-weighting, gating blocks, gated mean:
    ``(key, n_blocks, n_gated, lufs)``."""
    keys = list(key) if not isinstance(key, str) else [key]
    return integrated_loudness(gating_blocks(k_weight(blocks, rate, keys), rate, keys, block_s, overlap))


def power_by_bucket(blocks: DataFrame, step: int, key=("utt_id",)) -> DataFrame:
    """Sums of squares per ``step`` samples of each block: ``(key, bucket,
    ss, cnt)``, a bucket being ``idx div step``. One row per block and bucket;
    samples are never rows."""
    keys = list(key) if not isinstance(key, str) else [key]
    first, last = F.floor(F.col("start") / step), F.floor((F.col("start") + F.size("samples") - 1) / step)
    lo = F.greatest(F.col("bucket") * step - F.col("start"), F.lit(0))
    hi = F.least((F.col("bucket") + 1) * step - F.col("start"), F.size("samples"))
    cut = F.slice("samples", (lo + 1).cast("int"), (hi - lo).cast("int"))
    parts = blocks.where(F.size("samples") > 0).select(*keys, "start", "samples", F.explode(F.sequence(first, last)).alias("bucket"))
    power = F.aggregate(cut, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return parts.select(*keys, "bucket", power.alias("ss"), F.size(cut).alias("cnt"))


def gating_blocks(blocks: DataFrame, rate: int, key=("utt_id",), block_s: float = 0.4, overlap: float = 0.75) -> DataFrame:
    """BS.1770 gating blocks: mean square over ``block_s`` windows every
    ``block_s·(1 − overlap)`` seconds, from partial sums of squares per step
    (map-side combined) added into the windows that cover them."""
    keys = list(key) if not isinstance(key, str) else [key]
    step = int(round(block_s * (1 - overlap) * rate))
    per = int(round(1 / (1 - overlap)))
    sub = power_by_bucket(blocks, step, keys).groupBy(*keys, F.col("bucket").alias("sub")).agg(
        F.sum("ss").alias("ss"), F.sum("cnt").alias("cnt"))
    n = blocks.groupBy(*keys).agg(F.sum(F.size("samples")).alias("_n"))
    fed = sub.select(*keys, "ss", "cnt", F.explode(F.sequence(F.col("sub") - (per - 1), F.col("sub"))).alias("j"))
    win = fed.groupBy(*keys, "j").agg(F.sum("ss").alias("ss"), F.sum("cnt").alias("cnt")).join(n, keys)
    full = (F.col("j") >= 0) & ((F.col("j") + per) * step <= F.col("_n"))
    return win.where(full).select(*keys, F.col("j").alias("block_idx"), (F.col("ss") / (per * step)).alias("z"))
