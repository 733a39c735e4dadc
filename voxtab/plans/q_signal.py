"""Checked queries D1, D3-D9 (sample-table signal operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import blocks as B
from voxtab.operators import signal as D
from voxtab.plans.registry import ORACLES, register, rounded, sqlq
from voxtab.sources.views import v_frames, v_samples, v_stems, with_views

PEAK_DB, TARGET_LUFS = -3.1, -16.0
SPIKE_DB, SPIKE_RATE = -3.0, 1000.0  # w = int(1000 · 3 ms) = 3 samples


def _c(x: float) -> str:
    """A Python-computed double as an SQL literal (same bits in both engines)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


@register(
    "d1_downmix",
    with_views("v_stems") + f"SELECT utt_id, track, idx, {sqlq('avg(sample)')} AS sample FROM v_stems GROUP BY utt_id, track, idx",
)
def d1_downmix(spark, sf_dir):
    return rounded(D.downmix(v_stems(spark, sf_dir), ("utt_id", "track")))


@register(
    "d1_downmix_first",
    with_views("v_stems") + f"SELECT utt_id, track, idx, {sqlq('sample')} AS sample FROM v_stems WHERE channel = 0",
)
def d1_downmix_first(spark, sf_dir):
    return rounded(D.downmix(v_stems(spark, sf_dir), ("utt_id", "track"), how="first"))


@register(
    "d3_standardise",
    with_views("v_stems")
    + f""", ref AS (SELECT utt_id, track, idx, avg(sample) AS r FROM v_stems GROUP BY ALL),
rs AS (SELECT utt_id, track, avg(r) AS ref_mean, stddev_samp(r) AS ref_std FROM ref GROUP BY ALL),
al AS (SELECT utt_id, track, stddev_samp(sample) AS all_std FROM v_stems GROUP BY ALL)
SELECT s.utt_id, s.track, s.idx, s.channel,
       {sqlq('(s.sample - ref_mean) / all_std')} AS standardised,
       {sqlq('(s.sample - ref_mean) / all_std * ref_std + ref_mean')} AS restored
FROM v_stems s JOIN rs USING (utt_id, track) JOIN al USING (utt_id, track)""",
)
def d3_standardise(spark, sf_dir):
    out = D.standardise(v_stems(spark, sf_dir), ("utt_id", "track"))
    return rounded(out.select("utt_id", "track", "idx", "channel", "standardised", "restored"))


@register(
    "d4_mix_tracks",
    with_views("v_stems")
    + f""", pos AS (SELECT DISTINCT utt_id, idx, channel FROM v_stems),
s AS (SELECT utt_id, idx, channel, sum(sample) AS sample FROM v_stems WHERE track IN ('view', 'click') GROUP BY ALL)
SELECT pos.utt_id, pos.idx, pos.channel, {sqlq('coalesce(s.sample, 0.0)')} AS sample
FROM pos LEFT JOIN s USING (utt_id, idx, channel)""",
)
def d4_mix_tracks(spark, sf_dir):
    return rounded(D.mix_tracks(v_stems(spark, sf_dir), ["view", "click"]).select("utt_id", "idx", "channel", "sample"))


_THR = 10 ** (SPIKE_DB / 20)


@register(
    "d5_repair_spikes",
    with_views("v_samples")
    + f""", n AS (SELECT utt_id, max(idx) + 1 AS n FROM v_samples GROUP BY utt_id),
w AS (SELECT s.utt_id, s.idx, s.sample, n.n,
             quantile_cont(sample, 0.5) OVER (PARTITION BY s.utt_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS med,
             stddev_pop(sample) OVER (PARTITION BY s.utt_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS sd
      FROM v_samples s JOIN n USING (utt_id)),
c AS (SELECT *, idx >= 3 AND idx < n - 3 AND abs(sample) > {_c(_THR)} AND abs(sample) > med + 2.5 * sd AS spike FROM w)
SELECT utt_id, idx, {sqlq('CASE WHEN spike THEN med ELSE sample END')} AS repaired, spike AS was_spike FROM c""",
)
def d5_repair_spikes(spark, sf_dir):
    out = D.repair_spikes(v_samples(spark, sf_dir), SPIKE_RATE, SPIKE_DB)
    return rounded(out.select("utt_id", "idx", "repaired", "was_spike"))


_PG_SQL = f""", pk AS (SELECT utt_id, max(abs(sample)) AS peak FROM v_samples GROUP BY utt_id),
pg AS (SELECT utt_id, CASE WHEN peak > 0 THEN {_c(10 ** (PEAK_DB / 20.0))} / peak END AS gain FROM pk)
"""


@register(
    "d6_peak_normalise",
    with_views("v_samples") + _PG_SQL + f"SELECT utt_id, idx, {sqlq('sample * gain')} AS out FROM v_samples JOIN pg USING (utt_id)",
)
def d6_peak_normalise(spark, sf_dir):
    return rounded(D.peak_normalise(v_samples(spark, sf_dir), PEAK_DB).select("utt_id", "idx", "out"))


def _gating_sql(src: str, name: str) -> str:
    return f""", {name}_b AS (SELECT utt_id, z, -0.691 + 10.0 * log10(z) AS l FROM {src}),
{name}_f AS (SELECT utt_id, count(*) AS n_blocks, avg(z) FILTER (WHERE l >= -70.0) AS zabs FROM {name}_b GROUP BY utt_id),
{name}_r AS (SELECT *, -0.691 + 10.0 * log10(zabs) + -10.0 AS rel FROM {name}_f),
{name}_s AS (SELECT b.utt_id, count(*) FILTER (WHERE l > rel AND l > -70.0) AS n_gated,
                    avg(z) FILTER (WHERE l > rel AND l > -70.0) AS zg
             FROM {name}_b b JOIN {name}_r r USING (utt_id) GROUP BY b.utt_id),
{name} AS (SELECT r.utt_id, CAST(n_blocks AS BIGINT) AS n_blocks, CAST(coalesce(n_gated, 0) AS BIGINT) AS n_gated,
                  CASE WHEN zg > 0 THEN -0.691 + 10.0 * log10(zg) ELSE CAST('-inf' AS DOUBLE) END AS lufs
           FROM {name}_r r LEFT JOIN {name}_s s USING (utt_id))
"""


@register(
    "d7_integrated_loudness",
    with_views("v_frames")
    + ", fz AS (SELECT utt_id, rms * rms AS z FROM v_frames)\n"
    + _gating_sql("fz", "lu")
    + f"SELECT utt_id, n_blocks, n_gated, {sqlq('lufs')} AS lufs FROM lu",
)
def d7_integrated_loudness(spark, sf_dir):
    blocks = v_frames(spark, sf_dir).select("utt_id", (F.col("rms") * F.col("rms")).alias("z"))
    return rounded(D.integrated_loudness(blocks))


K_RATE, K_WINDOW, K_OVERLAP = 8000, 0.004, 0.75  # windows of 32 samples every 8


def _loudness_sql() -> str:
    """K-weighting as a recursion over the samples, one step for each."""
    (b, a), (d, c) = D.k_weighting_coefficients(K_RATE)
    b0, b1, b2, a1, a2 = (_c(v / a[0]) for v in (*b, *a[1:]))
    d0, d1, d2, c1, c2 = (_c(v / c[0]) for v in (*d, *c[1:]))
    per, step = round(K_WINDOW * K_RATE), round(K_WINDOW * (1 - K_OVERLAP) * K_RATE)
    return (
        with_views("v_samples").replace("v_samples AS (", "v_samples AS MATERIALIZED (")
        + f""", k(utt_id, idx, z1, z2, u1, u2, y) AS (
  SELECT utt_id, CAST(-1 AS BIGINT), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM (SELECT DISTINCT utt_id FROM v_samples)
  UNION ALL
  SELECT utt_id, idx, {b1} * x - {a1} * v + z2, {b2} * x - {a2} * v, {d1} * v - {c1} * w + u2, {d2} * v - {c2} * w, w FROM (
    SELECT *, {d0} * v + u1 AS w FROM (
      SELECT k.utt_id, s.idx, z1, z2, u1, u2, s.sample AS x, {b0} * s.sample + z1 AS v
      FROM k JOIN v_samples s ON s.utt_id = k.utt_id AND s.idx = k.idx + 1))),
size AS (SELECT utt_id, count(*) AS n FROM v_samples GROUP BY utt_id),
win AS (SELECT utt_id, unnest(range(0, (n - {per}) // {step} + 1)) AS j FROM size WHERE n >= {per}),
kz AS (SELECT win.utt_id, j, sum(y * y) / {per} AS z FROM win JOIN k ON k.utt_id = win.utt_id AND idx >= j * {step} AND idx < j * {step} + {per}
       GROUP BY win.utt_id, j)
"""
        + _gating_sql("kz", "lu")
        + f"SELECT utt_id, n_blocks, n_gated, {sqlq('lufs')} AS lufs FROM lu"
    )


@register("d7_loudness_from_samples", _loudness_sql())
def d7_loudness_from_samples(spark, sf_dir):
    """From blocks of seven samples, so that every recording is a chain of
    filter states."""
    blocks = D.to_blocks(v_samples(spark, sf_dir), 7)
    return rounded(D.loudness(blocks, K_RATE, block_s=K_WINDOW, overlap=K_OVERLAP))


def _energies(samples):
    return samples.select("utt_id", (F.col("sample") * F.col("sample")).alias("z"))


def _d8_sql(measure: str) -> str:
    if measure == "before":
        src = ", ez AS (SELECT utt_id, sample * sample AS z FROM v_samples)\n"
    else:
        src = ", ez AS (SELECT utt_id, sample * sample * gain * gain AS z FROM v_samples JOIN pg USING (utt_id))\n"
    return (
        with_views("v_samples")
        + _PG_SQL
        + src
        + _gating_sql("ez", "lu")
        + f""", lg AS (SELECT utt_id, pow(10.0, ({_c(TARGET_LUFS)} - lufs) / 20.0) AS loud_gain FROM lu)
SELECT utt_id, idx, {sqlq('sample * gain * loud_gain')} AS out FROM v_samples JOIN pg USING (utt_id) JOIN lg USING (utt_id)"""
    )


@register("d8_normalise_before", _d8_sql("before"))
def d8_normalise_before(spark, sf_dir):
    samples = v_samples(spark, sf_dir)
    out = D.normalise_loudness(samples, _energies(samples), TARGET_LUFS, PEAK_DB, "before")
    return rounded(out.select("utt_id", "idx", "out"))


@register("d8_normalise_after", _d8_sql("after"))
def d8_normalise_after(spark, sf_dir):
    samples = v_samples(spark, sf_dir)
    out = D.normalise_loudness(samples, _energies(samples), TARGET_LUFS, PEAK_DB, "after")
    return rounded(out.select("utt_id", "idx", "out"))


@register(
    "d9_loudness_report",
    _d8_sql("before").split("SELECT utt_id, idx,")[0]
    + f""", outz AS (SELECT utt_id, (sample * gain * loud_gain) * (sample * gain * loud_gain) AS z
         FROM v_samples JOIN pg USING (utt_id) JOIN lg USING (utt_id))
{_gating_sql('outz', 'la')}
SELECT utt_id, {sqlq("lu.lufs")} AS before_lufs, {sqlq('la.lufs')} AS after_lufs FROM lu FULL JOIN la USING (utt_id)""",
)
def d9_loudness_report(spark, sf_dir):
    samples = v_samples(spark, sf_dir)
    energies = _energies(samples)
    out = D.normalise_loudness(samples, energies, TARGET_LUFS, PEAK_DB, "before")
    before = D.integrated_loudness(energies)
    after = D.integrated_loudness(out.select("utt_id", (F.col("out") * F.col("out")).alias("z")))
    return rounded(D.loudness_report(before, after))


D2_FROM, D2_TO, D2_HALF, D2_BLOCK = 3, 2, 2, 16


def _taps_sql():
    h = D.resample_taps(D2_TO, D2_FROM, D2_HALF)
    return "(VALUES " + ", ".join(f"({i}, CAST({float(v)!r} AS DOUBLE))" for i, v in enumerate(h)) + ") taps(t, h)", (len(h) - 1) // 2


_TAPS, _C = _taps_sql()


@register(
    "d2_resample",
    with_views("v_samples")
    + f""", n AS (SELECT utt_id, max(idx) + 1 AS n FROM v_samples GROUP BY utt_id),
c AS (SELECT s.utt_id, t + s.idx * {D2_TO} - {_C} AS num, s.sample * taps.h AS p, n.n
      FROM v_samples s JOIN n USING (utt_id), {_TAPS}
      WHERE t + s.idx * {D2_TO} - {_C} >= 0 AND (t + s.idx * {D2_TO} - {_C}) % {D2_FROM} = 0)
SELECT utt_id, CAST(num // {D2_FROM} AS BIGINT) AS k, {sqlq('sum(p)')} AS y FROM c
WHERE num // {D2_FROM} < ceil(n * {D2_TO} / {D2_FROM}) GROUP BY utt_id, num""",
)
def d2_resample(spark, sf_dir):
    blocks = D.to_blocks(v_samples(spark, sf_dir), D2_BLOCK)
    out = D.resample(blocks, D2_FROM, D2_TO, half_width=D2_HALF)
    return rounded(out.select("utt_id", "start", F.posexplode("samples").alias("o", "y")).select(
        "utt_id", (F.col("start") + F.col("o")).alias("k"), "y"))


# ------------------------------------------------------ the same on blocks of samples
BLOCK = 16


def _flat(blocks, keys, column, name):
    """Blocks as rows, for the comparison only."""
    rows = blocks.select(*keys, "start", F.posexplode(column).alias("_o", name))
    return rows.select(*keys, (F.col("start") + F.col("_o")).alias("idx"), name)


def _stem_blocks(spark, sf_dir):
    return D.to_blocks(v_stems(spark, sf_dir), BLOCK, ["utt_id", "track", "channel"])


def _sample_blocks(spark, sf_dir):
    return D.to_blocks(v_samples(spark, sf_dir), BLOCK)


@register("d1_downmix_blocks", ORACLES["d1_downmix"])
def d1_downmix_blocks(spark, sf_dir):
    return rounded(_flat(B.downmix(_stem_blocks(spark, sf_dir), ["utt_id", "track"]), ["utt_id", "track"], "samples", "sample"))


@register("d3_standardise_blocks", ORACLES["d3_standardise"])
def d3_standardise_blocks(spark, sf_dir):
    out = B.standardise(_stem_blocks(spark, sf_dir), ["utt_id", "track"])
    both = F.arrays_zip("standardised", "restored")
    rows = out.select("utt_id", "track", "channel", "start", F.posexplode(both).alias("o", "v"))
    return rounded(rows.select("utt_id", "track", (F.col("start") + F.col("o")).alias("idx"), "channel", "v.standardised", "v.restored"))


@register("d4_mix_tracks_blocks", ORACLES["d4_mix_tracks"])
def d4_mix_tracks_blocks(spark, sf_dir):
    out = B.mix_tracks(_stem_blocks(spark, sf_dir), ["view", "click"])
    return rounded(_flat(out, ["utt_id", "channel"], "samples", "sample"))


@register(
    "d5_repair_spikes_blocks",
    ORACLES["d5_repair_spikes"].replace(", spike AS was_spike FROM c", " FROM c"),
)
def d5_repair_spikes_blocks(spark, sf_dir):
    return rounded(_flat(B.repair_spikes(_sample_blocks(spark, sf_dir), SPIKE_RATE, SPIKE_DB), ["utt_id"], "repaired", "repaired"))


@register("d6_peak_normalise_blocks", ORACLES["d6_peak_normalise"])
def d6_peak_normalise_blocks(spark, sf_dir):
    blocks = _sample_blocks(spark, sf_dir)
    return rounded(_flat(B.apply_gain(blocks, B.peak_gain(blocks, PEAK_DB)), ["utt_id"], "samples", "out"))


def _block_energies(blocks):
    return D.power_by_bucket(blocks, 1).select("utt_id", F.col("ss").alias("z"))


def _d8_blocks(spark, sf_dir, measure):
    blocks = _sample_blocks(spark, sf_dir)
    out = B.normalise_loudness(blocks, _block_energies(blocks), TARGET_LUFS, PEAK_DB, measure)
    return rounded(_flat(out, ["utt_id"], "samples", "out"))


@register("d8_normalise_before_blocks", ORACLES["d8_normalise_before"])
def d8_normalise_before_blocks(spark, sf_dir):
    return _d8_blocks(spark, sf_dir, "before")


@register("d8_normalise_after_blocks", ORACLES["d8_normalise_after"])
def d8_normalise_after_blocks(spark, sf_dir):
    return _d8_blocks(spark, sf_dir, "after")
