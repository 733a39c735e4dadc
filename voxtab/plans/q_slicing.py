"""Checked queries C3-C12 and C18 (framing, silence runs, cut tags, merges,
gather). The SQL forms of the path-dependent rules are recursive CTEs that
walk each recording frame by frame / run by run, an independent
formulation of the same rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import blocks as B
from voxtab.operators import segments as C
from voxtab.operators import signal as D
from voxtab.operators import silence as S
from voxtab.operators.signal import gather
from voxtab.plans.registry import ORACLES, register, rounded, sqlq
from voxtab.sources.views import v_frames, v_infos, v_samples, v_turns, with_views

HOP = 160  # samples per frame of v_frames (10 ms at 16 kHz)
RATE = 16000
P = S.SlicerParams(threshold=0.04, hop=HOP, win=4 * HOP, min_length=5, min_interval=2, max_sil_kept=3)
M, MI, ML, THR = P.max_sil_kept, P.min_interval, P.min_length, P.threshold


def _totals(frames):
    return frames.groupBy("utt_id").agg((F.max("frame_idx") + 1).alias("T")).withColumn("n", F.col("T") * HOP)


# ------------------------------------------------------------------ C3
@register(
    "c3_frame_rms",
    with_views("v_samples")
    + f""", n AS (SELECT utt_id, max(idx) + 1 AS n FROM v_samples GROUP BY utt_id),
fr AS (SELECT utt_id, unnest(range(0, n // 4 + 1)) AS frame_idx FROM n)
SELECT fr.utt_id, CAST(fr.frame_idx AS BIGINT) AS frame_idx, {sqlq("sqrt(sum(s.sample * s.sample) / 16)")} AS rms
FROM fr JOIN v_samples s ON s.utt_id = fr.utt_id AND s.idx >= fr.frame_idx * 4 - 8 AND s.idx < fr.frame_idx * 4 + 8
GROUP BY fr.utt_id, fr.frame_idx""",
)
def c3_frame_rms(spark, sf_dir):
    return rounded(S.frame_rms(v_samples(spark, sf_dir), win=16, hop=4))


@register("c3_frame_rms_blocks", ORACLES["c3_frame_rms"])
def c3_frame_rms_blocks(spark, sf_dir):
    return rounded(B.frame_rms(D.to_blocks(v_samples(spark, sf_dir), 16), win=16, hop=4))


@register(
    "c3_frame_rms_unaligned",
    with_views("v_samples")
    + f""", n AS (SELECT utt_id, max(idx) + 1 AS n FROM v_samples GROUP BY utt_id),
fr AS (SELECT utt_id, unnest(range(0, n // 4 + 1)) AS frame_idx FROM n)
SELECT fr.utt_id, CAST(fr.frame_idx AS BIGINT) AS frame_idx, {sqlq("sqrt(sum(s.sample * s.sample) / 10)")} AS rms
FROM fr JOIN v_samples s ON s.utt_id = fr.utt_id AND s.idx >= fr.frame_idx * 4 - 5 AND s.idx < fr.frame_idx * 4 + 5
GROUP BY fr.utt_id, fr.frame_idx""",
)
def c3_frame_rms_unaligned(spark, sf_dir):
    return rounded(S.frame_rms(v_samples(spark, sf_dir), win=10, hop=4))


# ------------------------------------------------------------------ C4, C5
_C4_SQL = (
    with_views("v_frames")
    + f""", pk AS (SELECT utt_id, max(rms * rms) AS peak, (max(frame_idx) + 1) * {HOP} AS n FROM v_frames GROUP BY utt_id),
g AS (SELECT f.utt_id, f.frame_idx,
             10.0 * log10(greatest(1e-10, rms * rms)) - 10.0 * log10(greatest(1e-10, peak)) > -20.0 AS loud
      FROM v_frames f JOIN pk USING (utt_id)),
h AS (SELECT *, sum(CASE WHEN loud THEN 0 ELSE 1 END) OVER (PARTITION BY utt_id ORDER BY frame_idx) AS c FROM g),
iv AS (SELECT h.utt_id, min(frame_idx) * {HOP} AS start, least((max(frame_idx) + 1) * {HOP}, any_value(pk.n)) AS "end"
       FROM h JOIN pk USING (utt_id) WHERE loud GROUP BY h.utt_id, c)
"""
)


def _c4(spark, sf_dir):
    frames = v_frames(spark, sf_dir)
    return S.nonsilent_intervals(frames, 20.0, HOP, _totals(frames).select("utt_id", "n"))


@register("c4_nonsilent_intervals", _C4_SQL + "SELECT utt_id, start, \"end\" FROM iv")
def c4_nonsilent_intervals(spark, sf_dir):
    return _c4(spark, sf_dir)


C5_MIN, C5_PAD, C5_MAX = 4800, 640, 0.5  # samples, samples, seconds


@register(
    "c5_accumulate_min",
    _C4_SQL
    + f""", k AS (SELECT *, "end" - start AS len, row_number() OVER (PARTITION BY utt_id ORDER BY start) AS k FROM iv),
rec(utt_id, k, grp, acc, closed) AS (
  SELECT utt_id, k, CAST(0 AS BIGINT), len, len >= {C5_MIN} FROM k WHERE k = 1
  UNION ALL
  SELECT k.utt_id, k.k,
         CASE WHEN rec.closed THEN rec.grp + 1 ELSE rec.grp END,
         CASE WHEN rec.closed THEN k.len ELSE rec.acc + k.len END,
         CASE WHEN rec.closed THEN k.len ELSE rec.acc + k.len END >= {C5_MIN}
  FROM rec JOIN k ON k.utt_id = rec.utt_id AND k.k = rec.k + 1)
SELECT k.utt_id, k.start, k."end", rec.grp, CAST(CASE WHEN rec.closed THEN 0 ELSE {C5_PAD} END AS BIGINT) AS pad_after
FROM rec JOIN k ON k.utt_id = rec.utt_id AND k.k = rec.k""",
)
def c5_accumulate_min(spark, sf_dir):
    return C.accumulate_min(_c4(spark, sf_dir), C5_MIN, C5_PAD)


_MAX = int(C5_MAX * RATE)


@register(
    "c5_first_slicer",
    ORACLES["c5_accumulate_min"].split("SELECT k.utt_id, k.start, k.")[0]
    + f""", total AS (SELECT utt_id, (max(frame_idx) + 1) * {HOP} AS n FROM v_frames GROUP BY utt_id),
mem AS (SELECT k.utt_id, rec.grp, k.start, k.len, CASE WHEN rec.closed THEN 0 ELSE {C5_PAD} END AS pad
        FROM rec JOIN k ON k.utt_id = rec.utt_id AND k.k = rec.k JOIN total ON total.utt_id = k.utt_id WHERE total.n >= {C5_MIN}),
line AS (SELECT utt_id, grp, start, len, pad, sum(len + pad) OVER (PARTITION BY utt_id, grp ORDER BY start) - len - pad AS off FROM mem
         UNION ALL SELECT utt_id, 0, 0, n, 0, 0 FROM total WHERE n < {C5_MIN}),
cut AS (SELECT utt_id, grp, CAST(ceil(size / CASE WHEN size > {_MAX} THEN ceil(size / {_MAX}.0) ELSE 1 END) AS BIGINT) AS chunk, size
        FROM (SELECT utt_id, grp, CAST(sum(len + pad) AS BIGINT) AS size FROM line GROUP BY utt_id, grp)),
num AS (SELECT *, sum((size + chunk - 1) // chunk) OVER (PARTITION BY utt_id ORDER BY grp) - (size + chunk - 1) // chunk AS base FROM cut),
span AS (SELECT utt_id, grp, off AS lo, off + len AS hi, start AS src FROM line
         UNION ALL SELECT utt_id, grp, off + len, off + len + pad, NULL FROM line WHERE pad > 0),
part AS (SELECT s.*, chunk, base, CAST(unnest(range(CAST(lo AS BIGINT) // chunk, (CAST(hi AS BIGINT) - 1) // chunk + 1)) AS BIGINT) AS j
         FROM span s JOIN num USING (utt_id, grp))
SELECT utt_id, CAST(base + j AS BIGINT) AS seg_idx, CAST(greatest(lo, j * chunk) - j * chunk AS BIGINT) AS at,
       CAST(least(hi, (j + 1) * chunk) - greatest(lo, j * chunk) AS BIGINT) AS length,
       CAST(src + greatest(lo, j * chunk) - lo AS BIGINT) AS src_start FROM part""",
)
def c5_first_slicer(spark, sf_dir):
    totals = _totals(v_frames(spark, sf_dir)).select("utt_id", "n")
    return C.slice_accumulated(_c4(spark, sf_dir), totals, C5_MIN, C5_PAD, _MAX)


# ------------------------------------------------------------------ C6
@register(
    "c6_slicer_params",
    with_views("v_infos")
    + """SELECT rate, 10 ^ (-25.0 / 20.0) AS threshold, hop,
       least(CAST(round_even(rate * 300.0 / 1000, 0) AS BIGINT), hop * 4) AS win,
       CAST(round_even(rate * 3000.0 / 1000 / hop, 0) AS BIGINT) AS min_length,
       CAST(round_even(rate * 300.0 / 1000 / hop, 0) AS BIGINT) AS min_interval,
       CAST(round_even(rate * 500.0 / 1000 / hop, 0) AS BIGINT) AS max_sil_kept
FROM (SELECT DISTINCT rate, CAST(round_even(rate * 10.0 / 1000, 0) AS BIGINT) AS hop FROM v_infos)""",
)
def c6_slicer_params(spark, sf_dir):
    out = S.slicer_params(v_infos(spark, sf_dir), threshold_db=-25.0, min_length=3000, min_interval=300, hop_size=10,
                          max_sil_kept=500)
    return rounded(out)


# ------------------------------------------------------------------ C7-C10
_RUNS_SQL = (
    with_views("v_frames")
    + f""", tt AS (SELECT utt_id, max(frame_idx) + 1 AS T FROM v_frames GROUP BY utt_id),
g AS (SELECT utt_id, frame_idx, rms, rms < {THR} AS sil,
             sum(CASE WHEN rms < {THR} THEN 0 ELSE 1 END) OVER (PARTITION BY utt_id ORDER BY frame_idx) AS c
      FROM v_frames),
runs AS (SELECT g.utt_id, min(frame_idx) AS s, max(frame_idx) + 1 AS e, any_value(tt.T) AS T
         FROM g JOIN tt USING (utt_id) WHERE sil GROUP BY g.utt_id, c)
"""
)


@register("c7_silent_runs", _RUNS_SQL + 'SELECT utt_id, s, e, T, e < T AS closed FROM runs')
def c7_silent_runs(spark, sf_dir):
    return S.silent_runs(v_frames(spark, sf_dir), THR)


def _amin(cond):
    return f"struct_extract(min(struct_pack(r := f.rms, i := f.frame_idx)) FILTER (WHERE {cond}), 'i')"


_TAGS_SQL = (
    _RUNS_SQL
    + f""", st AS (
  SELECT r.utt_id, r.s, r.e, r.T,
         {_amin('TRUE')} AS "full", {_amin(f'f.frame_idx <= r.s + {M}')} AS head,
         {_amin(f'f.frame_idx >= r.e - {M}')} AS tail,
         {_amin(f'f.frame_idx >= r.e - {M} AND f.frame_idx <= r.s + {M}')} AS mid
  FROM runs r JOIN v_frames f ON f.utt_id = r.utt_id AND f.frame_idx BETWEEN r.s AND r.e
  GROUP BY r.utt_id, r.s, r.e, r.T),
x AS (
  SELECT *, e < T AS closed,
         CAST(CASE WHEN s = 0 THEN 0 WHEN e - s <= {M} THEN "full" WHEN e - s <= {2 * M} THEN least(head, mid) ELSE head END AS BIGINT) AS lo,
         CAST(CASE WHEN e - s <= {M} THEN "full" WHEN e - s <= {2 * M} AND s != 0 THEN greatest(tail, mid) ELSE tail END AS BIGINT) AS hi,
         row_number() OVER (PARTITION BY utt_id ORDER BY s) AS k
  FROM st),
rec(utt_id, k, cs) AS (
  SELECT utt_id, CAST(1 AS BIGINT), CAST(0 AS BIGINT) FROM tt
  UNION ALL
  SELECT rec.utt_id, rec.k + 1,
         CASE WHEN x.closed AND ((x.s = 0 AND x.e > {M}) OR (x.e - x.s >= {MI} AND x.e - rec.cs >= {ML})) THEN x.hi ELSE rec.cs END
  FROM rec JOIN x ON x.utt_id = rec.utt_id AND x.k = rec.k),
tags AS (
  SELECT x.utt_id, x.lo, x.hi, x.T FROM rec JOIN x ON x.utt_id = rec.utt_id AND x.k = rec.k
  WHERE x.closed AND ((x.s = 0 AND x.e > {M}) OR (x.e - x.s >= {MI} AND x.e - rec.cs >= {ML}))
  UNION ALL
  SELECT utt_id, CAST(head AS BIGINT), T + 1, T FROM x WHERE NOT closed AND T - s >= {MI})
"""
)


@register("c8_cut_tags", _TAGS_SQL + "SELECT utt_id, lo, hi, T FROM tags")
def c8_cut_tags(spark, sf_dir):
    return S.cut_tags(v_frames(spark, sf_dir), P)


_SEGS_SQL = (
    _TAGS_SQL
    + f""", tl AS (SELECT *, lag(hi) OVER (PARTITION BY utt_id ORDER BY lo, hi) AS prev_hi,
                   row_number() OVER (PARTITION BY utt_id ORDER BY lo DESC, hi DESC) AS rk FROM tags),
fi AS (
  SELECT utt_id, coalesce(prev_hi, 0) AS fs, lo AS fe FROM tl WHERE prev_hi IS NOT NULL OR lo > 0
  UNION ALL SELECT utt_id, hi, T FROM tl WHERE rk = 1 AND hi < T
  UNION ALL SELECT utt_id, 0, T FROM tt WHERE utt_id NOT IN (SELECT utt_id FROM tags)),
segs AS (
  SELECT fi.utt_id, CAST(least(fs * {HOP}, tt.T * {HOP}) AS BIGINT) AS start,
         CAST(greatest(least(fe * {HOP}, tt.T * {HOP}), least(fs * {HOP}, tt.T * {HOP})) AS BIGINT) AS "end"
  FROM fi JOIN tt USING (utt_id))
"""
)


@register("c9_tags_to_segments", _SEGS_SQL + 'SELECT utt_id, start, "end" FROM segs')
def c9_tags_to_segments(spark, sf_dir):
    frames = v_frames(spark, sf_dir)
    return S.tags_to_segments(S.cut_tags(frames, P), _totals(frames), HOP)


C10_MIN_S, C10_MAX_S = 0.05, 0.3


@register(
    "c10_slice_by_energy",
    _SEGS_SQL
    + f""", g2 AS (SELECT *, row_number() OVER (PARTITION BY utt_id ORDER BY start, "end") - 1 AS grp,
                   "end" - start AS len, {C10_MAX_S} * {RATE} AS lim FROM segs),
p AS (SELECT *, CASE WHEN len > lim THEN CAST(ceil(len / CAST(ceil(len / lim) AS BIGINT)) AS BIGINT)
                     ELSE greatest(len, 1) END AS chunk FROM g2)
SELECT utt_id, CAST(grp AS BIGINT) AS grp, piece_idx, start + piece_idx * chunk AS start,
       least(start + piece_idx * chunk + chunk, "end") AS "end"
FROM (SELECT *, unnest(range(greatest(CAST(ceil(len / chunk) AS BIGINT), 1))) AS piece_idx FROM p)""",
)
def c10_slice_by_energy(spark, sf_dir):
    frames = v_frames(spark, sf_dir)
    out = S.slice_by_energy(frames, _totals(frames).select("utt_id", "n"), P, RATE, C10_MIN_S, C10_MAX_S)
    return out.select("utt_id", "grp", "piece_idx", "start", "end")


# ------------------------------------------------------------------ C11, C12
def _merge_sql(source: str, keys: str, order: str, length: str, limit: str, compat: bool) -> str:
    reset = "0" if compat else "t.len"
    on = " AND ".join(f"t.{k.strip()} = rec.{k.strip()}" for k in keys.split(","))
    return f""", t AS (SELECT {keys}, {length} AS len, {limit} AS lim,
              row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS k FROM {source}),
rec AS (
  SELECT {keys}, k, CAST(0 AS BIGINT) AS grp, len AS cnt, len FROM t WHERE k = 1
  UNION ALL
  SELECT {", ".join("t." + k.strip() for k in keys.split(","))}, t.k,
         CASE WHEN rec.cnt + t.len > t.lim THEN rec.grp + 1 ELSE rec.grp END,
         CASE WHEN rec.cnt + t.len > t.lim THEN {reset} ELSE rec.cnt + t.len END, t.len
  FROM rec JOIN t ON {on} AND t.k = rec.k + 1)
SELECT {keys}, grp, CAST(count(*) AS BIGINT) AS n_pieces, CAST(sum(len) AS BIGINT) AS length
FROM rec GROUP BY {keys}, grp"""


def _turn_segs(spark, sf_dir):
    return v_turns(spark, sf_dir).select("conv_id", "start", "end")


@register("c11_merge_short", with_views("v_turns") + _merge_sql("v_turns", "conv_id", "start", '"end" - start', "2000.0", True))
def c11_merge_short(spark, sf_dir):
    return C.merge_short(_turn_segs(spark, sf_dir), 2000, key="conv_id").select("conv_id", "grp", "n_pieces", "length")


@register("c11_merge_short_counted", with_views("v_turns") + _merge_sql("v_turns", "conv_id", "start", '"end" - start', "2000.0", False))
def c11_merge_short_counted(spark, sf_dir):
    return C.merge_short(_turn_segs(spark, sf_dir), 2000, key="conv_id", compat=False).select("conv_id", "grp", "n_pieces", "length")


@register(
    "c12_merge_short_corpus",
    with_views("v_infos") + _merge_sql("v_infos", "lang, rate", "string_split(path, '/')", "frames", "rate * 20.0", True),
)
def c12_merge_short_corpus(spark, sf_dir):
    out = C.merge_short_corpus(v_infos(spark, sf_dir), 20.0, key=("lang", "rate"))
    return out.select("lang", "rate", "grp", "n_pieces", "length")


# ------------------------------------------------------------------ C18
@register(
    "c18_gather",
    with_views("v_frames", "v_samples")
    + """, g AS (SELECT utt_id, frame_idx, rms >= 0.04 AS sp,
                  sum(CASE WHEN rms >= 0.04 THEN 0 ELSE 1 END) OVER (PARTITION BY utt_id ORDER BY frame_idx) AS off
           FROM v_frames),
runs AS (SELECT utt_id, min(frame_idx) AS start, max(frame_idx) + 1 AS "end" FROM g WHERE sp GROUP BY utt_id, off
         HAVING max(frame_idx) + 1 - min(frame_idx) >= 3)
SELECT r.utt_id, r.start, s.idx, s.sample FROM runs r JOIN v_samples s
  ON s.utt_id = r.utt_id AND s.idx >= r.start AND s.idx < r."end" """,
)
def c18_gather(spark, sf_dir):
    frames = v_frames(spark, sf_dir).withColumn("_sp", F.col("rms") >= 0.04)
    segs = C.runs_of(frames, "utt_id", "frame_idx", "_sp").where(F.col("run_end") - F.col("run_start") >= 3)
    segs = segs.select("utt_id", F.col("run_start").alias("start"), F.col("run_end").alias("end"))
    return gather(v_samples(spark, sf_dir), segs, block=16).select("utt_id", "start", "idx", "sample")


@register(
    "c10_slice_by_energy_merged",
    _SEGS_SQL
    + f""", mt AS (SELECT utt_id, "end" - start AS len, {C10_MAX_S} * {RATE} AS lim,
              row_number() OVER (PARTITION BY utt_id ORDER BY start, "end") AS k FROM segs),
mrec AS (
  SELECT utt_id, k, CAST(0 AS BIGINT) AS grp, len AS cnt, len FROM mt WHERE k = 1
  UNION ALL
  SELECT mt.utt_id, mt.k, CASE WHEN mrec.cnt + mt.len > mt.lim THEN mrec.grp + 1 ELSE mrec.grp END,
         CASE WHEN mrec.cnt + mt.len > mt.lim THEN 0 ELSE mrec.cnt + mt.len END, mt.len
  FROM mrec JOIN mt ON mt.utt_id = mrec.utt_id AND mt.k = mrec.k + 1),
mg AS (SELECT utt_id, grp, CAST(sum(len) AS BIGINT) AS len, {C10_MAX_S} * {RATE} AS lim FROM mrec GROUP BY utt_id, grp),
mp AS (SELECT *, CASE WHEN len > lim THEN CAST(ceil(len / CAST(ceil(len / lim) AS BIGINT)) AS BIGINT)
                     ELSE greatest(len, 1) END AS chunk FROM mg)
SELECT utt_id, grp, piece_idx, piece_idx * chunk AS start, least(piece_idx * chunk + chunk, len) AS "end"
FROM (SELECT *, unnest(range(greatest(CAST(ceil(len / chunk) AS BIGINT), 1))) AS piece_idx FROM mp)""",
)
def c10_slice_by_energy_merged(spark, sf_dir):
    frames = v_frames(spark, sf_dir)
    out = S.slice_by_energy(frames, _totals(frames).select("utt_id", "n"), P, RATE, C10_MIN_S, C10_MAX_S, merge=True)
    return out.select("utt_id", "grp", "piece_idx", "start", "end")
