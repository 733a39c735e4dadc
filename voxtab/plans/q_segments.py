"""Checked queries C1, C2, C13-C17 (interval operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import segments as C
from voxtab.plans.registry import register
from voxtab.sources.views import v_frames, v_infos, v_turns, with_views

D = "CAST({} AS DOUBLE)".format


@register(
    "c1_segment_fixed",
    with_views("v_infos")
    + f"""SELECT path, seg_idx, CAST(floor(seg_idx * len) AS BIGINT) AS start,
       least(CAST(floor((seg_idx + 1) * len) AS BIGINT), frames) AS "end"
FROM (SELECT path, frames, {D(300)} * rate AS len,
             unnest(range(CAST(ceil(frames / ({D(300)} * rate)) AS BIGINT))) AS seg_idx FROM v_infos)""",
)
def c1_segment_fixed(spark, sf_dir):
    return C.segment_fixed(v_infos(spark, sf_dir), 300).select("path", "seg_idx", "start", "end")


@register(
    "c2_split_by_max",
    with_views("v_infos")
    + f""", s AS (SELECT path, CAST(0 AS BIGINT) AS s0, frames AS e0, frames AS len, {D(300)} * rate AS lim FROM v_infos),
p AS (SELECT *, CASE WHEN len > lim THEN CAST(ceil(len / CAST(ceil(len / lim) AS BIGINT)) AS BIGINT)
                     ELSE greatest(len, 1) END AS chunk FROM s)
SELECT path, piece_idx, s0 + piece_idx * chunk AS start, least(s0 + piece_idx * chunk + chunk, e0) AS "end"
FROM (SELECT *, unnest(range(greatest(CAST(ceil(len / chunk) AS BIGINT), 1))) AS piece_idx FROM p)""",
)
def c2_split_by_max(spark, sf_dir):
    segs = v_infos(spark, sf_dir).select("path", "rate", F.lit(0).cast("bigint").alias("start"), F.col("frames").alias("end"))
    return C.split_by_max(segs, 300.0).select("path", "piece_idx", "start", "end")


@register(
    "c13_pad_intervals",
    with_views("v_turns")
    + f""", t AS (SELECT conv_id, start, "end", max("end") OVER (PARTITION BY conv_id) + 100 AS total,
                  min(start) OVER (PARTITION BY conv_id) AS first FROM v_turns)
SELECT conv_id, start, "end",
       CAST(trunc(greatest(0.0, start / {D(1000)} - CASE WHEN start = first THEN {D(2.5)} ELSE {D(0.3)} END) * {D(1000)}) AS BIGINT) AS pad_start,
       CAST(trunc(least(total / {D(1000)}, "end" / {D(1000)} + {D(0.3)}) * {D(1000)}) AS BIGINT) AS pad_end
FROM t""",
)
def c13_pad_intervals(spark, sf_dir):
    t = v_turns(spark, sf_dir).select("conv_id", "start", "end")
    totals = t.groupBy("conv_id").agg((F.max("end") + 100).alias("total"))
    return C.pad_intervals(t.join(totals, "conv_id"), "conv_id", 1000.0).select("conv_id", "start", "end", "pad_start", "pad_end")


@register(
    "c14_speech_intervals",
    with_views("v_frames")
    + """, g AS (SELECT utt_id, frame_idx, rms >= 0.04 AS sp,
                  sum(CASE WHEN rms >= 0.04 THEN 0 ELSE 1 END) OVER (PARTITION BY utt_id ORDER BY frame_idx) AS off
           FROM v_frames),
runs AS (SELECT utt_id, min(frame_idx) AS rs, max(frame_idx) + 1 AS re FROM g WHERE sp GROUP BY utt_id, off),
r2 AS (SELECT *, lag(re) OVER (PARTITION BY utt_id ORDER BY rs) AS pre FROM runs),
r3 AS (SELECT *, sum(CASE WHEN pre IS NULL OR rs - pre >= 3 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY utt_id ORDER BY rs) AS grp FROM r2),
m AS (SELECT utt_id, min(rs) AS s0, max(re) AS e0, max(re) - min(rs) AS len FROM r3 GROUP BY utt_id, grp
      HAVING max(re) - min(rs) >= 5),
p AS (SELECT *, CASE WHEN len > 50.0 THEN CAST(ceil(len / CAST(ceil(len / 50.0) AS BIGINT)) AS BIGINT)
                     ELSE greatest(len, 1) END AS chunk FROM m)
SELECT utt_id, s0 + k * chunk AS start, least(s0 + k * chunk + chunk, e0) AS "end"
FROM (SELECT *, unnest(range(greatest(CAST(ceil(len / chunk) AS BIGINT), 1))) AS k FROM p)""",
)
def c14_speech_intervals(spark, sf_dir):
    frames = v_frames(spark, sf_dir).withColumnRenamed("rms", "prob")
    out = C.speech_intervals(frames, "utt_id", threshold=0.04, min_speech=5, max_speech=50, min_silence=3)
    return out.select("utt_id", "start", "end")


_N16 = f"CAST(ceil(frames * {D(16000)} / rate) AS BIGINT)"


def _n16(spark, sf_dir):
    infos = v_infos(spark, sf_dir)
    return infos.withColumn("n", C.resampled_length("frames", "rate", 16000))


@register(
    "c15_chunk_tumbling",
    with_views("v_infos")
    + f"""SELECT path, chunk_idx, chunk_idx * 32000 AS start, least(chunk_idx * 32000 + 32000, n) AS "end"
FROM (SELECT path, n, unnest(range(CAST(ceil(n / {D(32000)}) AS BIGINT))) AS chunk_idx
      FROM (SELECT path, {_N16} AS n FROM v_infos) WHERE n > 0)
WHERE least(chunk_idx * 32000 + 32000, n) - chunk_idx * 32000 >= 16000""",
)
def c15_chunk_tumbling(spark, sf_dir):
    return C.chunk_tumbling(_n16(spark, sf_dir), "n", 16000).select("path", "chunk_idx", "start", "end")


_C16_SQL = (
    with_views("v_infos")
    + f""", n AS (SELECT path, {_N16} AS n FROM v_infos),
k AS (SELECT path, n, (SELECT min(i) FROM range(0, 63) t(i) WHERE n * pow(2.0, i) >= 144160) AS doublings FROM n WHERE n > 0),
padded AS (SELECT path, n, CAST(n * pow(2.0, doublings) AS BIGINT) AS padded, CAST(doublings AS BIGINT) AS doublings, 'ok' AS status FROM k
           UNION ALL SELECT path, n, NULL, NULL, 'failed' FROM n WHERE n <= 0)
"""
)


@register("c16_loop_pad", _C16_SQL + "SELECT * FROM padded")
def c16_loop_pad(spark, sf_dir):
    return C.loop_pad(_n16(spark, sf_dir)).select("path", "n", "padded", "doublings", "status")


@register(
    "c17_sliding_hops",
    _C16_SQL
    + f"""SELECT path, hop_idx, CAST(hop_idx * {D(16000)} AS BIGINT) AS start,
       least(CAST(trunc((hop_idx + {D(9.01)}) * {D(16000)}) AS BIGINT), padded) AS "end"
FROM (SELECT path, padded, unnest(range(CAST(floor(padded / {D(16000)} - {D(9.01)}) + 1 AS BIGINT))) AS hop_idx
      FROM padded WHERE padded IS NOT NULL AND floor(padded / {D(16000)} - {D(9.01)}) + 1 > 0)
WHERE least(CAST(trunc((hop_idx + {D(9.01)}) * {D(16000)}) AS BIGINT), padded) - CAST(hop_idx * {D(16000)} AS BIGINT) >= 144160""",
)
def c17_sliding_hops(spark, sf_dir):
    padded = C.loop_pad(_n16(spark, sf_dir))
    return C.sliding_hops(padded).select("path", "hop_idx", "start", "end")
