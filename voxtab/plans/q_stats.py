"""Checked queries E1-E8 (corpus statistics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import stats as E
from voxtab.plans.registry import register, rounded, sqlq
from voxtab.sources.views import v_infos, v_pitch, with_views

_INFOS = with_views("v_infos") + """, i AS (SELECT path, frames, rate, frames / rate AS seconds FROM v_infos
                                   WHERE frames IS NOT NULL AND rate > 0)
"""


def _infos(spark, sf_dir):
    return E.media_infos(v_infos(spark, sf_dir))


@register("e1_media_infos", _INFOS + f"SELECT path, frames, rate, {sqlq("seconds")} AS seconds FROM i")
def e1_media_infos(spark, sf_dir):
    return rounded(_infos(spark, sf_dir).select("path", "frames", "rate", "seconds"))


@register(
    "e2_duration_summary",
    _INFOS
    + f"""SELECT CAST(count(*) AS BIGINT) AS n_files, {sqlq("sum(seconds) / 3600")} AS total_hours,
       {sqlq("avg(seconds)")} AS mean_seconds, {sqlq("max(seconds)")} AS max_seconds,
       {sqlq("min(seconds)")} AS min_seconds, {sqlq("avg(rate)")} AS mean_rate FROM i""",
)
def e2_duration_summary(spark, sf_dir):
    return rounded(E.duration_summary(_infos(spark, sf_dir)))


@register("e3_longer_than", _INFOS + f"SELECT path, {sqlq("seconds")} AS seconds FROM i WHERE seconds > 600")
def e3_longer_than(spark, sf_dir):
    return rounded(E.longer_than(_infos(spark, sf_dir), 600).select("path", "seconds"))


@register("e4_shorter_than", _INFOS + f"SELECT path, {sqlq("seconds")} AS seconds FROM i WHERE seconds < 10")
def e4_shorter_than(spark, sf_dir):
    return rounded(E.shorter_than(_infos(spark, sf_dir), 10).select("path", "seconds"))


@register(
    "e5_duration_histogram",
    _INFOS
    + f""", s AS (SELECT CASE WHEN min(seconds) = max(seconds) THEN min(seconds) - 0.5 ELSE min(seconds) END AS lo,
                  CASE WHEN min(seconds) = max(seconds) THEN max(seconds) + 0.5 ELSE max(seconds) END AS hi FROM i),
c AS (SELECT CAST(least(floor((seconds - lo) * 100 / (hi - lo)), 99) AS INTEGER) AS bin, count(*) AS n FROM i, s GROUP BY 1),
e AS (SELECT CAST(b AS INTEGER) AS bin, lo + (hi - lo) * b / 100 AS bin_lo, lo + (hi - lo) * (b + 1) / 100 AS bin_hi
      FROM s, range(100) t(b))
SELECT e.bin, {sqlq("bin_lo")} AS bin_lo, {sqlq("bin_hi")} AS bin_hi, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM e LEFT JOIN c ON e.bin = c.bin""",
)
def e5_duration_histogram(spark, sf_dir):
    return rounded(E.duration_histogram(_infos(spark, sf_dir), 100))


_NOTES = with_views("v_pitch") + """, n AS (
  SELECT utt_id, f0, midi,
         (['C','C♯','D','D♯','E','F','F♯','G','G♯','A','A♯','B'])[((midi % 12) + 12) % 12 + 1]
         || CAST(CAST(floor(midi / 12) - 1 AS BIGINT) AS VARCHAR) AS note
  FROM (SELECT utt_id, f0, CAST(round_even(12.0 * (log2(f0) - log2(440.0)) + 69, 0) AS BIGINT) AS midi
        FROM v_pitch WHERE f0 IS NOT NULL AND NOT isnan(f0) AND f0 != 0 AND NOT isinf(f0)))
"""


def _notes(spark, sf_dir):
    return E.hz_to_note(v_pitch(spark, sf_dir))


@register("e6_hz_to_note", _NOTES + f"SELECT utt_id, {sqlq("f0")} AS f0, midi, note FROM n")
def e6_hz_to_note(spark, sf_dir):
    return rounded(_notes(spark, sf_dir).select("utt_id", "f0", "midi", "note"))


@register("e7_note_histogram", _NOTES + "SELECT note, midi, CAST(count(*) AS BIGINT) AS cnt FROM n GROUP BY note, midi")
def e7_note_histogram(spark, sf_dir):
    return E.note_histogram(_notes(spark, sf_dir))


@register(
    "e8_note_distribution",
    _NOTES
    + f""", c AS (SELECT note, midi, CAST(count(*) AS BIGINT) AS cnt FROM n GROUP BY note, midi)
SELECT note, midi, cnt, {sqlq("cnt / (SELECT sum(cnt) FROM c) * 100")} AS pct,
       cnt / (SELECT sum(cnt) FROM c) >= 0.001 AS shown FROM c""",
)
def e8_note_distribution(spark, sf_dir):
    return rounded(E.note_distribution(_notes(spark, sf_dir)))
