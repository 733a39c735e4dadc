"""Checked queries G1-G5 (quality scoring) over ``v_scores``."""

from __future__ import annotations


from voxtab.operators import quality as Q
from voxtab.plans.registry import register, rounded, sqlq, sql_horner
from voxtab.sources.views import v_scores, with_views

THRESHOLD = 3.5


def _cal_sql(personalised=False):
    polys = Q.PERSONALISED_POLY if personalised else Q.STANDARD_POLY
    return (
        with_views("v_scores")
        + """, cal AS (
  SELECT file, hop_idx, seconds, p808,
         {sig} AS sig, {bak} AS bak, {ovr} AS ovr
  FROM v_scores)""".format(
            sig=sql_horner("sig", polys["sig"]), bak=sql_horner("bak", polys["bak"]), ovr=sql_horner("ovr", polys["ovr"])
        )
    )


_SCORES_SQL = _cal_sql() + """, scores AS (
  SELECT CAST(file AS VARCHAR) AS audio_filepath, first(seconds) AS duration,
         avg(sig) AS SIG, avg(bak) AS BAK, avg(ovr) AS OVRL, avg(p808) AS P808_MOS,
         CAST(count(*) AS BIGINT) AS valid_hops
  FROM cal GROUP BY file)
"""


def _scores(spark, sf_dir):
    return Q.score_files(Q.calibrate(v_scores(spark, sf_dir)))


@register(
    "g1_calibrate",
    _cal_sql()
    + f"""SELECT file, hop_idx, {sqlq("sig")} AS sig, {sqlq("bak")} AS bak, {sqlq("ovr")} AS ovr,
       {sqlq("p808")} AS p808 FROM cal""",
)
def g1_calibrate(spark, sf_dir):
    return rounded(Q.calibrate(v_scores(spark, sf_dir, numbered=True)).select("file", "hop_idx", "sig", "bak", "ovr", "p808"))


@register(
    "g1_calibrate_personalised",
    _cal_sql(True)
    + f"""SELECT file, hop_idx, {sqlq("sig")} AS sig, {sqlq("bak")} AS bak, {sqlq("ovr")} AS ovr,
       {sqlq("p808")} AS p808 FROM cal""",
)
def g1_calibrate_personalised(spark, sf_dir):
    return rounded(Q.calibrate(v_scores(spark, sf_dir, numbered=True), True).select("file", "hop_idx", "sig", "bak", "ovr", "p808"))


@register(
    "g2_score_files",
    _SCORES_SQL
    + f"""SELECT audio_filepath, {sqlq("duration")} AS duration, {sqlq("SIG")} AS SIG, {sqlq("BAK")} AS BAK,
       {sqlq("OVRL")} AS OVRL, {sqlq("P808_MOS")} AS P808_MOS, valid_hops FROM scores""",
)
def g2_score_files(spark, sf_dir):
    return rounded(_scores(spark, sf_dir))


@register(
    "g3_split_quality",
    _SCORES_SQL
    + f"""SELECT audio_filepath, {sqlq("OVRL")} AS OVRL, {sqlq("duration")} AS duration,
       CASE WHEN OVRL >= {THRESHOLD} THEN 'pass' ELSE 'fail' END AS verdict FROM scores""",
)
def g3_split_quality(spark, sf_dir):
    return rounded(Q.split_by_quality(_scores(spark, sf_dir), THRESHOLD).select("audio_filepath", "OVRL", "duration", "verdict"))


_G4_SQL = (
    _SCORES_SQL
    + f"""SELECT verdict, CAST(count(*) AS BIGINT) AS n_files, {sqlq("sum(duration)")} AS total_seconds
FROM (SELECT *, CASE WHEN OVRL >= {THRESHOLD} THEN 'pass' ELSE 'fail' END AS verdict FROM scores)
GROUP BY verdict"""
)


@register("g4_quality_totals", _G4_SQL)
def g4_quality_totals(spark, sf_dir):
    return rounded(Q.quality_totals(Q.split_by_quality(_scores(spark, sf_dir), THRESHOLD)))


@register(
    "g5_quality_report",
    _SCORES_SQL
    + f""", m AS (SELECT avg(OVRL) AS mean_ovrl, quantile_cont(OVRL, 0.5) AS median_ovrl,
                  sum(duration) AS total_seconds FROM scores),
a AS (SELECT coalesce(sum(s.duration), 0.0) AS above FROM scores s, m WHERE s.OVRL > m.median_ovrl)
SELECT {sqlq("mean_ovrl")} AS mean_ovrl, {sqlq("median_ovrl")} AS median_ovrl,
       {sqlq("above")} AS above_median_seconds, {sqlq("total_seconds")} AS total_seconds,
       {sqlq("CASE WHEN total_seconds > 0 THEN above / total_seconds * 100 ELSE 0.0 END")} AS above_median_pct
FROM m, a""",
)
def g5_quality_report(spark, sf_dir):
    return rounded(Q.quality_report(_scores(spark, sf_dir)))


@register(
    "a12_manifest_lines",
    _SCORES_SQL
    + f""", q AS (SELECT audio_filepath, {sqlq("duration")} AS duration, {sqlq("SIG")} AS SIG, {sqlq("BAK")} AS BAK,
                  {sqlq("OVRL")} AS OVRL, {sqlq("P808_MOS")} AS P808_MOS, valid_hops FROM scores)
SELECT CASE WHEN OVRL >= {THRESHOLD} THEN 'pass' ELSE 'fail' END AS verdict,
       to_json(struct_pack(audio_filepath, duration, SIG, BAK, OVRL, P808_MOS, valid_hops)) AS value FROM q""",
)
def a12_manifest_lines(spark, sf_dir):
    from voxtab.sources.sinks import manifest_lines

    return manifest_lines(Q.split_by_quality(rounded(_scores(spark, sf_dir)), THRESHOLD))
