"""Checked queries A1-A9 (worklists) and B1-B4 (guards, ledger)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import files as A
from voxtab.operators import ledger as B
from voxtab.operators.segments import segment_fixed
from voxtab.plans.registry import register
from voxtab.sources.views import v_files, v_infos, v_ledger, with_views

_AUDIO_SQL = ", ".join(f"'{e}'" for e in A.AUDIO_EXTENSIONS)
_VIDEO_SQL = ", ".join(f"'{e}'" for e in A.VIDEO_EXTENSIONS)


def sql_name(p: str) -> str:
    return f"regexp_extract({p}, '([^/]*)$', 1)"


def sql_suffix(p: str) -> str:
    return f"regexp_extract({sql_name(p)}, '^.+(\\.[^.]+)$', 1)"


def sql_parent(p: str) -> str:
    return f"regexp_extract({p}, '^(.*)/[^/]*$', 1)"


def sql_stem(p: str) -> str:
    return f"regexp_replace({sql_name(p)}, '^(.+)\\.[^.]+$', '\\1')"


def sql_out_wav(p: str, repl: str) -> str:
    name = f"replace({sql_name(p)}, {sql_suffix(p)}, '{repl}')"
    return f"CASE WHEN {sql_parent(p)} = '' THEN {name} ELSE {sql_parent(p)} || '/' || {name} END"


# ---------------------------------------------------------------- A1-A9
@register(
    "a1_scan_filter",
    with_views("v_files")
    + f"""SELECT path, lang, doc_id,
       CAST(row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS BIGINT) AS pos
FROM v_files WHERE {sql_suffix('path')} IN ({_AUDIO_SQL}, {_VIDEO_SQL})""",
)
def a1_scan_filter(spark, sf_dir):
    f = A.filter_extensions(v_files(spark, sf_dir), A.AUDIO_EXTENSIONS + A.VIDEO_EXTENSIONS)
    return A.with_position(f)


@register(
    "a2_media_kind",
    with_views("v_files")
    + f"""SELECT path, CASE WHEN {sql_suffix('path')} IN ({_AUDIO_SQL}) THEN 'audio'
                    WHEN {sql_suffix('path')} IN ({_VIDEO_SQL}) THEN 'video' ELSE 'other' END AS kind
FROM v_files""",
)
def a2_media_kind(spark, sf_dir):
    return A.media_kind(v_files(spark, sf_dir)).select("path", "kind")


@register(
    "a3_shard_contiguous",
    with_views("v_files")
    + """SELECT path, CAST(row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS BIGINT) AS pos,
       CAST(ntile(7) OVER (ORDER BY string_split(path, '/')) - 1 AS INTEGER) AS shard
FROM v_files""",
)
def a3_shard_contiguous(spark, sf_dir):
    return A.shard_contiguous(v_files(spark, sf_dir).select("path"), 7)


@register(
    "a4_shard_round_robin",
    with_views("v_files")
    + """SELECT path, CAST(row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS BIGINT) AS pos,
       CAST((row_number() OVER (ORDER BY string_split(path, '/')) - 1) % 4 AS INTEGER) AS shard
FROM v_files""",
)
def a4_shard_round_robin(spark, sf_dir):
    return A.shard_round_robin(v_files(spark, sf_dir).select("path"), 4)


_A5_SQL = (
    with_views("v_files")
    + f""", o AS (SELECT path, doc_id, {sql_out_wav('path', '.wav')} AS out_path FROM v_files),
e AS (SELECT DISTINCT out_path FROM o WHERE doc_id % 2 = 0)
SELECT o.path, o.out_path, CASE WHEN e.out_path IS NOT NULL THEN 'skipped' ELSE 'todo' END AS status
FROM o LEFT JOIN e ON o.out_path = e.out_path"""
)


@register("a5_plan_worklist", _A5_SQL)
def a5_plan_worklist(spark, sf_dir):
    files = A.out_wav_path(v_files(spark, sf_dir))
    existing = files.where(F.col("doc_id") % 2 == 0).select("out_path")
    return A.plan_worklist(files, existing).select("path", "out_path", "status")


@register(
    "a5_todo_only",
    with_views("v_files")
    + f""", o AS (SELECT path, doc_id, {sql_out_wav('path', '.wav')} AS out_path FROM v_files)
SELECT path, out_path FROM o WHERE out_path NOT IN (SELECT out_path FROM o WHERE doc_id % 2 = 0)""",
)
def a5_todo_only(spark, sf_dir):
    files = A.out_wav_path(v_files(spark, sf_dir))
    existing = files.where(F.col("doc_id") % 2 == 0).select("out_path")
    return A.todo_only(files, existing).select("path", "out_path")


@register(
    "a6_out_wav_path",
    with_views("v_files") + f"SELECT path, {sql_out_wav('path', '.wav')} AS out_path FROM v_files",
)
def a6_out_wav_path(spark, sf_dir):
    return A.out_wav_path(v_files(spark, sf_dir)).select("path", "out_path")


@register(
    "a6_out_wav_path_segmented",
    with_views("v_files") + f"SELECT path, {sql_out_wav('path', '_%04d.wav')} AS out_path FROM v_files",
)
def a6_out_wav_path_segmented(spark, sf_dir):
    return A.out_wav_path(v_files(spark, sf_dir), segment=True).select("path", "out_path")


@register("a7_utt_id", with_views("v_files") + "SELECT path, translate(path, '/', '_') AS utt_id FROM v_files")
def a7_utt_id(spark, sf_dir):
    return A.with_utt_id(v_files(spark, sf_dir)).select("path", "utt_id")


@register(
    "a8_lab_path",
    with_views("v_files")
    + """SELECT path, lab_path, CASE WHEN lab_path = path THEN 'failed' ELSE 'ok' END AS status
FROM (SELECT path, regexp_replace(path, '(?s)^(.*)\\.wav', '\\1.lab') AS lab_path FROM v_files)""",
)
def a8_lab_path(spark, sf_dir):
    return A.lab_path(v_files(spark, sf_dir)).select("path", "lab_path", "status")


_SEG300_SQL = (
    with_views("v_infos")
    + """, segs AS (
  SELECT path, CAST(i AS BIGINT) AS seg_idx
  FROM v_infos, range(CAST(ceil(frames / (300.0 * rate)) AS BIGINT)) t(i))
"""
)


@register(
    "a9_segment_paths",
    _SEG300_SQL
    + f"""SELECT path, seg_idx, 'out/' || {sql_stem('path')} || '/' || {sql_stem('path')} || '_' || lpad(CAST(seg_idx AS VARCHAR), 4, '0') || '.wav' AS seg_path
FROM segs""",
)
def a9_segment_paths(spark, sf_dir):
    segs = segment_fixed(v_infos(spark, sf_dir), 300).select("path", "seg_idx")
    return A.segment_path(segs, "nested").select("path", "seg_idx", "seg_path")


@register(
    "a9_path_collisions",
    _SEG300_SQL
    + """SELECT 'out/' || lpad(CAST(seg_idx AS VARCHAR), 4, '0') || '.wav' AS seg_path, CAST(count(*) AS BIGINT) AS n_writes
FROM segs GROUP BY 1 HAVING count(*) > 1""",
)
def a9_path_collisions(spark, sf_dir):
    segs = segment_fixed(v_infos(spark, sf_dir), 300).select("path", "seg_idx")
    return A.path_collisions(A.segment_path(segs, "index"))


# ---------------------------------------------------------------- B1-B4
# every eleventh length makes a header that could not be read
_UNREADABLE_SQL = """, infos AS (
  SELECT path, lang, frames, channels, CASE WHEN frames // 1000 % 11 = 0 THEN NULL ELSE rate END AS rate FROM v_infos)
"""


def _unreadable(infos):
    return infos.withColumn("rate", F.when(F.expr("(frames div 1000) % 11") != 0, F.col("rate")))


@register(
    "b1_separation_eligibility",
    with_views("v_infos")
    + _UNREADABLE_SQL
    + """SELECT path, status, reason FROM (
  SELECT path,
         CASE WHEN rate IS NULL THEN 'failed'
              WHEN NOT (rate IN (44100, 48000) AND channels = 2) THEN 'skipped' ELSE 'todo' END AS status,
         CASE WHEN rate IS NULL THEN 'cannot read audio info'
              WHEN NOT (rate IN (44100, 48000) AND channels = 2)
              THEN 'current audio: ' || rate || 'Hz, ' || channels || 'ch, not accepted by the separator' END AS reason
  FROM infos)""",
)
def b1_separation_eligibility(spark, sf_dir):
    return B.eligible_for_separation(_unreadable(v_infos(spark, sf_dir))).select("path", "status", "reason")


@register(
    "b2_resample_guard",
    with_views("v_infos", "v_files")
    + _UNREADABLE_SQL
    + """, e AS (SELECT DISTINCT path AS out_path FROM v_files WHERE doc_id % 2 = 0)
SELECT path, CASE WHEN rate IS NULL OR rate < 44100 OR e.out_path IS NOT NULL THEN 'skipped' ELSE 'todo' END AS status,
       CASE WHEN rate IS NULL THEN 'file not found'
            WHEN rate < 44100 THEN 'sample rate too low: ' || rate || 'Hz'
            WHEN e.out_path IS NOT NULL THEN 'output exists' END AS reason
FROM infos LEFT JOIN e ON infos.path = e.out_path""",
)
def b2_resample_guard(spark, sf_dir):
    infos = _unreadable(v_infos(spark, sf_dir)).withColumn("out_path", F.col("path"))
    existing = v_files(spark, sf_dir).where(F.col("doc_id") % 2 == 0).select(F.col("path").alias("out_path"))
    return B.resample_guard(infos, 44100, existing=existing).select("path", "status", "reason")


_B3_SQL = """SELECT stage, CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS success,
       CAST(count(*) FILTER (WHERE status = 'skipped') AS BIGINT) AS skipped,
       CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed
FROM v_ledger GROUP BY stage"""


@register("b3_stage_summary", with_views("v_ledger") + _B3_SQL)
def b3_stage_summary(spark, sf_dir):
    return B.stage_summary(v_ledger(spark, sf_dir))


@register(
    "b3_stage_details",
    with_views("v_ledger") + "SELECT stage, status, file, reason FROM v_ledger WHERE status IN ('skipped', 'failed')",
)
def b3_stage_details(spark, sf_dir):
    return B.stage_details(v_ledger(spark, sf_dir))


@register("b4_merge_ledgers", with_views("v_ledger") + _B3_SQL)
def b4_merge_ledgers(spark, sf_dir):
    led = v_ledger(spark, sf_dir).withColumn("_shard", F.abs(F.hash("file")) % 3)
    shards = [led.where(F.col("_shard") == i).drop("_shard") for i in range(3)]
    return B.stage_summary(B.merge_ledgers(*shards))
