"""Sinks A10-A14 and the stage log writer. All writes are Spark writers
(partitioned, distributed) or the line sink of ``voxtab.sources.lines``;
nothing is gathered to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.sources.lines import write_lines

SCORE_COLUMNS = ["audio_filepath", "duration", "SIG", "BAK", "OVRL", "P808_MOS", "valid_hops"]


def assigned_clips(clips: DataFrame, assignment: DataFrame, key: str = "utt_id") -> DataFrame:
    """A10: the clips of assigned utterances with their speaker, each as often
    as it is in ``clips``: repeated assignments count once, and an utterance
    with two speakers fails the job."""
    one = assignment.groupBy(key).agg(F.min("spk").alias("spk"), F.max("spk").alias("_other"))
    clash = F.raise_error(F.concat(F.lit("two speakers for "), F.col(key).cast("string")))
    one = one.select(key, F.when(F.col("spk") != F.col("_other"), clash).otherwise(F.col("spk")).alias("spk"))
    return clips.join(one, key)


def write_by_speaker(clips: DataFrame, assignment: DataFrame, path: str, key: str = "utt_id", mode: str = "overwrite",
                     files: int | None = None) -> None:
    """A10: one directory per speaker with the clips of assigned utterances
    only. With ``files`` every speaker gets at most that many files, its clips
    dealt by hash, so that a speaker with a third of all clips is written by
    as many tasks."""
    j = assigned_clips(clips, assignment, key)
    if files:
        j = j.withColumn("_file", F.pmod(F.xxhash64(key), F.lit(files))).repartition("spk", "_file").drop("_file")
    j.write.mode(mode).partitionBy("spk").parquet(path)


def write_scores_csv(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Score table as CSV with a header."""
    scores.select(*SCORE_COLUMNS).write.mode(mode).option("header", True).csv(path)


def manifest_lines(verdicts: DataFrame) -> DataFrame:
    """One JSON object per scored row, with its verdict."""
    return verdicts.select("verdict", F.to_json(F.struct(*SCORE_COLUMNS)).alias("value"))


def write_manifests(verdicts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``filter_pass.manifest`` and ``filter_fail.manifest`` as JSON
    lines; both are always written (empty without a threshold)."""
    lines = manifest_lines(verdicts).persist()  # the plan runs once for both files
    try:
        for verdict in ("pass", "fail"):
            lines.where(F.col("verdict") == verdict).select("value").write.mode(mode).text(f"{path}/filter_{verdict}.manifest")
    finally:
        lines.unpersist()


def write_manifests_at_once(verdicts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A12 by one job, all or nothing (``voxtab.sources.lines``): both
    manifests appear together, and a failing task leaves earlier ones as they
    were. For paths that Arrow opens; ``write_manifests`` takes any that
    Spark does."""
    lines = manifest_lines(verdicts).where(F.col("verdict").isin("pass", "fail"))
    named = lines.select(F.format_string("filter_%s.manifest", "verdict").alias("output"), "value")
    write_lines(named, path, ["filter_pass.manifest", "filter_fail.manifest"], mode)


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Verdicts / speaker map as JSON lines (one row per utterance, not
    one document)."""
    df.write.mode(mode).json(path)


def write_transcripts(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Transcripts ``(path, text)`` as a table."""
    df.select("path", "text").write.mode(mode).parquet(path)


def write_stage_log(ledger: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B3 log: counters per stage and the skipped/failed rows, as two JSON
    tables (the lists stay long, never one document)."""
    from voxtab.operators.ledger import stage_details, stage_summary

    stage_summary(ledger).write.mode(mode).json(f"{path}/summary")
    stage_details(ledger).write.mode(mode).partitionBy("stage").json(f"{path}/details")
