"""Eligibility guards and the stage ledger.

The ledger is a long table ``(stage, file, status, reason)``; the nested log
of the reference (counters plus lists of ``{file, reason}``) is an aggregate
*view*: counts come from one hash aggregation, and the lists stay a long
table (``stage_details``) so that no stage's failures are ever packed into
one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def eligible_for_separation(infos: DataFrame, strict: bool = True) -> DataFrame:
    """B1: with ``strict``, keep rate in {44100, 48000} and 2 channels, else
    ``skipped`` with the reason; an unreadable header (null rate) is
    ``failed``."""
    ok = F.col("rate").isin(44100, 48000) & (F.col("channels") == 2)
    reason_skip = F.format_string("current audio: %dHz, %dch, not accepted by the separator", F.col("rate"), F.col("channels"))
    status = F.when(F.col("rate").isNull(), "failed")
    reason = F.when(F.col("rate").isNull(), F.lit("cannot read audio info"))
    if strict:
        status = status.when(~ok, "skipped")
        reason = reason.when(~ok, reason_skip)
    return infos.withColumn("status", status.otherwise("todo")).withColumn("reason", reason)


def resample_guard(infos: DataFrame, target: int, overwrite: bool = False, existing: DataFrame | None = None,
                   out: str = "out_path") -> DataFrame:
    """B2, in order: missing input -> skipped; ``rate < target`` -> skipped
    (never upsamples; equal rate goes through); output exists and not
    overwrite -> skipped; else todo."""
    df = infos
    exists = F.lit(False)
    if existing is not None:
        present = existing.select(F.col(out).alias("_present")).distinct()
        df = df.join(present, df[out] == present["_present"], "left")
        exists = F.col("_present").isNotNull()
    status = (
        F.when(F.col("rate").isNull(), "skipped")
        .when(F.col("rate") < target, "skipped")
        .when(exists & F.lit(not overwrite), "skipped")
        .otherwise("todo")
    )
    reason = (
        F.when(F.col("rate").isNull(), F.lit("file not found"))
        .when(F.col("rate") < target, F.format_string("sample rate too low: %dHz", F.col("rate")))
        .when(exists & F.lit(not overwrite), F.lit("output exists"))
    )
    df = df.withColumn("status", status).withColumn("reason", reason)
    return df.drop("_present") if existing is not None else df


def stage_summary(ledger: DataFrame) -> DataFrame:
    """B3 counters: total = success + skipped + failed always holds."""
    s = F.col("status")
    return ledger.groupBy("stage").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "success").alias("success"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count_if(s == "failed").alias("failed"),
    )


def stage_details(ledger: DataFrame) -> DataFrame:
    """B3 lists, as a long table: one row per skipped or failed file."""
    return ledger.where(F.col("status").isin("skipped", "failed")).select("stage", "status", "file", "reason")


def merge_ledgers(*ledgers: DataFrame, stage: str | None = None) -> DataFrame:
    """Union of shard ledgers (optionally renamed to one stage); counters
    add up and lists concatenate by construction."""
    merged = reduce(lambda a, b: a.unionByName(b), ledgers)
    if stage is not None:
        merged = merged.withColumn("stage", F.lit(stage))
    return merged
