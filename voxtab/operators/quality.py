"""Quality-score calibration, per-file scores, pass/fail split and
report. Everything is column arithmetic and hash aggregation with map-side
partial aggregation; the only global statistic (median) is an exact
distributed order statistic, not a one-task percentile buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.functions.columns import horner
from voxtab.plans.scan import exact_median

# Fixed values (must equal the reference's calibration): polynomial
# coefficients, highest power first, for raw SIG, BAK and OVRL.
STANDARD_POLY = {
    "sig": [-0.08397278, 1.22083953, 0.0052439],
    "bak": [-0.13166888, 1.60915514, -0.39604546],
    "ovr": [-0.06766283, 1.11546468, 0.04602535],
}
PERSONALISED_POLY = {
    "sig": [-0.01019296, 0.02751166, 1.19576786, -0.24348726],
    "bak": [-0.04976499, 0.44276479, -0.1644611, 0.96883132],
    "ovr": [-0.00533021, 0.005101, 1.18058466, -0.11236046],
}


def calibrate(hops: DataFrame, personalised: bool = False) -> DataFrame:
    """G1: replace raw sig/bak/ovr by their calibrated values; p808 as is."""
    polys = PERSONALISED_POLY if personalised else STANDARD_POLY
    return hops.withColumns({c: horner(F.col(c), coefs) for c, coefs in polys.items()})


def score_files(hops: DataFrame, files: DataFrame | None = None, key: str = "file") -> DataFrame:
    """Mean of the calibrated hop values per file, 0 when a file has no
    valid hop, ``valid_hops`` = number of hops; ``duration`` is the padded
    length (``seconds`` column of the hop table or of ``files``)."""
    agg = hops.groupBy(key).agg(
        F.first("seconds").alias("_hop_seconds"),
        F.avg("sig").alias("SIG"),
        F.avg("bak").alias("BAK"),
        F.avg("ovr").alias("OVRL"),
        F.avg("p808").alias("P808_MOS"),
        F.count(F.lit(1)).alias("valid_hops"),
    )
    if files is not None:
        agg = files.select(key, F.col("seconds").alias("_file_seconds")).join(agg, key, "left")
        duration = F.coalesce("_file_seconds", "_hop_seconds")
    else:
        duration = F.col("_hop_seconds")
    return agg.select(
        F.col(key).cast("string").alias("audio_filepath"),
        duration.cast("double").alias("duration"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("SIG", "BAK", "OVRL", "P808_MOS")],
        F.coalesce(F.col("valid_hops"), F.lit(0)).cast("bigint").alias("valid_hops"),
    )


def split_by_quality(scores: DataFrame, threshold: float | None) -> DataFrame:
    """``verdict`` = pass if OVRL >= threshold else fail; null without a
    threshold (neither manifest gets the row)."""
    if threshold is None:
        verdict = F.lit(None).cast("string")
    else:
        verdict = F.when(F.col("OVRL") >= F.lit(float(threshold)), "pass").otherwise("fail")
    return scores.withColumn("verdict", verdict)


def quality_totals(verdicts: DataFrame) -> DataFrame:
    """Count and total duration of pass and of fail."""
    return (
        verdicts.where(F.col("verdict").isNotNull())
        .groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("duration").alias("total_seconds"))
    )


def quality_report(scores: DataFrame) -> DataFrame:
    """Mean and median OVRL, duration of files with OVRL strictly above
    the median, and its share of the total duration in percent (0 when the
    total is 0). One row; empty input gives nulls."""
    one = F.lit(0).alias("_k")
    med = exact_median(scores, "OVRL").select(one, F.col("median").alias("median_ovrl"))
    totals = scores.groupBy(one).agg(
        F.avg("OVRL").alias("mean_ovrl"),
        F.sum("duration").alias("total_seconds"),
    )
    # the median side is one row: broadcasting it is bounded by construction
    above = (
        scores.select(one, "OVRL", "duration")
        .join(F.broadcast(med), "_k")
        .where(F.col("OVRL") > F.col("median_ovrl"))
        .groupBy("_k")
        .agg(F.sum("duration").alias("above_seconds"))
    )
    above_s = F.coalesce("above_seconds", F.lit(0.0))
    total = F.col("total_seconds")
    return (
        totals.join(med, "_k", "left")
        .join(above, "_k", "left")
        .select(
            "mean_ovrl",
            "median_ovrl",
            above_s.alias("above_median_seconds"),
            "total_seconds",
            F.when(total > 0, above_s / total * 100).otherwise(F.lit(0.0)).alias("above_median_pct"),
        )
    )
