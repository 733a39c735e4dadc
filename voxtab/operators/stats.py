"""Corpus statistics: durations, histograms, pitch notes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.plans.scan import attach_one_row

# Pitch-class names with the sharp sign, C first.
NOTE_NAMES = ["C", "C♯", "D", "D♯", "E", "F", "F♯", "G", "G♯", "A", "A♯", "B"]


def media_infos(infos: DataFrame) -> DataFrame:
    """Frames, rate, seconds = frames / rate; unreadable rows dropped."""
    return infos.where(F.col("frames").isNotNull() & F.col("rate").isNotNull() & (F.col("rate") > 0)).withColumn(
        "seconds", F.col("frames") / F.col("rate")
    )


def duration_summary(infos: DataFrame) -> DataFrame:
    """Total hours, mean / max / min seconds, mean sample rate (nulls on
    empty input)."""
    return infos.agg(
        F.count(F.lit(1)).alias("n_files"),
        (F.sum("seconds") / 3600).alias("total_hours"),
        F.avg("seconds").alias("mean_seconds"),
        F.max("seconds").alias("max_seconds"),
        F.min("seconds").alias("min_seconds"),
        F.avg("rate").alias("mean_rate"),
    )


def longer_than(infos: DataFrame, t: float) -> DataFrame:
    """``seconds > t`` (strict), longest first."""
    return infos.where(F.col("seconds") > t).orderBy(F.col("seconds").desc(), "path")


def shorter_than(infos: DataFrame, t: float) -> DataFrame:
    """``seconds < t``, shortest first."""
    return infos.where(F.col("seconds") < t).orderBy(F.col("seconds").asc(), "path")


def duration_histogram(infos: DataFrame, bins: int = 100, col: str = "seconds") -> DataFrame:
    """E5: equal-width bins between min and max, last bin closed; every bin
    is returned (empty ones with count 0). When min = max the range is
    widened by 0.5 on both sides, as numpy does."""
    stats = infos.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    lo = F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn"))
    hi = F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx"))
    stats = stats.select(lo.alias("lo"), hi.alias("hi"))
    b = F.floor((F.col(col) - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    counts = (
        attach_one_row(infos.select(col), stats)
        .select(F.least(b, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = stats.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        "lo",
        "hi",
    ).select(
        "bin",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("bin_lo"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / bins).alias("bin_hi"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def hz_to_note(pitch: DataFrame, f0: str = "f0") -> DataFrame:
    """Drop 0, NaN and infinite pitch; midi = round-half-even of
    ``12·(log2 f − log2 440) + 69``; note name + octave."""
    f = F.col(f0)
    valid = f.isNotNull() & ~F.isnan(f) & (f != 0) & (f != float("inf")) & (f != float("-inf"))
    midi = F.bround(F.lit(12.0) * (F.log2(f) - F.log2(F.lit(440.0))) + 69).cast("bigint")
    names = F.array(*[F.lit(n) for n in NOTE_NAMES])
    note = F.concat(F.element_at(names, (F.pmod(midi, F.lit(12)) + 1).cast("int")),
                    (F.floor(midi / 12) - 1).cast("bigint").cast("string"))
    return pitch.where(valid).withColumn("midi", midi).withColumn("note", note)


def note_histogram(notes: DataFrame) -> DataFrame:
    """Note counts over the corpus, most frequent first (note name
    breaks ties)."""
    return notes.groupBy("note", "midi").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), "note")


def note_distribution(notes: DataFrame, min_share: float = 0.001) -> DataFrame:
    """Counts in pitch order with percentage; ``shown`` is false when the
    share is below 0.1 % (the label is left blank)."""
    counts = notes.groupBy("note", "midi").agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("_total"))
    out = attach_one_row(counts, total)
    share = F.col("cnt") / F.col("_total")
    return out.select(
        "note", "midi", "cnt", (share * 100).alias("pct"), (share >= min_share).alias("shown")
    ).orderBy("midi")
