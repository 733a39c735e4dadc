"""Interval operators on recordings: fixed and even splits, VAD padding,
speech intervals, embedding chunks, loop padding and scoring windows.

Segments are intervals ``[start, end)`` in samples, never copies of audio.
Per-recording expansion uses ``sequence`` + ``posexplode`` (bounded by the
recording's own length); ordering questions go through the distributed scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.plans.chain import chain_walk, successor
from voxtab.plans.scan import ordered_scan
from voxtab.session import cut_lineage


def segment_fixed(infos: DataFrame, seconds: float, frames: str = "frames", rate: str = "rate") -> DataFrame:
    """Consecutive segments of ``seconds`` (0 = one segment, the whole
    recording). Adds ``seg_idx``, ``start``, ``end`` in samples."""
    n = F.col(frames)
    if not seconds:
        return infos.withColumn("seg_idx", F.lit(0).cast("bigint")).withColumn("start", F.lit(0).cast("bigint")).withColumn(
            "end", n.cast("bigint")
        )
    seg_len = (F.lit(float(seconds)) * F.col(rate)).cast("double")
    count = F.ceil(n / seg_len).cast("bigint")
    # an empty recording has no segment (sequence(0, -1) would count down)
    out = infos.where(n > 0).withColumn("_segs", F.sequence(F.lit(0).cast("bigint"), count - 1)).select(
        "*", F.explode("_segs").alias("seg_idx")
    )
    start = F.floor(F.col("seg_idx") * seg_len).cast("bigint")
    end = F.least(F.floor((F.col("seg_idx") + 1) * seg_len).cast("bigint"), n.cast("bigint"))
    return out.withColumn("start", start).withColumn("end", end).drop("_segs")


def split_by_max(segs: DataFrame, max_s: float, rate="rate", start: str = "start", end: str = "end") -> DataFrame:
    """A segment longer than ``max_s`` seconds (strictly) is split evenly:
    ``n = ceil(len / (max·rate))``, ``chunk = ceil(len / n)``, cut every
    ``chunk`` samples, the last piece shorter. Adds ``piece_idx`` and
    replaces ``start``/``end`` by the piece bounds."""
    rate_c = F.col(rate) if isinstance(rate, str) else F.lit(rate)
    length = (F.col(end) - F.col(start)).cast("bigint")
    limit = F.lit(float(max_s)) * rate_c
    n = F.when(length > limit, F.ceil(length / limit)).otherwise(F.lit(1)).cast("bigint")
    chunk = F.when(length > limit, F.ceil(length / n)).otherwise(F.greatest(length, F.lit(1))).cast("bigint")
    out = segs.withColumn("_len", length).withColumn("_chunk", chunk).withColumn(
        "_k", F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("_len") / F.col("_chunk")).cast("bigint") - 1, F.lit(0).cast("bigint")))
    )
    out = out.select("*", F.explode("_k").alias("piece_idx"))
    new_start = F.col(start) + F.col("piece_idx") * F.col("_chunk")
    new_end = F.least(new_start + F.col("_chunk"), F.col(end))
    return out.withColumn("_ns", new_start).withColumn("_ne", new_end).drop(start, end, "_len", "_chunk", "_k").withColumnRenamed(
        "_ns", start
    ).withColumnRenamed("_ne", end)


def pad_intervals(segs: DataFrame, key, rate, total: str = "total", extend: float = 0.3, head: float = 2.5,
                  start: str = "start", end: str = "end") -> DataFrame:
    """Pad speech intervals: the first interval of a recording starts
    ``head`` seconds earlier, later ones ``extend`` earlier; every end moves
    ``extend`` later; clamp to ``[0, total/rate]`` seconds; truncate to
    samples. Neighbours may overlap after padding. ``total`` is the
    recording length in samples."""
    keys = [key] if isinstance(key, str) else list(key)
    rate_c = F.col(rate) if isinstance(rate, str) else F.lit(float(rate))
    firsts = segs.groupBy(*keys).agg(F.min(start).alias("_first"))
    j = segs.join(firsts, keys)
    pad = F.when(F.col(start) == F.col("_first"), F.lit(float(head))).otherwise(F.lit(float(extend)))
    start_sec = F.greatest(F.lit(0.0), F.col(start) / rate_c - pad)
    end_sec = F.least(F.col(total) / rate_c, F.col(end) / rate_c + F.lit(float(extend)))
    return j.withColumn("pad_start", (start_sec * rate_c).cast("bigint")).withColumn(
        "pad_end", (end_sec * rate_c).cast("bigint")
    ).drop("_first")


def runs_of(flags: DataFrame, key, idx: str, flag: str) -> DataFrame:
    """Maximal runs of rows with ``flag`` true over a dense index: one row per
    run ``(key, run_start, run_end)`` with ``run_end`` exclusive. A run is
    identified by the number of non-flag rows before it (a prefix count from
    the distributed scan), then grouped with partial aggregation."""
    keys = [key] if isinstance(key, str) else list(key)
    marked = flags.withColumn("_off", F.when(F.col(flag), 0).otherwise(1).cast("bigint"))
    scanned = ordered_scan(marked.select(*keys, idx, flag, "_off"), keys, [idx], sums=["_off"])
    return (
        scanned.where(F.col(flag))
        .groupBy(*keys, F.col("cum__off").alias("_run"))
        .agg(F.min(idx).alias("run_start"), (F.max(idx) + 1).alias("run_end"))
        .drop("_run")
    )


def speech_intervals(probs: DataFrame, key, idx: str = "frame_idx", prob: str = "prob", threshold: float = 0.5,
                     min_speech: int = 5, max_speech: int | None = None, min_silence: int = 3) -> DataFrame:
    """C14 (re-aimed): speech intervals from per-frame speech probability:
    runs of ``prob >= threshold``; gaps shorter than ``min_silence`` frames
    are closed; intervals shorter than ``min_speech`` frames are dropped;
    longer than ``max_speech`` frames are split evenly (C2)."""
    keys = [key] if isinstance(key, str) else list(key)
    # each scan samples its input for range bounds: materialise the (small)
    # run tables between scans instead of re-running the scan below
    runs = cut_lineage(runs_of(probs.withColumn("_sp", F.col(prob) >= threshold), keys, idx, "_sp"))
    scanned = cut_lineage(ordered_scan(runs, keys, ["run_start"], prevs=["run_end"]))
    new_grp = (F.col("prev_run_end").isNull() | (F.col("run_start") - F.col("prev_run_end") >= min_silence)).cast("bigint")
    grouped = ordered_scan(scanned.withColumn("_new", new_grp).drop("pos", "prev_run_end"), keys, ["run_start"], sums=["_new"])
    merged = grouped.groupBy(*keys, "cum__new").agg(F.min("run_start").alias("start"), F.max("run_end").alias("end")).drop("cum__new")
    kept = merged.where(F.col("end") - F.col("start") >= min_speech)
    if max_speech:
        kept = split_by_max(kept, float(max_speech), rate=1.0)
        kept = kept.drop("piece_idx")
    return kept


def resampled_length(frames, rate, target: int):
    """Length after rate conversion: ``ceil(n · target / rate)``."""
    return F.ceil(F.col(frames) * F.lit(float(target)) / F.col(rate)).cast("bigint")


def chunk_tumbling(infos: DataFrame, length: str = "n", rate=16000, chunk_s: float = 2.0, min_s: float = 1.0) -> DataFrame:
    """Tumbling chunks of ``int(chunk_s·rate)`` samples from 0; a chunk
    shorter than ``int(min_s·rate)`` samples is dropped."""
    rate_c = F.col(rate) if isinstance(rate, str) else F.lit(rate)
    size = (F.lit(float(chunk_s)) * rate_c).cast("bigint")
    min_len = (F.lit(float(min_s)) * rate_c).cast("bigint")
    n = F.col(length)
    out = infos.withColumn("_size", size).withColumn("_min", min_len).withColumn(
        "_k", F.sequence(F.lit(0).cast("bigint"), F.ceil(n / F.col("_size")).cast("bigint") - 1)
    )
    out = out.where(n > 0).select("*", F.explode("_k").alias("chunk_idx"))
    start = F.col("chunk_idx") * F.col("_size")
    end = F.least(start + F.col("_size"), n)
    return out.withColumn("start", start).withColumn("end", end).where(F.col("end") - F.col("start") >= F.col("_min")).drop(
        "_size", "_min", "_k"
    )


def loop_pad(infos: DataFrame, length: str = "n", rate=16000, seconds: float = 9.01) -> DataFrame:
    """Double the recording until it holds ``int(seconds·rate)``
    samples (integer-exact doubling count); an empty recording would loop
    forever in the reference and gets status ``failed`` here."""
    rate_c = F.col(rate) if isinstance(rate, str) else F.lit(rate)
    need = (F.lit(float(seconds)) * rate_c).cast("bigint")
    n = F.col(length).cast("bigint")
    doublings = F.aggregate(
        F.sequence(F.lit(1), F.lit(62)),
        F.struct(n.alias("len"), F.lit(0).cast("bigint").alias("k")),
        lambda acc, _: F.when(acc["len"] < need, F.struct((acc["len"] * 2).alias("len"), (acc["k"] + 1).alias("k"))).otherwise(acc),
    )
    return (
        infos.withColumn("_d", F.when(n > 0, doublings))
        .withColumn("padded", F.col("_d")["len"])
        .withColumn("doublings", F.col("_d")["k"])
        .withColumn("status", F.when(n > 0, "ok").otherwise("failed"))
        .drop("_d")
    )


def sliding_hops(padded: DataFrame, length: str = "padded", rate=16000, width_s: float = 9.01, hop_s: float = 1.0) -> DataFrame:
    """C17: ``floor(len/rate − width) + 1`` windows of ``width`` seconds every
    ``hop`` seconds; a window shorter than ``int(width·rate)`` is dropped."""
    rate_c = F.col(rate) if isinstance(rate, str) else F.lit(float(rate))
    n = F.col(length)
    hops = (F.floor(n / rate_c - F.lit(float(width_s))) + 1).cast("bigint")
    hop_len = F.lit(float(hop_s)) * rate_c
    need = (F.lit(float(width_s)) * rate_c).cast("bigint")
    out = padded.where(n.isNotNull() & (hops > 0)).withColumn("_k", F.sequence(F.lit(0).cast("bigint"), hops - 1)).select(
        "*", F.explode("_k").alias("hop_idx")
    )
    start = (F.col("hop_idx") * hop_len).cast("bigint")
    end = F.least(((F.col("hop_idx") + F.lit(float(width_s))) * hop_len).cast("bigint"), n)
    return out.withColumn("start", start).withColumn("end", end).where(F.col("end") - F.col("start") >= need).drop("_k")


def _lit_or_col(x):
    from pyspark.sql import Column

    return x if isinstance(x, Column) else F.lit(float(x))


def merge_short(segs: DataFrame, max_len, key="utt_id", order=("start",), compat: bool = True,
                length: str | None = None) -> DataFrame:
    """C11: merge consecutive short segments in order: a segment joins the
    current group unless ``count + len > max_len`` (and the group is not
    empty); then the group is flushed and the segment starts a new one.
    With ``compat`` the counter restarts at 0 after a flush (the first
    segment of a later group is not counted, as in the reference); without
    it the counter restarts at the segment's length.

    Prefix sums give, for every possible group start ``a``, the first segment
    that overflows it (a strict successor search); the group starts are the
    chain reachable from the first segment.
    Returns one row per group: ``(key, grp, n_pieces, length[, start, end])``
    (``start``/``end`` of the first and last member)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    seg_len = F.col(length) if length else (F.col("end") - F.col("start"))
    extra = [c for c in ("start", "end") if c in segs.columns and c not in order]
    base = segs.select(*keys, *order, *extra, seg_len.cast("bigint").alias("_len"),
                       _lit_or_col(max_len).cast("double").alias("_max"))
    rows = _merge_rows(base, keys, order, compat)
    aggs = [F.count(F.lit(1)).alias("n_pieces"), F.sum("_len").alias("length")]
    if "start" in segs.columns and "end" in segs.columns:
        first = F.struct(*[F.col(c) for c in order])
        aggs += [F.min_by("start", first).alias("start"), F.max_by("end", first).alias("end")]
    return rows.groupBy(*keys, "grp").agg(*aggs)


def _merge_rows(base: DataFrame, keys, order, compat) -> DataFrame:
    """``base`` plus ``grp``, the number of each row's merge group."""
    sc = cut_lineage(ordered_scan(base, keys, order, sums=["_len"]))
    points = sc.select(*keys, F.col("cum__len").alias("value"), F.col("pos").alias("pid"))
    counted_from = F.when(F.lit(compat) & (F.col("pos") > 0), F.col("cum__len")).otherwise(F.col("cum__len") - F.col("_len"))
    queries = sc.select(*keys, F.col("pos").alias("qid"), (counted_from + F.col("_max")).alias("value"))
    found = successor(points, queries, keys, strict=True)
    nxt = found.select(*keys, F.col("qid").alias("node"),
                       F.when(F.col("pid").isNotNull(), F.greatest(F.col("pid"), F.col("qid") + 1)).alias("next"))
    starts = sc.where(F.col("pos") == 0).select(*keys, F.col("pos").alias("node"))
    heads = chain_walk(nxt, starts, keys).select(*keys, F.col("node").alias("pos"), F.lit(1).cast("bigint").alias("_head"))
    flagged = sc.join(heads, [*keys, "pos"], "left").withColumn("_head", F.coalesce("_head", F.lit(0)).cast("bigint"))
    flagged = flagged.drop("cum__len").withColumnRenamed("pos", "_i")
    grouped = ordered_scan(flagged, keys, ["_i"], sums=["_head"]).withColumn("grp", F.col("cum__head") - 1)
    return grouped.select(*base.columns, "grp")


def merge_short_corpus(infos: DataFrame, max_s: float = 20.0, key=("lang", "rate"), order: str = "path",
                       length: str = "frames", rate: str = "rate") -> DataFrame:
    """Merge a whole directory of short files in path order. The
    reference loads every file of the directory into one list and merges
    globally; here the merge runs per ``key`` (all rates inside a key must
    be equal, else the job fails) so that it scales. Lengths count frames
    (not channels)."""
    keys = list(key) if not isinstance(key, str) else [key]
    check = infos.groupBy(*keys).agg(F.countDistinct(rate).alias("_rates"))
    guarded = infos.join(check, keys).withColumn(
        "_ok", F.when(F.col("_rates") > 1, F.raise_error(F.lit("sample rates differ inside a merge key"))).otherwise(F.lit(True))
    ).where(F.col("_ok")).drop("_ok", "_rates")
    guarded = guarded.withColumn("_order", F.split(order, "/"))
    return merge_short(guarded, F.col(rate) * float(max_s), key=keys, order=["_order"], length=length)


def accumulate_min(intervals: DataFrame, min_len, pad_len: int, key="utt_id", order=("start",)) -> DataFrame:
    """Greedy accumulation of non-silent intervals in order until their
    total length reaches ``min_len`` samples; the group is emitted and the
    counter reset. Between unfinished pieces ``pad_len`` zero samples are
    inserted (also after the last piece of an unfinished final group).

    Returns one row per interval: ``(key, start, end, grp, pad_after)`` and
    the group lengths are ``sum(end - start + pad_after)``; see
    ``accumulated_groups``. Group starts are the chain of successors, as in
    ``merge_short``."""
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    extra = [c for c in order if c not in ("start", "end")]
    base = intervals.select(*keys, "start", "end", *extra, (F.col("end") - F.col("start")).cast("bigint").alias("_len"))
    sc = cut_lineage(ordered_scan(base, keys, list(order), sums=["_len"]))
    points = sc.select(*keys, F.col("cum__len").alias("value"), F.col("pos").alias("pid"))
    queries = sc.select(*keys, F.col("pos").alias("qid"), (F.col("cum__len") - F.col("_len") + _lit_or_col(min_len)).alias("value"))
    found = cut_lineage(successor(points, queries, keys, strict=False))
    nxt = found.select(*keys, F.col("qid").alias("node"), (F.col("pid") + 1).alias("next"))
    starts = sc.where(F.col("pos") == 0).select(*keys, F.col("pos").alias("node"))
    heads = chain_walk(nxt, starts, keys)
    # a group starting at a ends at its successor j (complete) or runs to
    # the end of the recording (unfinished)
    ends = heads.join(found.withColumnRenamed("qid", "node"), [*keys, "node"]).select(
        *keys, F.col("node").alias("pos"), F.col("pid").alias("_last")
    )
    flagged = sc.join(ends.withColumn("_head", F.lit(1).cast("bigint")), [*keys, "pos"], "left").withColumn(
        "_head", F.coalesce("_head", F.lit(0)).cast("bigint")
    )
    flagged = flagged.drop("cum__len").withColumnRenamed("pos", "_i")
    grouped = ordered_scan(flagged, keys, ["_i"], sums=["_head"], ffills=["_last"])
    pad_after = F.when(F.col("ffill__last").isNotNull() & (F.col("_i") == F.col("ffill__last")), F.lit(0)).otherwise(F.lit(pad_len))
    return grouped.select(*keys, "start", "end", (F.col("cum__head") - 1).alias("grp"), pad_after.cast("bigint").alias("pad_after"))


def slice_accumulated(intervals: DataFrame, totals: DataFrame, min_len: int, pad_len: int, max_len: int, key="utt_id") -> DataFrame:
    """The first slicer as a whole. A recording of fewer than ``min_len``
    samples goes to the even split (C2) as it is; of others the non-silent
    ``intervals`` are accumulated (C5), each group is one line of sound and
    inserted silence, and lines longer than ``max_len`` are split evenly.

    ``totals (key, n)``. Returns the pieces that make up each segment:
    ``(key, seg_idx, at, length, src_start)``, at place ``at`` of the segment
    ``length`` samples from ``src_start`` on, or that many zeros where it is
    null. A line is a piecewise map from its own coordinates to the source,
    so the split needs no samples; a group's offsets come from the distributed
    scan."""
    keys = [key] if isinstance(key, str) else list(key)
    short = totals.where((F.col("n") < min_len) & (F.col("n") > 0))
    long = intervals.join(totals.where(F.col("n") >= min_len).select(*keys), keys, "left_semi")
    zero = F.lit(0).cast("bigint")
    members = accumulate_min(long, min_len, pad_len, key).withColumn("span", F.col("end") - F.col("start") + F.col("pad_after"))
    placed = ordered_scan(members, [*keys, "grp"], ["start"], sums=["span"])
    placed = placed.select(*keys, "grp", "start", "end", "pad_after", (F.col("cum_span") - F.col("span")).alias("off"))
    whole = short.select(*keys, zero.alias("grp"), zero.alias("start"), F.col("n").cast("bigint").alias("end"), zero.alias("pad_after"), zero.alias("off"))
    placed = cut_lineage(placed.unionByName(whole))
    size = F.max(F.col("off") + F.col("end") - F.col("start") + F.col("pad_after"))
    lines = placed.groupBy(*keys, "grp").agg(size.alias("_size"))
    cuts = F.when(F.col("_size") > max_len, F.ceil(F.col("_size") / max_len)).otherwise(1)
    lines = lines.withColumn("_chunk", F.ceil(F.col("_size") / cuts).cast("bigint"))
    lines = lines.withColumn("_segs", F.ceil(F.col("_size") / F.col("_chunk")).cast("bigint"))
    numbered = ordered_scan(lines, keys, ["grp"], sums=["_segs"])
    numbered = numbered.select(*keys, "grp", "_chunk", (F.col("cum__segs") - F.col("_segs")).alias("_base"))
    sound = placed.select(*keys, "grp", F.col("off").alias("_lo"), (F.col("off") + F.col("end") - F.col("start")).alias("_hi"), F.col("start").alias("_src"))
    silence = placed.where("pad_after > 0").select(
        *keys, "grp", (F.col("off") + F.col("end") - F.col("start")).alias("_lo"),
        (F.col("off") + F.col("end") - F.col("start") + F.col("pad_after")).alias("_hi"), F.lit(None).cast("bigint").alias("_src"),
    )
    spans = sound.unionByName(silence).where("_hi > _lo").join(numbered, [*keys, "grp"])
    first, last = F.floor(F.col("_lo") / F.col("_chunk")), F.floor((F.col("_hi") - 1) / F.col("_chunk"))
    parts = spans.withColumn("_j", F.explode(F.sequence(first, last)))
    lo, hi = F.greatest("_lo", F.col("_j") * F.col("_chunk")), F.least("_hi", (F.col("_j") + 1) * F.col("_chunk"))
    return parts.select(
        *keys, (F.col("_base") + F.col("_j")).alias("seg_idx"), (lo - F.col("_j") * F.col("_chunk")).alias("at"), (hi - lo).alias("length"),
        (F.col("_src") + lo - F.col("_lo")).alias("src_start"),
    )


def accumulated_groups(members: DataFrame, key="utt_id") -> DataFrame:
    """C5 groups: ``(key, grp, n_intervals, length)`` with pads counted."""
    keys = [key] if isinstance(key, str) else list(key)
    return members.groupBy(*keys, "grp").agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.sum(F.col("end") - F.col("start") + F.col("pad_after")).alias("length"),
    )
