"""Worklists over file tables (path strings), sharding, skip-existing,
output naming. Pure column expressions and joins; the two sharding
operators number rows with the distributed scan, not a one-partition
window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.functions.columns import col_, file_name, parent_dir, path_sort_key, replace_last, stem, suffix, utt_id
from voxtab.plans.scan import attach_one_row, ordered_scan

# Fixed values (must equal the reference's media-kind sets; suffix match is
# case-sensitive).
VIDEO_EXTENSIONS = [".mp4", ".avi", ".flv", ".mov", ".wmv", ".webm", ".mpg", ".mpeg", ".m4v"]
AUDIO_EXTENSIONS = [".mp3", ".wav", ".flac", ".ogg", ".m4a", ".wma", ".aac", ".aiff", ".aif", ".aifc"]


def filter_extensions(files: DataFrame, exts, path: str = "path") -> DataFrame:
    """Keep rows whose last suffix is in ``exts`` (case-sensitive)."""
    return files.where(suffix(path).isin(list(exts)))


def media_kind(files: DataFrame, path: str = "path") -> DataFrame:
    """A2: ``kind`` = audio / video / other by suffix."""
    s = suffix(path)
    kind = (
        F.when(s.isin(AUDIO_EXTENSIONS), "audio").when(s.isin(VIDEO_EXTENSIONS), "video").otherwise("other")
    )
    return files.withColumn("kind", kind)


def with_position(files: DataFrame, order=("path",), name: str = "pos") -> DataFrame:
    """0-based global position in path order (``pathlib`` order for paths)."""
    keyed = files.withColumn("_ord", path_sort_key(order[0]) if order[0] == "path" else col_(order[0]))
    extra = list(order[1:])
    out = ordered_scan(keyed.withColumn("_g", F.lit(0)), ["_g"], ["_ord", *extra])
    return out.drop("_g", "_ord").withColumnRenamed("pos", name) if name != "pos" else out.drop("_g", "_ord")


def shard_contiguous(files: DataFrame, n: int, order=("path",)) -> DataFrame:
    """A3: ``n`` contiguous near-even shards (divmod rule: the first
    ``N % n`` shards hold one more row)."""
    pos = with_position(files, order)
    total = files.agg(F.count(F.lit(1)).alias("_N"))
    k = F.floor(F.col("_N") / n)
    m = F.col("_N") % n
    p = F.col("pos")
    shard = F.when(p < m * (k + 1), F.floor(p / (k + 1))).otherwise(m + F.floor((p - m * (k + 1)) / k))
    return attach_one_row(pos, total).withColumn("shard", shard.cast("int")).drop("_N")


def shard_round_robin(files: DataFrame, n: int, order=("path",)) -> DataFrame:
    """A4: shard = position % n."""
    return with_position(files, order).withColumn("shard", (F.col("pos") % n).cast("int"))


def out_wav_path(files: DataFrame, segment: bool = False, path: str = "path", out: str = "out_path") -> DataFrame:
    """Output path keeps the relative directory; every occurrence of the
    suffix in the file name is replaced by ``.wav`` (or ``_%04d.wav`` when
    segmenting)."""
    name = file_name(path)
    repl = F.lit("_%04d.wav" if segment else ".wav")
    new_name = F.replace(name, suffix(path), repl)
    parent = parent_dir(path)
    return files.withColumn(out, F.when(parent == "", new_name).otherwise(F.concat_ws("/", parent, new_name)))


def plan_worklist(files: DataFrame, existing: DataFrame, overwrite: bool = False, out: str = "out_path") -> DataFrame:
    """A5: ``skipped`` when the output exists and overwrite is off, else
    ``todo``. ``existing`` holds a column ``out_path`` of present outputs."""
    present = existing.select(F.col(out).alias("_present")).distinct()
    j = files.join(present, files[out] == present["_present"], "left")
    status = F.when(F.col("_present").isNotNull() & F.lit(not overwrite), "skipped").otherwise("todo")
    return j.withColumn("status", status).drop("_present")


def todo_only(files: DataFrame, existing: DataFrame, out: str = "out_path") -> DataFrame:
    """A5, pure worklist form: anti join against present outputs."""
    return files.join(existing.select(out).distinct(), out, "left_anti")


def with_utt_id(files: DataFrame, rel: str = "path", name: str = "utt_id") -> DataFrame:
    """A7."""
    return files.withColumn(name, utt_id(rel))


def lab_path(files: DataFrame, path: str = "path") -> DataFrame:
    """Transcript path = last ``.wav`` replaced by ``.lab``; a path with
    no ``.wav`` would be written over by text in the reference, so it gets
    status ``failed`` here."""
    lab = replace_last(path, ".wav", ".lab")
    return files.withColumn("lab_path", lab).withColumn(
        "status", F.when(F.col("lab_path") == F.col(path), "failed").otherwise("ok")
    )


def segment_path(segs: DataFrame, layout: str = "nested", out_root: str = "out", path: str = "path",
                 idx: str = "seg_idx") -> DataFrame:
    """Segment file names. ``nested``: ``{out}/{stem}/{stem}_{idx:04d}.wav``;
    ``flat``: ``{out}/{stem}_{idx:04d}.wav``; ``index`` (older form):
    ``{out}/{idx:04d}.wav``; ``relative``: keeps the relative directory."""
    st = stem(path)
    name = F.format_string("%s_%04d.wav", st, F.col(idx))
    if layout == "nested":
        p = F.concat_ws("/", F.lit(out_root), st, name)
    elif layout == "flat":
        p = F.concat_ws("/", F.lit(out_root), name)
    elif layout == "index":
        p = F.concat_ws("/", F.lit(out_root), F.format_string("%04d.wav", F.col(idx)))
    elif layout == "relative":
        parent = parent_dir(path)
        p = F.concat_ws("/", F.lit(out_root), F.when(parent == "", F.lit(None)).otherwise(parent), st, name)
    else:
        raise ValueError(layout)
    return segs.withColumn("seg_path", p)


def path_collisions(segs: DataFrame, col: str = "seg_path") -> DataFrame:
    """Output names written more than once (silently overwritten by the
    reference)."""
    return segs.groupBy(col).agg(F.count(F.lit(1)).alias("n_writes")).where(F.col("n_writes") > 1)
