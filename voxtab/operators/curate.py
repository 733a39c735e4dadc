"""Composites over the single operators: verdicts applied to the clips, and
clustering by a method of the caller's choice.

The verdict tables of earlier stages (eligibility, speakers per clip, quality,
transcripts) are applied by semi joins, so a clip with repeated verdicts stays
one clip, and what was dropped is told per clip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.operators import speakers as SP
from voxtab.sources.sinks import assigned_clips

#: What keeps a clip, in the order in which its loss is told.
RULES = ("eligible", "single_speaker", "quality", "transcript")


def _keepers(key: str, eligible: DataFrame | None, speakers: DataFrame | None, quality: DataFrame | None, transcripts: DataFrame | None,
             min_speakers: int) -> list[tuple[str, DataFrame]]:
    single = None if speakers is None else speakers.where(~F.col("multi_speaker") & (F.col("spk_count") >= min_speakers))
    kept = (
        None if eligible is None else eligible.where(F.col("status") == "todo"),
        single,
        None if quality is None else quality.where(F.col("verdict") == "pass"),
        None if transcripts is None else transcripts.where(F.length(F.trim("text")) > 0),
    )
    return [(rule, df.select(key)) for rule, df in zip(RULES, kept, strict=True) if df is not None]


def curate(clips: DataFrame, key: str = "utt_id", eligible: DataFrame | None = None, speakers: DataFrame | None = None,
           quality: DataFrame | None = None, transcripts: DataFrame | None = None, min_speakers: int = 1) -> DataFrame:
    """The ``clips`` that every given table keeps: ``eligible (key, status)``
    as todo, ``speakers (key, multi_speaker, spk_count)`` as one speaker,
    ``quality (key, verdict)`` as pass, ``transcripts (key, text)`` with some
    text. A chain of left semi joins: no clip is multiplied."""
    for _, keep in _keepers(key, eligible, speakers, quality, transcripts, min_speakers):
        clips = clips.join(keep, key, "left_semi")
    return clips


def losses(clips: DataFrame, key: str = "utt_id", eligible: DataFrame | None = None, speakers: DataFrame | None = None,
           quality: DataFrame | None = None, transcripts: DataFrame | None = None, min_speakers: int = 1) -> DataFrame:
    """``(key, reason)`` of the clips that ``curate`` drops, by the first rule
    that does."""
    reason = F.lit(None).cast("string")
    rest = clips.select(key).distinct()
    for rule, keep in _keepers(key, eligible, speakers, quality, transcripts, min_speakers):
        mark = f"_{rule}"
        rest = rest.join(keep.distinct().withColumn(mark, F.lit(True)), key, "left")
        reason = F.coalesce(reason, F.when(F.col(mark).isNull(), rule))
    return rest.select(key, reason.alias("reason")).where(F.col("reason").isNotNull())


def cluster_speakers(vecs: DataFrame, method: str = "dbscan", id_col: str = "utt_id", vec: str = "vec", eps: float = 0.25,
                     threshold: float = 0.75, max_k: int = 10) -> DataFrame:
    """``(id, label)`` by ``dbscan`` (F5), ``kmeans`` (F6) or ``ward``."""
    if method == "dbscan":
        return SP.dbscan_speakers(vecs, eps, id_col, vec)
    if method == "kmeans":
        return SP.kmeans_speakers(vecs, id_col, vec, max_k).select(id_col, "label")
    if method == "ward":
        return SP.ward_speakers(vecs, threshold, id_col, vec)
    raise ValueError(f"no method {method!r}: dbscan, kmeans or ward")


def clips_by_speaker(clips: DataFrame, vecs: DataFrame, method: str = "dbscan", key: str = "utt_id", **settings) -> DataFrame:
    """F1-F2, F5-F8 and A10 in one: valid utterance vectors are clustered, and
    the clips of the clustered utterances get their speaker (noise is a
    speaker of its own, ``spk-1``). ``vecs``: chunk vectors ``(key, vec)``."""
    pooled = SP.mean_pool(vecs, key)
    ok = SP.valid_embeddings(pooled, None, key).where(F.col("status") == "success").select(key)
    labels = cluster_speakers(pooled.join(ok, key, "left_semi"), method, key, **settings)
    return assigned_clips(clips, SP.utt2spk(labels, key), key)
