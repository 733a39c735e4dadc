"""Checked composites: clustering with its clips, and curation by verdicts.
The clips are the documents, which share their numbers with utterances."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import curate as K
from voxtab.operators import ledger as B
from voxtab.operators import quality as Q
from voxtab.operators import speakers as SP
from voxtab.plans.q_speakers import _F4_SQL, _F5_SQL, F4_EPS, F5_EPS
from voxtab.plans.registry import register
from voxtab.sources.views import table, v_emb, v_infos, v_scores, with_views

THRESHOLD = 3.0


def _clips(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("utt_id"), "lang", "source")


@register(
    "a10_clips_by_speaker",
    _F5_SQL + "SELECT doc_id AS utt_id, documents.lang, documents.source, 'spk' || label AS spk FROM documents JOIN lab ON vec_id = doc_id",
)
def a10_clips_by_speaker(spark, sf_dir):
    """Vectors to clips by speaker."""
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("utt_id"), F.col("embedding").alias("vec"))
    return K.clips_by_speaker(_clips(spark, sf_dir), vecs, "dbscan", eps=F5_EPS).select("utt_id", "lang", "source", "spk")


_VERDICTS = (
    _F4_SQL.replace("WITH RECURSIVE ", with_views("v_scores").rstrip() + ",\n", 1)
    + f""", clip AS (SELECT doc_id AS utt_id, lang, source, text FROM documents),
ql AS (SELECT file AS utt_id FROM v_scores GROUP BY file HAVING avg(ovr) >= {THRESHOLD}),
told AS (SELECT c.utt_id, c.lang, c.source,
                CASE WHEN NOT (c.utt_id % 4 IN (2, 3)) THEN 'eligible'
                     WHEN c.utt_id NOT IN (SELECT utt_id FROM cnt WHERE spk_count = 1) THEN 'single_speaker'
                     WHEN c.utt_id NOT IN (SELECT utt_id FROM ql) THEN 'quality'
                     WHEN trim(coalesce(c.text, '')) = '' THEN 'transcript' END AS reason FROM clip c)
"""
)


def _tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    number = F.regexp_extract("path", r"/doc\.([0-9]+)\.", 1).cast("bigint").alias("utt_id")
    infos = v_infos(spark, sf_dir).select(number, "rate", F.lit(2).alias("channels"))
    hops = v_scores(spark, sf_dir)
    scores = hops.groupBy(F.col("file").alias("utt_id")).agg(F.avg("ovr").alias("OVRL"))
    return {
        "eligible": B.eligible_for_separation(infos),
        "speakers": SP.speaker_count(v_emb(spark, sf_dir), eps=F4_EPS),
        "quality": Q.split_by_quality(scores, THRESHOLD),
        "transcripts": docs.select(F.col("doc_id").alias("utt_id"), "text"),
    }


@register("k1_curate", _VERDICTS + "SELECT utt_id, lang, source FROM told WHERE reason IS NULL")
def k1_curate(spark, sf_dir):
    return K.curate(_clips(spark, sf_dir), **_tables(spark, sf_dir))


@register("k2_losses", _VERDICTS + "SELECT utt_id, reason FROM told WHERE reason IS NOT NULL")
def k2_losses(spark, sf_dir):
    return K.losses(_clips(spark, sf_dir), **_tables(spark, sf_dir))
