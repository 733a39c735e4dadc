"""Logical views over the driver's parquet tables.

Each view has one Spark definition and one SQL definition (DuckDB dialect)
with the same arithmetic, so that every query can be checked against an
independent engine. Ordering keys are unique: events are ordered by
``(ts, event_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures (not the reference's): suffix rotation,
# sample-rate rotation.
FILE_EXTS = [".wav", ".mp3", ".flac", ".mp4", ".txt", ".WAV"]
RATES = [16000, 24000, 44100, 48000]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(e, keys=("user_id",)):
    """Events with ``rn`` = 0-based position within ``keys`` by
    ``(ts, event_id)``, from the distributed scan (a user holding a third of
    all events is still spread over many tasks)."""
    from voxtab.plans.scan import ordered_scan

    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    return ordered_scan(e.select(*cols), list(keys), ["ts", "event_id"]).withColumnRenamed("pos", "rn")


def _path():
    ext = F.element_at(F.array(*[F.lit(e) for e in FILE_EXTS]), (F.col("doc_id") % 6 + 1).cast("int"))
    return F.concat_ws("/", "source", "lang", F.concat(F.lit("doc."), F.col("doc_id").cast("string"), ext))


def v_files(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(_path().alias("path"), "lang", "doc_id")


def v_infos(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rate = F.element_at(F.array(*[F.lit(r) for r in RATES]), (F.col("doc_id") % 4 + 1).cast("int"))
    return d.select(
        _path().alias("path"),
        "lang",
        (F.col("n_chars") * 1000).cast("bigint").alias("frames"),
        rate.cast("int").alias("rate"),
        (F.lit(1) + F.expr("(doc_id div 4) % 2")).cast("int").alias("channels"),
    )


def v_ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    status = (
        F.when(F.col("event_id") % 7 == 0, "failed")
        .when(F.col("event_id") % 7 == 1, "skipped")
        .otherwise("success")
    )
    reason = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("decode error "), F.col("event_type")))
        .when(F.col("event_id") % 7 == 1, F.lit("output exists"))
    )
    return e.select(
        F.col("event_type").alias("stage"),
        F.concat(F.lit("/data/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"), F.lit(".wav")).alias("file"),
        status.alias("status"),
        reason.alias("reason"),
    )


def v_frames(spark, sf_dir):
    e = _numbered(table(spark, sf_dir, "events"))
    return e.select(
        F.col("user_id").alias("utt_id"),
        F.col("rn").alias("frame_idx"),
        (F.col("value") / 500).alias("rms"),
    )


def v_samples(spark, sf_dir):
    e = _numbered(table(spark, sf_dir, "events"))
    return e.select(
        F.col("user_id").alias("utt_id"),
        F.col("rn").alias("idx"),
        ((F.col("value") - 50) / 500).alias("sample"),
    )


def v_stems(spark, sf_dir):
    e = _numbered(table(spark, sf_dir, "events"), ("user_id", "event_type"))
    rn = F.col("rn")
    return e.select(
        F.col("user_id").alias("utt_id"),
        F.col("event_type").alias("track"),
        F.floor(rn / 2).cast("bigint").alias("idx"),
        (rn % 2).cast("int").alias("channel"),
        ((F.col("value") - 50) / 500).alias("sample"),
    )


def v_pitch(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    f0 = (
        F.when(F.col("event_type") == "error", F.lit(0.0))
        .when((F.col("event_type") == "signup") & (F.col("event_id") % 10 == 0), F.lit(float("nan")))
        .otherwise(F.lit(40.0) + F.col("value") * 3)
    )
    return e.select(F.col("user_id").alias("utt_id"), f0.alias("f0"))


def v_emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.expr("vec_id div 5").alias("utt_id"),
        (F.col("vec_id") % 5).cast("int").alias("chunk_idx"),
        F.col("embedding").alias("vec"),
    )


def v_scores(spark, sf_dir, numbered=False):
    """Without ``numbered`` there is no ``hop_idx``: only queries that return
    it pay for the scan."""
    e = table(spark, sf_dir, "events")
    e = _numbered(e) if numbered else e
    ovr = F.lit(1.0) + (F.col("user_id") % 5) + F.col("value") / 500
    hops = e.groupBy("user_id").agg((F.count(F.lit(1)) + F.lit(8.01)).alias("seconds"))
    return e.join(hops, "user_id").select(
        F.col("user_id").alias("file"),
        *([F.col("rn").alias("hop_idx")] if numbered else []),
        (ovr + 0.1).alias("sig"),
        (ovr - 0.1).alias("bak"),
        ovr.alias("ovr"),
        ovr.alias("p808"),
        "seconds",
    )


def v_turns(spark, sf_dir):
    from voxtab.plans.scan import ordered_scan

    c = table(spark, sf_dir, "conversations").withColumn("_w", F.length("text").cast("bigint") + 200)
    c = ordered_scan(c.select("conv_id", "turn", "role", "text", "_w"), ["conv_id"], ["turn"], sums=["_w"])
    n = F.length("text").cast("bigint")
    start = (F.col("cum__w") - F.col("_w")).cast("bigint")
    return c.select(
        "conv_id",
        "turn",
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>"), F.col("text")).alias("piece"),
        n.alias("n"),
        start.alias("start"),
        (start + n).alias("end"),
    )


# ---------------------------------------------------------------- SQL forms
SQL_VIEWS = {
    "v_files": """v_files AS (
  SELECT source || '/' || lang || '/doc.' || CAST(doc_id AS VARCHAR)
         || (['.wav','.mp3','.flac','.mp4','.txt','.WAV'])[doc_id % 6 + 1] AS path,
         lang, doc_id
  FROM documents)""",
    "v_infos": """v_infos AS (
  SELECT source || '/' || lang || '/doc.' || CAST(doc_id AS VARCHAR)
         || (['.wav','.mp3','.flac','.mp4','.txt','.WAV'])[doc_id % 6 + 1] AS path,
         lang, CAST(n_chars * 1000 AS BIGINT) AS frames,
         CAST(([16000, 24000, 44100, 48000])[doc_id % 4 + 1] AS INTEGER) AS rate,
         CAST(1 + (doc_id // 4) % 2 AS INTEGER) AS channels
  FROM documents)""",
    "v_ledger": """v_ledger AS (
  SELECT event_type AS stage,
         '/data/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.wav' AS file,
         CASE WHEN event_id % 7 = 0 THEN 'failed' WHEN event_id % 7 = 1 THEN 'skipped'
              ELSE 'success' END AS status,
         CASE WHEN event_id % 7 = 0 THEN 'decode error ' || event_type
              WHEN event_id % 7 = 1 THEN 'output exists' END AS reason
  FROM events)""",
    "v_frames": """v_frames AS (
  SELECT user_id AS utt_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx,
         value / 500 AS rms
  FROM events)""",
    "v_samples": """v_samples AS (
  SELECT user_id AS utt_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx,
         (value - 50) / 500 AS sample
  FROM events)""",
    "v_stems": """v_stems AS (
  SELECT utt_id, track, CAST((rn - 1) // 2 AS BIGINT) AS idx, CAST((rn - 1) % 2 AS INTEGER) AS channel, sample
  FROM (SELECT user_id AS utt_id, event_type AS track, (value - 50) / 500 AS sample,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
        FROM events))""",
    "v_pitch": """v_pitch AS (
  SELECT user_id AS utt_id,
         CASE WHEN event_type = 'error' THEN 0.0
              WHEN event_type = 'signup' AND event_id % 10 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE 40.0 + value * 3 END AS f0
  FROM events)""",
    "v_emb": """v_emb AS (
  SELECT vec_id // 5 AS utt_id, CAST(vec_id % 5 AS INTEGER) AS chunk_idx, embedding AS vec
  FROM embeddings)""",
    "v_scores": """v_scores AS (
  SELECT user_id AS file,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS hop_idx,
         1.0 + user_id % 5 + value / 500 + 0.1 AS sig,
         1.0 + user_id % 5 + value / 500 - 0.1 AS bak,
         1.0 + user_id % 5 + value / 500 AS ovr,
         1.0 + user_id % 5 + value / 500 AS p808,
         CAST(count(*) OVER (PARTITION BY user_id) + 8.01 AS DOUBLE) AS seconds
  FROM events)""",
    "v_turns": """v_turns AS (
  SELECT conv_id, turn, '<|' || role || '|>' || text AS piece,
         CAST(length(text) AS BIGINT) AS n,
         CAST(coalesce(sum(length(text) + 200) OVER (PARTITION BY conv_id ORDER BY turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         CAST(coalesce(sum(length(text) + 200) OVER (PARTITION BY conv_id ORDER BY turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(text) AS BIGINT) AS "end"
  FROM conversations)""",
}


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named views (for oracle SQL)."""
    return "WITH RECURSIVE " + ",\n".join(SQL_VIEWS[n] for n in names) + "\n"


VIEWS = {
    "v_files": v_files,
    "v_infos": v_infos,
    "v_ledger": v_ledger,
    "v_frames": v_frames,
    "v_samples": v_samples,
    "v_stems": v_stems,
    "v_pitch": v_pitch,
    "v_emb": v_emb,
    "v_scores": v_scores,
    "v_turns": v_turns,
}
