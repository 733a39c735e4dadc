"""H1-H7: transcript cleanup, joining pieces, prompts, result union, pairing
and manifest rendering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtab.functions.columns import col_

# Fixed values (must equal the reference's): recognition prompts by language.
PROMPTS = {
    "zh": "人间灯火倒映湖中，她的渴望让静水泛起涟漪。若代价只是孤独，那就让这份愿望肆意流淌。",
    "en": "In the realm of advanced technology, the evolution of artificial intelligence stands as a monumental achievement.",
    "ja": "先進技術の領域において、人工知能の進化は画期的な成果として立っています。常に機械ができることの限界を押し広げているこのダイナミックな分野は、急速な成長と革新を見せています。複雑なデータパターンの解読から自動運転車の操縦まで、AIの応用は広範囲に及びます。",
}
# Engine parameters on prompt hit / miss (batch seconds, merged VAD).
PROMPT_HIT_BATCH_S, PROMPT_MISS_BATCH_S = 60, 300

TAG_PATTERN = r"(?d)<\|.*?\|>"  # (?d): only \n ends a line, as in Python


def strip_tags(c) -> "F.Column":
    """H1: remove ``<|...|>`` tags (non-greedy, not across newlines)."""
    return F.regexp_replace(col_(c), TAG_PATTERN, "")


def join_pieces(pieces: DataFrame, key: str, order: str, text: str = "text", clean: bool = True) -> DataFrame:
    """H2: the pieces of one file concatenated in order, no separator (the
    per-file transcript is the output row itself)."""
    t = strip_tags(text) if clean else F.col(text)
    return pieces.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), t.alias("t")))), lambda x: x["t"]),
            "",
        ).alias("text")
    )


def canonical_lang(c) -> "F.Column":
    """H3: ``jp`` -> ``ja``."""
    c = col_(c)
    return F.when(c == "jp", F.lit("ja")).otherwise(c)


def prompt_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROMPTS.items()), "lang string, prompt string")


def attach_prompt(df: DataFrame, lang: str = "lang") -> DataFrame:
    """H4: prompt by language (a three-entry dimension, broadcast), with the
    engine parameters that differ on hit and miss."""
    dim = prompt_table(df.sparkSession).withColumnRenamed("lang", "_plang")
    j = df.join(F.broadcast(dim), df[lang] == dim["_plang"], "left").drop("_plang")
    hit = F.col("prompt").isNotNull()
    return j.withColumn("has_prompt", hit).withColumn(
        "batch_size_s", F.when(hit, F.lit(PROMPT_HIT_BATCH_S)).otherwise(F.lit(PROMPT_MISS_BATCH_S))
    ).withColumn("merge_vad", hit)


def union_results(results: DataFrame, key: str = "path", order: str = "chunk", text: str = "text") -> DataFrame:
    """H5: union of chunk results, the later chunk wins per path (a
    partial-aggregating ``max_by``, not a window)."""
    return results.groupBy(key).agg(F.max_by(F.col(text), F.col(order)).alias(text))


def union_tables(tables: Sequence[DataFrame], key: str = "path", text: str = "text") -> DataFrame:
    """H5 over several result tables: for each path the row of the last table
    that has it."""
    ranked = [t.select(key, text).withColumn("_rank", F.lit(i)) for i, t in enumerate(tables)]
    return union_results(reduce(DataFrame.unionByName, ranked), key, "_rank", text)


def pair_transcripts(files: DataFrame, transcripts: DataFrame, key: str = "path") -> DataFrame:
    """H6: audio paired with its transcript; a missing transcript drops the
    row (inner join)."""
    return files.join(transcripts, key, "inner")


def missing_transcripts(files: DataFrame, transcripts: DataFrame, key: str = "path") -> DataFrame:
    """H6 warnings: audio without a transcript (anti join)."""
    return files.join(transcripts.select(key), key, "left_anti")


def render_manifest(df: DataFrame, template: str, path: str = "path", text: str = "text") -> DataFrame:
    """H7: ``{TEXT}`` replaced first, then ``{PATH}`` (so ``{PATH}`` inside
    the text is replaced too)."""
    line = F.replace(F.replace(F.lit(template), F.lit("{TEXT}"), F.col(text)), F.lit("{PATH}"), F.col(path))
    return df.withColumn("line", line)
