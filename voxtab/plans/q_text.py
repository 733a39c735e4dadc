"""Checked queries H1-H7 (transcripts)."""

from __future__ import annotations


from pyspark.sql import functions as F

from voxtab.operators import text as H
from voxtab.plans.registry import register
from voxtab.sources.views import table, v_files, v_turns, with_views

_STRIP = "regexp_replace(piece, '<\\|.*?\\|>', '', 'g')"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PROMPTS_SQL = "(VALUES " + ", ".join(f"({_sql_str(k)}, {_sql_str(v)})" for k, v in H.PROMPTS.items()) + ") p(plang, prompt)"


@register("h1_strip_tags", with_views("v_turns") + f"SELECT conv_id, turn, {_STRIP} AS text FROM v_turns")
def h1_strip_tags(spark, sf_dir):
    return v_turns(spark, sf_dir).select("conv_id", "turn", H.strip_tags("piece").alias("text"))


@register(
    "h2_join_pieces",
    with_views("v_turns") + f"SELECT conv_id, string_agg({_STRIP}, '' ORDER BY turn) AS text FROM v_turns GROUP BY conv_id",
)
def h2_join_pieces(spark, sf_dir):
    return H.join_pieces(v_turns(spark, sf_dir), "conv_id", "turn", text="piece")


@register(
    "h3_canonical_lang",
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'ja' ELSE lang END AS lang FROM documents",
)
def h3_canonical_lang(spark, sf_dir):
    """Every fifth document is marked ``jp``, as some engines write it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    marked = docs.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "jp").otherwise(F.col("lang")))
    return marked.select("doc_id", H.canonical_lang("lang").alias("lang"))


@register(
    "h4_attach_prompt",
    f"""SELECT doc_id, lang, prompt, prompt IS NOT NULL AS has_prompt,
       CASE WHEN prompt IS NOT NULL THEN {H.PROMPT_HIT_BATCH_S} ELSE {H.PROMPT_MISS_BATCH_S} END AS batch_size_s,
       prompt IS NOT NULL AS merge_vad
FROM documents LEFT JOIN {_PROMPTS_SQL} ON documents.lang = p.plang""",
)
def h4_attach_prompt(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return H.attach_prompt(docs).select("doc_id", "lang", "prompt", "has_prompt", "batch_size_s", "merge_vad")


@register("h5_union_results", with_views("v_turns") + "SELECT conv_id, arg_max(piece, turn) AS text FROM v_turns GROUP BY conv_id")
def h5_union_results(spark, sf_dir):
    return H.union_results(v_turns(spark, sf_dir), "conv_id", "turn", text="piece").withColumnRenamed("piece", "text")


@register(
    "h5_union_tables",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 2 = 0 THEN lang ELSE CAST(n_chars AS VARCHAR) END AS text
FROM documents""",
)
def h5_union_tables(spark, sf_dir):
    """Three result tables of one corpus; the later table wins."""
    docs = table(spark, sf_dir, "documents")
    first = docs.select("doc_id", F.col("n_chars").cast("string").alias("text"))
    second = docs.where(F.col("doc_id") % 2 == 0).select("doc_id", F.col("lang").alias("text"))
    third = docs.where(F.col("doc_id") % 3 == 0).select("doc_id", F.col("source").alias("text"))
    return H.union_tables([first, second, third], "doc_id")


@register(
    "h6_pair_transcripts",
    "SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def h6_pair_transcripts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return H.pair_transcripts(docs, table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "n_chars", "quality", "toxic")


@register(
    "h6_missing_transcripts",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def h6_missing_transcripts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return H.missing_transcripts(docs, table(spark, sf_dir, "labels"), "doc_id")


@register(
    "h7_render_manifest",
    with_views("v_files")
    + """SELECT d.doc_id, replace(replace('{PATH}|{TEXT}', '{TEXT}', d.text), '{PATH}', f.path) AS line
FROM documents d JOIN v_files f ON d.doc_id = f.doc_id""",
)
def h7_render_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = docs.join(v_files(spark, sf_dir).select("doc_id", "path"), "doc_id")
    return H.render_manifest(j, "{PATH}|{TEXT}").select("doc_id", "line")
