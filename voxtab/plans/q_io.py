"""Queries over batch inference."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from voxtab.operators.infer import batch_infer
from voxtab.plans.registry import register
from voxtab.sources.views import table


def _load():
    return {"min_words": 1}


def _predict(model, pdf: pd.DataFrame) -> pd.DataFrame:
    words = pdf["text"].str.split().str.len()
    if (words < model["min_words"]).any() or (pdf["doc_id"] % 13 == 0).any():
        raise ValueError("bad transcript in batch")
    return pd.DataFrame({"n_words": words.astype("int64")})


@register(
    "b5_batch_infer",
    r"""SELECT doc_id, CASE WHEN ok THEN n END AS n_words, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN NOT ok THEN 'ValueError: bad transcript in batch' END AS reason
FROM (SELECT doc_id, n, n >= 1 AND doc_id % 13 <> 0 AS ok
      FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[\s]+'), lambda w: w <> '')) AS n FROM documents))""",
)
def b5_batch_infer(spark, sf_dir):
    """B5 with a stand-in model (word count; fails on empty text and on every
    thirteenth document): failures become status rows, the job goes on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text"))
    return batch_infer(docs, _load, _predict, "n_words bigint", ["doc_id"])
