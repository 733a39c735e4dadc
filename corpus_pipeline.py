"""A training-corpus pipeline: quality rules, exact dedup, near-dedup, mixing
and encoding. Each stage takes what the one before it kept, written as
Parquet and read back, and returns the columns of ``documents``; the last
returns the encoded corpus."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voxtab.llm import exact_dedup, mixing, quality_rules, simhash_dedup
from voxtab.llm.queries import encoded
from voxtab.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return quality_rules.clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.drop_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their
    target weights; those of raised categories may stay more than once."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with the digests of the ids
    and of the text that they decode to."""
    return encoded(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "ids"])


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

#: The stages hold hashes, trees and a tokenizer that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage tables go to the shared
    checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{base}/{k}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
