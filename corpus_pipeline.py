"""Documents to training sequences: each stage is written as Parquet and reread by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wagerscope.llm import mixing, pieces, quality, secrets, simhash
from wagerscope.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_per_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; no document goes."""
    return secrets.redacted(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.emitted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their texts."""
    return pieces.encoded(docs, public_tokenizers.path(pieces.MODEL))


STAGES = [
    ("quality_rules", good_quality),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scans", without_secrets),
    ("source_mixing", mixed_sources),
    ("sentencepiece", token_ids),
]
#: Fingerprints, components and the model's posterior are beyond plain SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name=name)
    return docs
