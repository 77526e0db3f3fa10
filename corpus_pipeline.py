"""The corpus pipeline: quality rules, near-duplicate removal, surrogates, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.llm import bpe, mixing, near_dup, pii, quality, queries


#: Jaccard similarity, in percent, from which the near-duplicates stage links two documents.
NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep_good(queries.prepared(spark, docs))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return near_dup.keep_first(queries.prepared(spark, docs), percent=NEAR_PERCENT)


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the new text."""
    replaced = pii.replace(docs, queries.PII_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights; a document taken in two epochs is there twice."""
    levels = [(n, F.expr(e)) for n, e in queries.MIX_LEVELS]
    mixed = mixing.mix(docs, levels, queries.MIX_WEIGHTS, queries.MIX_BUDGET, queries.MIX_EPOCHS, queries.MIX_SEED)
    return mixed.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document and of the text decoded from them."""
    return bpe.digests(queries.prepared(spark, docs), public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", keep_first),
    ("surrogates", hide_persons),
    ("source mix", mix_sources),
    ("token ids", token_ids),
]

#: SQL has no zstandard and no BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before kept, written to the shared folder in between."""
    docs = queries.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = docs.checkpoint()
    return docs
