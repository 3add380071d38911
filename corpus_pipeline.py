"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark decontamination, personal data, BPE. Each stage works on all that its predecessor kept.

Defined cases: a table that is empty, or emptied by a stage, gives an empty result with the same columns; null and empty texts fail the quality rules and end there; repeated rows are near copies of each other, of which one stays; other columns of documents are kept as they are up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import bpe_digests
from tessera.llm.common import stored
from tessera.llm.decontaminate import drop_leaks
from tessera.llm.pii import mask_personal_data
from tessera.llm.quality import keep_quality
from tessera.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: of fingerprints within 4 bits, or of Jaccard similarity 0.8 on five-word shingles."""
    return drop_near_copies(docs, similar=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in a text give way to their kinds."""
    return mask_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    return bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", personal_data), ("bpe", tokens)]

#: SQL has no XXH64, no tokenizer and no fitted references, so a brute-force version tests the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
