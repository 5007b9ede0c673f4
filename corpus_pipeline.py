"""From raw documents to packed training sequences, in four stages.

Each stage gets the documents that its predecessor kept and decides over all of
them; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftlens.llm import decontaminate, packing, quality, simhash_dedup
from shiftlens.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws; the rest go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, at most 4 differing bits."""
    return simhash_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their places in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_classifier", quality_classifier), ("simhash_near_dedup", simhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("best_fit_packing", best_fit_packing)]

#: The stages' models, fingerprints and tokenizer have no SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
