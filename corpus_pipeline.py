"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import bound_batches, stored
from tidewire.llm.mixing import keep_mixed
from tidewire.llm.neardup import keep_first
from tidewire.llm.packing import pack
from tidewire.llm.quality import keep_good
from tidewire.llm.toxicity import fit, keep_civil


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    bound_batches(spark)
    return keep_civil(docs, fit(docs, _labels(spark, sf_dir)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is good."""
    bound_batches(spark)
    return keep_good(docs, _labels(spark, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8 or more."""
    bound_batches(spark)
    return keep_first(docs, 80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to tempered source, language and topic weights."""
    bound_batches(spark)
    return keep_mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    bound_batches(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Model training, raking and tokenisation aren't expressible in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
