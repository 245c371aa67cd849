"""The corpus operators' queries over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_conversations
from .common import bound_batches
from .fingerprint import edited_fingerprints
from .linededup import dedup_lines
from .materialise import training_order
from .mixing import mix
from .neardup import near_duplicates
from .oracles import ORACLES
from .packing import pack
from .quality import quality
from .retention import arrival, retention
from .topk import top_k
from .toxicity import toxicity
from .urlfilter import judge_urls
from .whitening import whiten

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_cdc_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op2_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


@_query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@_query
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(_table(spark, sf_dir, "documents"))


@_query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


@_query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return format_conversations(rows.unionByName(extra))


@_query
def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op12_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = arrival(F.col("click_id"), F.col("arrived_at")) < F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return retention(_table(spark, sf_dir, "clicks"), _table(spark, sf_dir, "clients"), known)


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))
