"""The registered queries: each applies its operator to its whole table and derives the stated columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import alignment, curves, exact_dedup, language, mixing, packing, pii, repair, sharding, simhash, topk, toxicity, url_filter
from parcelflow.llm.common import read


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.rates(docs, mixing.domains_of(docs, read(spark, sf_dir, "labels")))


def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.learn_and_identify(read(spark, sf_dir, "documents"))


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_groups(read(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    hosts = spark.createDataFrame([(h,) for h in url_filter.BLOCKED_HOSTS], "host string")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules, hosts)


def op11_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(read(spark, sf_dir, "embeddings"))


def op12_identity_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_soft_mixing, op2_pivot_topk, op3_language_id, op4_feistel_sharding, op5_simhash_groups,
        op6_pii_spans, op7_exact_dedup, op8_packing, op9_toxicity, op10_url_verdicts,
        op11_hilbert_neighbours, op12_identity_alignment, op13_conversation_repair,
    )
}
