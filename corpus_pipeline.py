"""The corpus pipeline: toxic documents out, one of equal and of nearly equal documents kept, mixed, packed.

Every stage reads what its predecessor kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.functions.scratch import stored
from parcelflow.llm import exact_dedup, mixing, packing, simhash, toxicity
from parcelflow.llm.common import read


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, mixing.domains_of(docs, read(spark, sf_dir, "labels")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]
#: Trained models, fitted rates and tokenizers are beyond SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
