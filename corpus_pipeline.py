"""The corpus pipeline: stages over documents, each written as Parquet and reread.

quality classifier -> MinHash near-dedup -> personal data -> mixing -> packing.
Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark.llm import gam, minhash, mixing, packing, pii, queries
from radspark.llm.common import small_batches, spool

#: Words in each generation of the packing workers' memory: fewer than alone, since earlier stages share the executors.
WORDS = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (2) rejects go."""
    small_batches(spark)
    return gam.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (6) stays."""
    small_batches(spark)
    return minhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data (8) is masked; ``n_chars`` follows the text."""
    small_batches(spark)
    out = pii.mask(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by calibrated probabilities (5)."""
    small_batches(spark)
    return mixing.sample(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (9): one row per piece of each document that came this far."""
    small_batches(spark)
    return packing.pack_documents(docs, queries._tokenizer(), remembered=WORDS)


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("personal_data", pii_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # learned models, signatures and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
