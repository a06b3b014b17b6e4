"""Corpus pipeline: quality, near-duplicates, secrets, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents`` (the last one token
ids); its result is written and read again as the next one's ``docs``. Stages set the session's Arrow
batches to 1,000 rows, so that workers hold few whole texts at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import minhash, mixing, pieces, quality, secrets
from tracelake.llm.common import shared_dir, small_batches, without


def resample_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    small_batches(spark)
    rated = quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, rated.where(~F.col("kept")).select(F.col("id").alias("doc_id"), "print"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id; documents without id stay."""
    small_batches(spark)
    found = minhash.near_duplicates(docs)
    docs = without(docs, found.where(~F.col("kept")).select(F.col("id").alias("doc_id")))
    return mixing.once(docs, "doc_id")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts blotted out."""
    small_batches(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    small_batches(spark)
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's best segmentation, with the log-probabilities of the four best, and log-probability and ids of each of the four."""
    small_batches(spark)
    return pieces.encode(docs).select(F.col("id").alias("doc_id"), "ids", F.transform("n_best", lambda x: x["score"]).alias("scores"), "n_best")


STAGES = [
    ("quality", resample_quality),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_pieces),
]

#: No stage but mixing can be said in SQL; tests compare each with brute force.
ORACLE_SQL = None


def run_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with all columns of the last one."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, without the segmentations after the best."""
    return run_whole(spark, sf_dir).drop("n_best")
