"""Training corpus from `documents`: quality rules, SimHash near-dedup, secret scans, packing. Each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import packing, quality, secrets, simhash
from quillstone.llm.common import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the base rules or the adaptive thresholds reject go."""
    return quality.keep_good(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of texts that share 0.8 of their five-word shingles the document with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every secret is replaced by its kind in brackets; all documents stay."""
    return secrets.redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of all documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality_stage), ("near_copies", near_copies_stage), ("secrets", secrets_stage), ("packing", packing_stage)]
#: Tokenizer and fingerprint hash can't be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each one's rows written into the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
