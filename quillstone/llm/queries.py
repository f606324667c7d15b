"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import conversations, filter_audit, html_text, licenses, packing, quality, secrets, sharding, simhash, token_store, url_filter, vptree, words_bpe
from quillstone.llm.common import table

QUERY_STEP = 20


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_documents(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_bpe.encode_documents(table(spark, sf_dir, "documents"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.junk_list(pages))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_quality, op3_html, op4_licenses, op5_sharding, op6_neighbours, op7_token_shards, op8_simhash, op9_secrets, op10_words, op11_conversations, op12_urls, op13_filter_audit)}
ORACLES = {"op2_quality": quality.SQL, "op6_neighbours": vptree.SQL, "op12_urls": url_filter.SQL, "op13_filter_audit": filter_audit.SQL}
