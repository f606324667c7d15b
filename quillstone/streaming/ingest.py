"""Incremental ingestion as a stream: each text is chunked once, each document claims the text that it last came with, and of a text's claimants the smallest owns its chunks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstone.operators.chunking import windowed

#: Columns of a text's chunks; all others belong to the documents that claim it.
CHUNK = ["file_hash", "section_no", "section", "window_no", "content", "content_hash"]


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def take(df: DataFrame, number: int, target: str, order: str | None = None) -> None:
    """One batch of documents (doc_id, text and labels) into the tables below target; the same batch again overwrites what it wrote.

    `texts` gets the chunks of texts that no other batch has chunked, `claims` each document with its labels and the hash of its text. Of rows of one document in a batch the last by `order` counts (ties: the greatest); a null doc_id is a document like any other. The texts come first: a batch that breaks off between the two has claimed nothing yet.
    """
    spark = df.sparkSession
    labels = [c for c in df.columns if c not in ("doc_id", "text")]
    last = F.struct(*([order] if order else []), "text", *labels)
    each = df.groupBy("doc_id").agg(F.max_by(F.struct("text", *labels), last).alias("r")).select("doc_id", "r.*").withColumn("file_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    known = _table(spark, f"{target}/texts")
    fresh = each.groupBy("file_hash").agg(F.coalesce(F.first("text"), F.lit("")).alias("text"))
    if known is not None:
        fresh = fresh.join(known.filter(F.col("batch") != number).select("file_hash").distinct(), "file_hash", "left_anti")
    windowed(fresh).select(*CHUNK).write.mode("overwrite").parquet(f"{target}/texts/batch={number}")
    each.drop("text").write.mode("overwrite").parquet(f"{target}/claims/batch={number}")


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, max_files: int = 100, order: str | None = None) -> StreamingQuery:
    """take() every micro-batch of new files below source; restarts go on from the checkpoint."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    return files.writeStream.foreachBatch(lambda df, number: take(df, number, target, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def owners(spark: SparkSession, target: str) -> DataFrame:
    """The documents that own a text now, with their labels and file_hash: of those whose last claim it is the smallest doc_id, null last. A text that its owner lets go of passes on, and comes back with it."""
    claims = spark.read.parquet(f"{target}/claims")
    rest = [c for c in claims.columns if c not in ("doc_id", "batch")]
    last = claims.groupBy("doc_id").agg(F.max_by(F.struct(*rest), "batch").alias("r")).select("doc_id", "r.*")
    held = [c for c in last.columns if c != "file_hash"]
    return last.groupBy("file_hash").agg(F.min_by(F.struct(*held), F.struct(F.col("doc_id").isNull(), "doc_id")).alias("r")).select("file_hash", "r.*")


def current(spark: SparkSession, target: str) -> DataFrame:
    """The chunks as they stand: those of every claimed text once, under its owner."""
    return owners(spark, target).join(spark.read.parquet(f"{target}/texts").drop("batch"), "file_hash")


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by time window and event type, for batch or streaming frames; late rows are dropped past the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
