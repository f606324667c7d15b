"""Chunks: cleaning, sections, overlapping windows, first-occurrence dedup and numbering in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import text as T


def windowed(docs: DataFrame, cleaned: bool = False, sectioned: bool = False, size: int = T.SIZE, overlap: int = T.OVERLAP) -> DataFrame:
    """One row a window: docs' columns but text, with section_no, section, window_no, content, content_hash."""
    body = T.clean(F.col("text")) if cleaned else F.col("text")
    rest = [c for c in docs.columns if c != "text"]
    parts = T.sections(body) if sectioned else F.array(F.struct(F.lit("Document").alias("title"), body.alias("body")))
    out = docs.select(*rest, F.posexplode(parts).alias("section_no", "s"))
    out = out.select(*rest, "section_no", F.col("s.title").alias("section"), F.posexplode(T.windows(F.col("s.body"), size, overlap)).alias("window_no", "content"))
    return out.withColumn("content_hash", F.sha2("content", 256))


def first_occurrences(windows: DataFrame) -> DataFrame:
    """Windows whose content no earlier one has, in order of doc_id (null last), section and window; equal rows leave one. Partial minima come before the one shuffle, so a text with many copies is no hot group."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "section_no", "window_no")
    rest = [c for c in windows.columns if c != "content_hash"]
    return windows.groupBy("content_hash").agg(F.min_by(F.struct(*rest), place).alias("r")).select("r.*", "content_hash")


def numbered(windows: DataFrame, document: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """chunk_number from 1 in each document and total_chunks_in_document."""
    doc = Window.partitionBy(*document)
    return windows.withColumn("chunk_number", F.row_number().over(doc.orderBy("section_no", "window_no"))).withColumn("total_chunks_in_document", F.count("*").over(doc))


def chunks(docs: DataFrame, **how) -> DataFrame:
    """All chunks of docs (doc_id, text and any labels) with document_id, chunk_id, lineage numbers and content_hash."""
    with_id = docs.withColumn("file_hash", F.sha2("text", 256)).withColumn("document_id", T.document_id(F.col("file_hash")))
    out = numbered(first_occurrences(windowed(with_id, **how)), ("doc_id", "document_id"))
    return out.withColumn("chunk_id", T.chunk_id(F.col("document_id"), F.col("chunk_number"))).withColumn("chunk_size", F.size(T.words(F.col("content"))))


def summary(chunks: DataFrame, processed: DataFrame, size: int = T.SIZE, overlap: int = T.OVERLAP) -> DataFrame:
    """A run's counts: chunks, documents that have any, documents processed, and the windows' measures."""
    counts = chunks.agg(F.count("*").alias("total_chunks"), F.countDistinct("document_id").alias("total_documents"))
    return counts.crossJoin(F.broadcast(processed.agg(F.count("*").alias("documents_processed")))).withColumn("chunk_size", F.lit(size)).withColumn("overlap", F.lit(overlap))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines."""
    chunks.write.mode("overwrite").json(path)
