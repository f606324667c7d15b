"""Index upkeep: reuse of embeddings, upsert, deletion of stale chunks, tables by department, ingest against a manifest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import access, text as T
from quillstone.operators.search_index import newest


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content hash the manifest lacks, or has with status error."""
    return files.join(manifest.filter("status <> 'error'").select("file_hash").distinct(), "file_hash", "left_anti")


def ingest_status(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """files with status: unchanged (content known), updated (path known, content new) or new."""
    known = manifest.filter("status <> 'error'").select("file_hash").distinct().withColumn("same", F.lit(True))
    paths = manifest.select("source_path").distinct().withColumn("seen", F.lit(True))
    out = files.join(known, "file_hash", "left").join(paths, "source_path", "left")
    return out.withColumn("status", F.when(F.col("same"), "unchanged").when(F.col("seen"), "updated").otherwise("new")).drop("same", "seen")


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "chunk_id", order: str | None = None) -> DataFrame:
    """incoming replaces rows of the same key, so that a key is unique. Of incoming rows with one key the last by `order` counts, ties by all columns; a null key is a key like any other."""
    last = newest(incoming, [key], [order] if order else [])
    same = F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    return existing.alias("a").join(last.select(key).alias("b"), same, "left_anti").unionByName(last)


def delete_stale(index: DataFrame, current: DataFrame, document: str = "document_id", key: str = "chunk_id") -> DataFrame:
    """index without the rows of current's documents whose key current lacks; other documents stay untouched. The stale keys are found on keys alone; whole rows meet one anti join."""
    held = index.select(document, key)
    stale = held.join(current.select(document).distinct(), document, "left_semi").join(current.select(key), key, "left_anti").select(key)
    return index.join(stale, key, "left_anti").select(*index.columns)


def reuse_embeddings(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """chunks with embedding and embedding_source: reused where the cache has the same chunk and content, hash_fallback elsewhere."""
    c = cache.select("chunk_id", F.col("content_hash").alias("_hash"), F.col("embedding").alias("_kept"))
    same = F.coalesce(F.col("_hash") == F.col("content_hash"), F.lit(False))
    out = chunks.join(c, "chunk_id", "left")
    return out.withColumn("embedding", F.when(same, F.col("_kept")).otherwise(T.hash_vectors(F.when(~same, F.col("content"))))).withColumn("embedding_source", F.when(same, "reused").otherwise("hash_fallback")).drop("_hash", "_kept")


def payload(chunks: DataFrame) -> DataFrame:
    """Index columns with defaults. A missing sensitivity stays null, and so is hidden from all but Restricted."""
    default = lambda c, v: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)).alias(c)
    return chunks.select("chunk_id", "document_id", "content", "content_hash", default("department", "General"), default("doc_type", "Document"), "sensitivity", default("source_file", "unknown"), default("section", "Document"))


def department_manifest(chunks: DataFrame) -> DataFrame:
    """department, table_name, chunk_count of the known departments; missing ones count as General."""
    dep = F.coalesce(F.nullif(F.col("department"), F.lit("")), F.lit("General"))
    known = chunks.select(dep.alias("department")).filter(F.col("department").isin(access.DEPARTMENTS))
    return known.groupBy("department").agg(F.count("*").alias("chunk_count")).select("department", F.concat(F.lit("rag_chunks_"), F.lower("department")).alias("table_name"), "chunk_count")


def departments_seen(chunks: DataFrame) -> DataFrame:
    """One row: all departments met and those that have no table, sorted. Departments are few."""
    known = F.col("department").isin(access.DEPARTMENTS)
    each = chunks.select("department").filter(F.coalesce("department", F.lit("")) != "").distinct()
    names = lambda c: F.array_join(F.array_sort(F.collect_list(c)), ",")
    return each.agg(names(F.col("department")).alias("departments_seen"), names(F.when(~known, F.col("department"))).alias("unknown_departments"))


def missing_tables(existing: list[str], departments: list[str] | str) -> list[str]:
    """Tables that the departments need and that don't exist, in order."""
    return [t for t in access.department_tables(departments) if t not in set(existing)]


def unknown_departments(chunks: DataFrame) -> DataFrame:
    """Departments that have no table, with their rows."""
    return chunks.filter(~F.coalesce(F.nullif(F.col("department"), F.lit("")), F.lit("General")).isin(access.DEPARTMENTS)).groupBy("department").agg(F.count("*").alias("n"))


def write_by_department(chunks: DataFrame, path: str) -> None:
    """One job writes all department tables as partitions of one Parquet table; a few files each, however large one department is."""
    rows = payload(chunks).filter(F.col("department").isin(access.DEPARTMENTS))
    rows.hint("rebalance", "department").write.mode("overwrite").partitionBy("department").parquet(path)


def read_by_department(spark: SparkSession, path: str, departments: list[str] | str = access.ALL) -> DataFrame:
    """The chunks of the given departments' partitions and of General; FileNotFoundError if there is no index at path, as that is not the same as an empty one."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no department index at {path}") from e
    return rows if departments == access.ALL else rows.filter(F.col("department").isin("General", *departments))


def load_cache(spark: SparkSession, path: str) -> DataFrame:
    """The embedding cache (chunk_id, content_hash, embedding, embedding_source); empty if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], "chunk_id string, content_hash string, embedding array<double>, embedding_source string")


def save_cache(embedded: DataFrame, cache: DataFrame, path: str) -> DataFrame:
    """Write the cache as it is after a run: this run's embeddings in place of earlier ones of the same chunks. path must not be the one that cache is read from. A reused vector keeps its own source."""
    fresh = embedded.join(cache.select("chunk_id", F.col("embedding_source").alias("_known")), "chunk_id", "left")
    source = F.when(F.col("embedding_source") == "reused", F.col("_known")).otherwise(F.col("embedding_source"))
    upsert(cache, fresh.select("chunk_id", "content_hash", "embedding", source.alias("embedding_source"))).write.mode("overwrite").parquet(path)
    return embedded.sparkSession.read.parquet(path)
