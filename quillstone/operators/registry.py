"""Asset registry as an event log: the latest state of each document is a fold over its events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stages in order.
STATUSES = ["ingested", "classified", "chunked", "indexed"]


def states(events: DataFrame) -> DataFrame:
    """Per document: status (the stage of the last event; of events at one time the furthest stage), its time, events, and each stage's last time. Events: document_id, stage, at."""
    times = [F.max(F.when(F.col("stage") == s, F.col("at"))).alias(f"{s}_at") for s in STATUSES]
    return events.groupBy("document_id").agg(F.max_by("stage", F.struct("at", F.array_position(F.array(*map(F.lit, STATUSES)), F.col("stage")))).alias("status"), F.max("at").alias("updated_at"), F.count("*").alias("n_events"), *times)


def merged(folds: DataFrame) -> DataFrame:
    """One fold of several: states() of parts of the events, in any order, become states() of all of them."""
    times = [F.max(f"{s}_at").alias(f"{s}_at") for s in STATUSES]
    place = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))
    return folds.groupBy("document_id").agg(F.max_by("status", F.struct("updated_at", place)).alias("status"), F.max("updated_at").alias("updated_at"), F.sum("n_events").alias("n_events"), *times)


def lineage(events: DataFrame) -> DataFrame:
    """Per document its events in order of time. A document has a few events for each run."""
    return events.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("at", "stage"))).alias("lineage"))


def summary(assets: DataFrame) -> DataFrame:
    """Documents, documents by status (zeros kept), chunks and indexed chunks."""
    return assets.agg(F.count("*").alias("total_documents"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.coalesce(F.sum("total_chunks"), F.lit(0)).alias("total_chunks"), F.coalesce(F.sum("chunks_indexed"), F.lit(0)).alias("chunks_indexed"))


def mark(assets: DataFrame, updates: DataFrame) -> DataFrame:
    """assets with status taken from updates (document_id, status); updates of unknown documents are an error that the caller sees as rows of `unknown`."""
    return assets.join(updates.select("document_id", F.col("status").alias("_new")), "document_id", "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")


def unknown(assets: DataFrame, updates: DataFrame) -> DataFrame:
    return updates.join(assets.select("document_id"), "document_id", "left_anti")


def reindexed_after_classification(assets: DataFrame) -> DataFrame:
    return assets.filter("chunked_at > classified_at")


def stage_durations(assets: DataFrame, by: str) -> DataFrame:
    """Mean seconds between stages by a column."""
    gap = lambda a, b: F.avg(F.unix_micros(f"{b}_at") - F.unix_micros(f"{a}_at")) / 1e6
    return assets.groupBy(by).agg(F.count("*").alias("n"), F.round(gap("ingested", "classified"), 3).alias("classify_s"), F.round(gap("classified", "chunked"), 3).alias("chunk_s"))


def with_chunk_counts(assets: DataFrame, chunks: DataFrame, key: str = "document_id") -> DataFrame:
    """assets with total_chunks, counted in the chunk table, and chunks_indexed: all of them once the document is indexed."""
    counts = chunks.groupBy(key).agg(F.count("*").alias("total_chunks"))
    out = assets.join(counts, key, "left").withColumn("total_chunks", F.coalesce("total_chunks", F.lit(0)))
    return out.withColumn("chunks_indexed", F.when(F.col("status") == "indexed", F.col("total_chunks")).otherwise(0))


def lookup(assets: DataFrame, **values: str) -> DataFrame:
    """Assets by document_id, file_hash, status or department: those with all given values."""
    for column, value in values.items():
        assets = assets.filter(F.col(column) == value)
    return assets


def _batches(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the whole parts of the log: those with a mark of success."""
    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(f"{path}/{name}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(p.getName().split("=")[1]) for p in found if "=" in p.getName() and fs.exists(jvm.Path(p, "_SUCCESS")))


def save(events: DataFrame, path: str) -> int:
    """Append events (document_id, stage, at) to the log below path as its next batch; its number."""
    number = max(_batches(events.sparkSession, path, "events"), default=0) + 1
    events.select("document_id", "stage", "at").write.mode("overwrite").parquet(f"{path}/events/batch={number}")
    return number


def snapshot(spark: SparkSession, path: str) -> int:
    """Write the fold of all events so far; the last batch that it holds is its high-water mark. It goes by arrival, so an event that comes late is in a later batch, whatever its time."""
    batches = _batches(spark, path, "events")
    if not batches:
        raise FileNotFoundError(f"no events at {path}")
    load(spark, path).write.mode("overwrite").parquet(f"{path}/snapshots/upto={batches[-1]}")
    return batches[-1]


def load(spark: SparkSession, path: str) -> DataFrame:
    """states() of the whole log: the last snapshot, merged with the fold of the batches after it, which alone are read. FileNotFoundError without events."""
    batches, marks = _batches(spark, path, "events"), _batches(spark, path, "snapshots")
    if not batches:
        raise FileNotFoundError(f"no events at {path}")
    mark = max(marks, default=0)
    parts = [spark.read.parquet(f"{path}/snapshots/upto={mark}")] if mark else []
    tail = [f"{path}/events/batch={b}" for b in batches if b > mark]
    if tail:
        parts.append(states(spark.read.parquet(*tail)))
    return parts[0] if len(parts) == 1 else merged(parts[0].unionByName(parts[1]))


def record(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """Append the events of documents that the log knows, or that are ingested with them; the others are given back (document_id, stage, at) and not written."""
    first = events.filter(F.col("stage") == STATUSES[0]).select("document_id")
    known = (load(spark, path).select("document_id").union(first) if _batches(spark, path, "events") else first).distinct()
    save(events.join(known, "document_id", "left_semi"), path)
    return events.join(known, "document_id", "left_anti").select("document_id", "stage", "at")
