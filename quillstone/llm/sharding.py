"""Operator 5: shards by jump consistent hashing (Lamping and Veach, 2014), with gapless slots inside each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quillstone.llm.common import materialize, ship, small


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. Going from n to n + 1 shards, a key either stays or moves to shard n."""
    key = keys.astype(np.uint64)
    b = np.full(len(key), -1, np.int64)
    j = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        b[live] = j[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        j[live] = ((b[live] + 1) * (2.0**31 / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live = live[j[live] < shards]
    return b.astype(np.int32)


def _assign(shards: int):
    def run(batches):
        """Shard and place among this task's rows of that shard; the counters are one number a shard."""
        seen = np.zeros(shards, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column("jump_key").to_numpy(zero_copy_only=False)
            shard = jump_hash(keys, shards)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            place = np.empty(len(shard), np.int64)
            place[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts)
            place += seen[shard]
            seen += counts
            columns = [batch.column("row"), pa.array(shard, pa.int32()), pa.array(jump_hash(keys, shards + 1), pa.int32()), pa.array(np.full(len(shard), part), pa.int32()), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "shard", "grown_shard", "part", "place"])

    return run


def shard_rows(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add shard, grown_shard (with one shard more) and slot (gapless from 0 in each shard) to df's columns.

    The key and the number of shards alone decide the shard; a null key is replaced by a hash of the whole row, so that rows without a key spread.
    Slots need no shuffle of rows by shard: each task numbers its own rows of a shard, and the tasks' counts are summed up. A shard or a key with any share of the rows is thus never gathered in one task.
    Repeated rows are all kept, each with a slot of its own. An empty table gives an empty result. Null and empty texts, and texts of any length, are columns like any other. df's columns may have any names but the three that are added; those are an error.
    """
    if clash := {"shard", "grown_shard", "slot"} & set(df.columns):
        raise ValueError(f"columns that shard_rows adds stand in the table already: {sorted(clash)}")
    ship(df.sparkSession)
    names = [f"`{c}`" for c in df.columns]
    keyed = df.select(F.struct(*names).alias("row"), F.when(F.col(f"`{key}`").isNotNull(), F.xxhash64(f"`{key}`")).otherwise(F.xxhash64(*names)).alias("jump_key"))
    added = StructType([StructField("row", df.schema), *(StructField(n, t) for n, t in (("shard", IntegerType()), ("grown_shard", IntegerType()), ("part", IntegerType()), ("place", LongType())))])
    out = materialize(keyed.mapInArrow(_assign(shards), added))
    counts = out.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return out.join(small(offsets), ["shard", "part"]).select("row.*", "shard", "grown_shard", (F.col("offset") + F.col("place")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The digest of every document with its shard: doc_id, size (UTF-8 bytes of the text plus 8; null text: 8), text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(base, "doc_id", shards).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
