"""Helpers that the training-data operators share: shared scratch tables and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.session import shared_dir, ship

__all__ = ["input_bytes", "materialize", "shared_dir", "ship", "shuffle_partitions", "small", "table"]

#: Rows and bytes up to which a small table (thresholds, offsets) is broadcast; beyond them the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, compression: str = "zstd", partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back, so that a lost executor costs no recomputation and each later reader sees the same rows."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast df if its checked size allows; else leave the join to a shuffle. df should be materialized."""
    return F.broadcast(df) if input_bytes(df) <= BROADCAST_BYTES and df.limit(rows + 1).count() <= rows else df


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of df."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
