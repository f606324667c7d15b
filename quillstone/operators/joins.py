"""Lookups by key that also tell what found no partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matched(left: DataFrame, right: DataFrame, key: str, right_name: str, left_name: str) -> DataFrame:
    """Full join on key with status: matched, missing_<right_name> for rows of left alone, missing_<left_name> for rows of right alone. Other columns of the two must differ; null keys match nothing."""
    a, b = left.withColumn("_left", F.lit(True)), right.withColumn("_right", F.lit(True))
    status = F.when(F.col("_right").isNull(), f"missing_{right_name}").when(F.col("_left").isNull(), f"missing_{left_name}").otherwise("matched")
    return a.join(b, key, "full").withColumn("status", status).drop("_left", "_right")


def selected(left: DataFrame, right: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Rows of both with the same key; with keys, of those alone."""
    some = left if keys is None else left.join(keys.select(key), key, "left_semi")
    return some.join(right, key)
