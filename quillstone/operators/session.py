"""Conversations: what of the history may be used, and how it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import access

KEPT, FOR_REWRITE = 5, 3


def visible_turns(turns: DataFrame, clearance: str) -> DataFrame:
    return turns.filter(access.visible_history(F.col("sensitivity_level"), clearance))


def last_turns(turns: DataFrame, n: int = KEPT) -> DataFrame:
    """The last n turns of each conversation."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("turn")))
    return turns.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def history_text(turns: DataFrame, n: int = FOR_REWRITE) -> DataFrame:
    """conv_id, history: the last n turns as lines by role; blank ones are skipped after the cut. At most n turns a conversation are gathered."""
    said = F.filter(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.trim(x["text"]) != "")
    lines = F.transform(said, lambda x: F.concat(F.initcap(x["role"]), F.lit(": "), x["text"]))
    return last_turns(turns, n).groupBy("conv_id").agg(F.array_join(lines, "\n").alias("history"))
