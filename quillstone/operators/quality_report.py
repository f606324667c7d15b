"""Corpus quality scores, their mean, and drift between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import access, text as T

TINY_WORDS = 5
DRIFT = -5.0


def chunk_health(chunks: DataFrame, order: list[str]) -> DataFrame:
    """chunks with health: tiny (under five words), duplicate (of an earlier healthy chunk) or healthy. First occurrences are found by partial minima, so texts with many copies are no hot group."""
    norm = F.lower(T.collapse(F.col("content")))
    rows = chunks.withColumn("_norm", F.sha2(norm, 256)).withColumn("_tiny", F.size(T.words(F.col("content"))) < TINY_WORDS)
    first = rows.filter("not _tiny").groupBy("_norm").agg(F.min(F.struct(*order)).alias("_first"))
    mark = first.select(*[F.col(f"_first.{c}").alias(c) for c in order], F.lit(True).alias("_is_first"))
    out = rows.join(mark, order, "left")
    return out.withColumn("health", F.when(F.col("_tiny"), "tiny").when(F.col("_is_first"), "healthy").otherwise("duplicate")).drop("_norm", "_tiny", "_is_first")


def percent(part, whole):
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 1)


def scores(chunks: DataFrame) -> DataFrame:
    """metric, score over the index: embedding_coverage, sensitivity_label_validity, department_coverage, chunk_health; null where nothing can be counted.

    Each content that is not tiny has one healthy chunk, whichever comes first, so one pass over the chunks counts by content and a second step sums up.
    """
    words = T.words(F.col("content"))
    source = F.col("embedding_source")
    rows = chunks.select(
        T.let(words, lambda w: F.struct((F.size(w) < TINY_WORDS).alias("tiny"), F.sha2(F.lower(F.array_join(w, " ")), 256).alias("norm"))).alias("k"),
        (source == "llm").alias("llm"), source.isin("llm", "hash_fallback").alias("embedded"), F.col("sensitivity").isin(access.SENSITIVITY).alias("labelled"), (~F.coalesce(F.col("department").isin("", "General"), F.lit(True))).alias("placed"),
    )
    groups = rows.groupBy("k.tiny", "k.norm").agg(F.count("*").alias("n"), *[F.count_if(c).alias(c) for c in ("llm", "embedded", "labelled", "placed")])
    every = F.coalesce(F.sum("n"), F.lit(0))
    agg = groups.agg(
        percent(F.coalesce(F.sum("llm"), F.lit(0)), F.sum("embedded")).alias("embedding_coverage"),
        percent(F.sum("labelled"), every).alias("sensitivity_label_validity"),
        percent(F.sum("placed"), every).alias("department_coverage"),
        percent(F.count_if(~F.col("tiny")), every).alias("chunk_health"),
    )
    return agg.unpivot([], agg.columns, "metric", "score")


def overall(scored: DataFrame) -> DataFrame:
    """Mean of the scores that exist."""
    return scored.agg(F.round(F.avg("score"), 1).alias("overall_score"), F.count("score").alias("n_scored"))


def drift(history: DataFrame) -> DataFrame:
    """run, metric, score, previous, delta, status: each run against the one before. Pairs with a missing score are left out; the first run has no baseline."""
    series = Window.partitionBy("metric").orderBy("run")
    rows = history.withColumn("previous", F.lag("score").over(series)).withColumn("place", F.row_number().over(series))
    status = F.when(F.col("place") == 1, "no_baseline").when(F.round(F.col("score") - F.col("previous"), 6) < DRIFT, "drift").otherwise("stable")
    return rows.filter("place = 1 or (score is not null and previous is not null)").select("run", "metric", "score", "previous", F.round(F.col("score") - F.col("previous"), 3).alias("delta"), status.alias("status"))


def latest(history: DataFrame) -> DataFrame:
    """Scores of the last run."""
    return history.groupBy("metric").agg(F.max("run").alias("run"), F.max_by("score", "run").alias("score"))


def trend(history: DataFrame) -> DataFrame:
    """Each metric's scores in order of runs, with their place from 1."""
    place = F.row_number().over(Window.partitionBy("metric").orderBy("run"))
    return history.filter("score is not null").select("run", "metric", "score", place.alias("place"))


def save_report(scored: DataFrame, run: str, path: str) -> None:
    """Append a run's scores to the history at path."""
    scored.select(F.lit(run).alias("run"), "metric", F.col("score").cast("double").alias("score")).write.mode("append").parquet(path)
