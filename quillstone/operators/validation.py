"""Rules over classification labels, and summaries of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.access import DEPARTMENTS, SENSITIVITY, rank

#: Document types, expected languages, the least confidence, types that must be Confidential at least.
DOC_TYPES = ["Policy", "Invoice", "Report", "Contract", "Data Table", "Document", "Email"]
LANGUAGES = ["EN", "FR", "AR"]
MIN_CONFIDENCE = 0.5
SENSITIVE_TYPES = ["Contract"]


def _violation(when: Column, rule: str, severity: str, message: Column) -> Column:
    return F.when(when, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), message.alias("message")))


def _not_in(column: str, known: list[str]) -> Column:
    return F.coalesce(~F.col(column).isin(known), F.lit(True))


def _said(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def violations() -> Column:
    """array<struct<rule, severity, message>> in the order of the rules; a failed classification is the only one reported of its row."""
    failed = F.coalesce(F.col("classifier") == "llm_failed", F.lit(False)) | F.coalesce(F.col("department") == "UNCLASSIFIED", F.lit(False))
    under = F.col("doc_type").isin(SENSITIVE_TYPES) & F.col("sensitivity").isin(SENSITIVITY) & (rank(F.col("sensitivity")) < SENSITIVITY.index("Confidential"))
    text = F.concat
    rules = [
        _violation(_not_in("department", DEPARTMENTS), "unknown_department", "error", text(F.lit("department "), _said("department"), F.lit(f" is none of {', '.join(sorted(DEPARTMENTS))}"))),
        _violation(_not_in("doc_type", DOC_TYPES), "unknown_doc_type", "error", text(F.lit("type "), _said("doc_type"), F.lit(f" is none of {', '.join(sorted(DOC_TYPES))}"))),
        _violation(_not_in("sensitivity", SENSITIVITY), "unknown_sensitivity", "error", text(F.lit("sensitivity "), _said("sensitivity"), F.lit(f" is none of {', '.join(SENSITIVITY)}; it counts as Restricted"))),
        _violation(_not_in("language", LANGUAGES), "unexpected_language", "warning", text(F.lit("language "), _said("language"), F.lit(f" is none of {', '.join(sorted(LANGUAGES))}"))),
        _violation(F.col("confidence").isNull(), "missing_confidence", "error", F.lit("no usable confidence")),
        _violation(F.coalesce(F.col("confidence") < MIN_CONFIDENCE, F.lit(False)), "low_confidence", "warning", F.format_string(f"confidence %.2f is below {MIN_CONFIDENCE}", F.col("confidence"))),
        _violation(F.coalesce(under, F.lit(False)), "contract_under_classified", "error", text(_said("doc_type"), F.lit(" marked "), _said("sensitivity"), F.lit(", must be Confidential at least"))),
    ]
    alone = F.array(_violation(F.lit(True), "classification_failed", "error", F.lit("no classification: the model failed or was denied")))
    return F.when(failed, alone).otherwise(F.array_compact(F.array(*rules)))


def validate(records: DataFrame) -> DataFrame:
    """records with violations, passed and needs_review."""
    out = records.withColumn("violations", violations())
    return out.withColumn("passed", F.size("violations") == 0).withColumn("needs_review", F.exists("violations", lambda v: v["severity"] == "error"))


def summary(validated: DataFrame) -> DataFrame:
    """total, passed, needs_review, pass_rate; the rate of no records is null."""
    return validated.agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if("needs_review").alias("needs_review"),
        F.round(F.count_if("passed") / F.nullif(F.count("*"), F.lit(0)), 4).alias("pass_rate"),
    )


def label_histogram(records: DataFrame, columns: list[str]) -> DataFrame:
    """field, label, n over all columns in one pass; missing labels count as Unknown."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Unknown")).alias("label")) for c in columns])
    return records.select(F.inline(pairs)).groupBy("field", "label").agg(F.count("*").alias("n"))


def run_summary(validated: DataFrame) -> DataFrame:
    """A classification run's counts: total, failed, denied and to be reviewed. Needs classifier and access_denied beside the verdicts."""
    return validated.agg(F.count("*").alias("total_classified"), F.count_if(F.col("classifier") == "llm_failed").alias("failed"), F.count_if("access_denied").alias("access_denied"), F.count_if("needs_review").alias("needs_review"))


def first_rows(rows: DataFrame, order: str, say: str, n: int = 5) -> DataFrame:
    """place, order and say of the first n rows, and a line that tells how many more there are."""
    top = rows.select(order, say).orderBy(order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(order)))
    more = rows.agg(F.count("*").alias("n")).filter(F.col("n") > n).select(F.lit(n + 1).alias("place"), F.lit(None).cast(rows.schema[order].dataType).alias(order), F.format_string("... and %d more", F.col("n") - n).alias(say))
    return top.select("place", order, say).unionByName(more)
