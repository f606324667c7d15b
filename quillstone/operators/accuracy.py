"""Accuracy of labels against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quillstone.sources.files import stem

FIELDS = ["department", "doc_type", "language", "sensitivity"]
#: Predicted types that count as right for a true type.
EQUIVALENTS = {
    "article": ["document", "report", "article"],
    "report": ["document", "report"],
    "reference": ["document", "reference"],
    "datasheet": ["data table", "datasheet", "spreadsheet"],
    "announcement": ["document"],
    "memo": ["document"],
    "press release": ["document", "report"],
    "statement": ["document"],
    "blog post": ["document"],
    "procedure": ["document"],
}


def normal(value: Column) -> Column:
    return F.lower(F.trim(F.coalesce(value, F.lit(""))))


def matches(truth: Column, predicted: Column, equivalents: bool = False) -> Column:
    t, p = normal(truth), normal(predicted)
    if not equivalents:
        return t == p
    same = t == p
    for name, others in EQUIVALENTS.items():
        same = same | ((t == name) & p.isin(others))
    return same


def field_accuracy(rows: DataFrame, equivalents: bool = False, only_present: bool = False, exact: bool = False) -> DataFrame:
    """field, n_correct, n_total, accuracy_pct over rows with true_<field> and <field>; doc_type may match by equivalence, and exact minds case and space. Missing truths count unless only_present."""
    right = lambda f: F.col(f"true_{f}").eqNullSafe(F.col(f)) if exact else matches(F.col(f"true_{f}"), F.col(f), equivalents and f == "doc_type")
    long = F.array(*[F.struct(F.lit(f).alias("field"), right(f).alias("ok"), F.col(f"true_{f}").isNotNull().alias("present")) for f in FIELDS])
    out = rows.select(F.inline(long))
    out = out.filter("present") if only_present else out
    return out.groupBy("field").agg(F.count_if("ok").alias("n_correct"), F.count("*").alias("n_total"), F.round(100.0 * F.count_if("ok") / F.count("*"), 1).alias("accuracy_pct"))


def overall(fields: DataFrame) -> DataFrame:
    """All fields' right answers over all their answers."""
    right, every = F.sum("n_correct"), F.sum("n_total")
    return fields.agg(right.alias("n_correct"), every.alias("n_total"), F.round(100.0 * right / F.nullif(every, F.lit(0)), 1).alias("accuracy_pct"))


def load_truth(lines: DataFrame, order: str) -> DataFrame:
    """Ground truth by file, with its stem: lines without a filename are left out, and of lines with the same one the last by `order` counts."""
    held = last_by_key(lines.filter(F.col("filename").isNotNull()), "filename", order)
    return held.withColumn("stem", stem(F.col("filename"))).drop(order)


def exact_match(rows: DataFrame) -> DataFrame:
    """Share of rows with all fields equal, case included, and the confidences' mean and bounds."""
    ok = F.lit(True)
    for f in FIELDS:
        ok = ok & F.col(f"true_{f}").eqNullSafe(F.col(f))
    return rows.agg(F.count("*").alias("n"), F.count_if(ok).alias("n_exact"), F.round(F.avg("confidence"), 4).alias("avg_confidence"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"))


def corrected_truth(truth: DataFrame) -> DataFrame:
    """Ground truth as corrected: every sensitivity Public; topic tables belong to General. With flags of what changed."""
    topics = F.col("filename").like("%\\_topics\\_%.csv")
    out = truth.withColumn("changed_sensitivity", ~F.col("true_sensitivity").eqNullSafe(F.lit("Public"))).withColumn("changed_department", topics & ~F.col("true_department").eqNullSafe(F.lit("General")))
    return out.withColumn("true_sensitivity", F.lit("Public")).withColumn("true_department", F.when(topics, "General").otherwise(F.col("true_department")))


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def strong_sample(truth: DataFrame, n: int = 10) -> DataFrame:
    """A small sample that covers many classes: new department or type count 4, new language or sensitivity 2. Among candidates that add nothing the last is taken.

    Only the first and the last n files of each combination of labels can be chosen; Spark finds these, and the greedy choice runs over them on the driver. Combinations are few, as labels are.
    """
    labels = [f"true_{f}" for f in FIELDS]
    usable = truth.filter("not coalesce(is_ambiguous, false) and is_duplicate_of is null").select("filename", *labels)
    group = Window.partitionBy(*labels)
    first, last = (usable.withColumn("_r", F.row_number().over(group.orderBy(o("filename")))).filter(F.col("_r") <= n).drop("_r") for o in (F.asc, F.desc))
    rows: list[Row] = first.unionByName(last).distinct().collect()
    pool = sorted({(r["filename"], tuple(r[x] for x in labels)) for r in rows}, key=lambda x: x[0])
    seen: list[set] = [set() for _ in labels]
    out: list[str] = []
    while pool and len(out) < n:
        gains = [sum(w for w, s, v in zip((4, 4, 2, 2), seen, labels_of, strict=True) if v not in s) for _, labels_of in pool]
        best = gains.index(max(gains)) if max(gains) > 0 else len(pool) - 1
        name, values = pool.pop(best)
        out.append(name)
        for s, v in zip(seen, values, strict=True):
            s.add(v)
    return usable.filter(F.col("filename").isin(out))
