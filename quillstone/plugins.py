"""Places for models: classification, generation, embedding, judging. Without a model a document stays UNCLASSIFIED, an embedding is the hash one, and the others answer `unavailable`; nothing is guessed."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import text as T


class Classifier(Protocol):
    def __call__(self, text: str) -> dict: ...


def model_candidates(*names: str) -> list[str]:
    """Models named in the given environment variables (comma-separated), in order, each once."""
    found = [m.strip() for n in names for m in os.environ.get(n, "").split(",")]
    return list(dict.fromkeys(m for m in found if m))


#: Labels of a document that no model could classify. Its sensitivity counts as Restricted, so that it fails closed: a label of its own would have to be known to every access rule, and A7 counts such documents as Restricted.
UNCLASSIFIED = {"department": "UNCLASSIFIED", "doc_type": "UNCLASSIFIED", "language": "UNCLASSIFIED", "sensitivity": "Restricted", "confidence": 0.0, "classifier": "llm_failed", "error": "no model"}
LABELS = "department string, doc_type string, language string, sensitivity string, confidence double, classifier string, error string"


def classify(docs: DataFrame, backend: Classifier | None = None, chars: int = 1500) -> DataFrame:
    """docs with the labels of a backend that sees each text's first characters. A backend's exception, or none at hand, gives UNCLASSIFIED with the error told."""
    if backend is None:
        return docs.select("*", *[F.lit(v).alias(k) for k, v in UNCLASSIFIED.items()])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                try:
                    rows.append(UNCLASSIFIED | {"error": None} | backend((text or "")[:chars]))
                except Exception as e:
                    rows.append(UNCLASSIFIED | {"error": str(e)})
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(rows, columns=list(UNCLASSIFIED))], axis=1)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInPandas(run, f"{fields}, {LABELS}")


def generate(prompt: str, backend: Callable[[str], str] | None = None) -> tuple[str | None, str]:
    """(answer, status): generated, unavailable or error."""
    if backend is None:
        return None, "unavailable"
    try:
        return backend(prompt), "generated"
    except Exception as e:
        return None, f"error: {e}"


def _each(values: pd.Series, backend: Callable, kind: type) -> pd.DataFrame:
    """backend's answer to each value with its status: ok, empty for a null or blank value, or error: what was raised."""
    out = []
    for v in values:
        if v is None or not v.strip():
            out.append((None, "empty"))
            continue
        try:
            out.append((kind(backend(v)), "ok"))
        except Exception as e:
            out.append((None, f"error: {e}"))
    return pd.DataFrame(out, columns=["value", "status"])


def embed(docs: DataFrame, backend: Callable[[str], list[float]] | None = None, text: str = "content") -> DataFrame:
    """docs with embedding, embedding_source (llm, or hash_fallback where the backend fails or there is none) and embedding_status (ok, empty, unavailable or error: …). A text without a word has an empty embedding, which stands for zeros."""
    hashed = T.hash_vectors(F.coalesce(F.col(text), F.lit("")))
    if backend is None:
        return docs.select("*", hashed.alias("embedding"), F.lit("hash_fallback").alias("embedding_source"), F.lit("unavailable").alias("embedding_status"))

    @F.pandas_udf("value array<double>, status string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return _each(texts, backend, lambda v: [float(x) for x in v])

    told = docs.withColumn("_e", run(F.col(text)))
    own = F.col("_e.status") == "ok"
    return told.select(*docs.columns, F.when(own, F.col("_e.value")).otherwise(hashed).alias("embedding"), F.when(own, "llm").otherwise("hash_fallback").alias("embedding_source"), F.col("_e.status").alias("embedding_status"))


def judge(answers: DataFrame, backend: Callable[[str], float] | None = None, prompt: str = "prompt") -> DataFrame:
    """answers with judge_score (0 to 1, null without) and judge_status (ok, empty, unavailable, out of range, or error: …) of a backend that scores the prompt column."""
    if backend is None:
        return answers.select("*", F.lit(None).cast("double").alias("judge_score"), F.lit("unavailable").alias("judge_status"))

    @F.pandas_udf("value double, status string")
    def run(prompts: pd.Series) -> pd.DataFrame:
        return _each(prompts, backend, float)

    told = answers.withColumn("_j", run(F.col(prompt)))
    fine = F.col("_j.value").between(0, 1) & ~F.isnan("_j.value")
    status = F.when((F.col("_j.status") == "ok") & ~F.coalesce(fine, F.lit(False)), "out of range").otherwise(F.col("_j.status"))
    return told.select(*answers.columns, F.when(fine, F.col("_j.value")).alias("judge_score"), status.alias("judge_status"))
