"""Expressions around questions and model answers: small talk, language status, error signals, JSON in answers."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from quillstone.functions.text import trim

#: Greetings and acknowledgements that are no questions.
SMALLTALK = [
    "hi", "hello", "hey", "yo", "sup", "howdy", "thanks", "thank you", "thx", "ok", "okay", "cool", "great", "nice", "bye", "goodbye", "see you",
    "good morning", "good afternoon", "good evening", "how are you", "how are you today", "how's it going", "what's up",
    "salut", "bonjour", "bonsoir", "coucou", "merci", "d'accord", "ok merci", "au revoir", "à bientôt", "ça va", "comment ça va",
    "مرحبا", "أهلا", "شكرا", "مع السلامة", "السلام عليكم",
]
#: Single words whose misspellings count too.
FUZZY = ["hi", "hello", "hey", "yo", "sup", "howdy", "thanks", "thx", "ok", "okay", "bye", "salut", "bonjour", "bonsoir", "coucou", "merci"]
#: What tells a rate limit and a denied access in an error message.
RATE_LIMIT = ["429", "resource_exhausted", "rate limit"]
ACCESS_DENIED = ["access denied", "unauthorized", "invalid api key", "invalid_api_key", "authentication", "permission", "403", "401", "api key not valid", "insufficient balance", "insufficient_quota"]
EXPECTED_LANGUAGES = ["en", "fr", "ar"]
MIN_CHARS = 12


def smalltalk_form(text: Column) -> Column:
    return F.regexp_replace(F.lower(trim(text)), "[!.?،؟]+$", "")


def is_smalltalk(text: Column) -> Column:
    return smalltalk_form(text).isin(SMALLTALK)


@F.pandas_udf(BooleanType())
def is_near_smalltalk(text: pd.Series) -> pd.Series:
    """At most three words, the first close to a greeting: lengths at most 2 apart and a difflib ratio of 0.8 or more."""

    def near(t: str | None) -> bool:
        found = re.findall(r"[^\W\d_]+", (t or "").strip().lower().rstrip("!.?،؟"))
        if not found or len(found) > 3:
            return False
        return bool(difflib.get_close_matches(found[0], [w for w in FUZZY if abs(len(w) - len(found[0])) <= 2], n=1, cutoff=0.8))

    return text.map(near)


def language_status(text: Column, detected: Column, available: Column | bool = True) -> Column:
    """Status of a detector's answer: detector_unavailable, too_short, detection_failed, outside_expected_languages or detected."""
    there = F.lit(available) if isinstance(available, bool) else available
    return F.when(~there, "detector_unavailable").when(F.length(trim(text)) < MIN_CHARS, "too_short").when(detected.isNull(), "detection_failed").when(detected.isin(EXPECTED_LANGUAGES), "detected").otherwise("outside_expected_languages")


def contains_any(message: Column, signals: list[str]) -> Column:
    out = F.lit(False)
    for s in signals:
        out = out | F.lower(message).contains(s)
    return F.coalesce(out, F.lit(False))


def json_part(answer: Column) -> Column:
    """The JSON object in an answer, without code fences and text around it; empty if there is none."""
    bare = F.regexp_replace(trim(answer), r"^```(?:json)?|```$", "")
    return F.regexp_extract(bare, r"(?s)(\{.*\})", 1)


def clamp(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def confidence(raw: Column) -> Column:
    """A number in [0, 1], else 0.85."""
    value = F.expr("null").cast("double") if raw is None else raw.try_cast("double")
    return F.when(value.between(0, 1), value).otherwise(0.85)


def rewrite_status(question: Column, turns: Column, available: Column | bool = False, answer: Column | None = None, failed: Column | bool = False) -> Column:
    """What becomes of a follow-up question: smalltalk, no_history, unavailable (no model), error, unparseable (a blank answer), unnecessary (the question again) or rewritten."""
    flag = lambda x: F.lit(x) if isinstance(x, bool) else x
    said = F.coalesce(trim(F.regexp_replace(trim(F.lit(None).cast("string") if answer is None else answer), '^"+|"+$', "")), F.lit(""))
    same = F.lower(said) == F.lower(trim(question))
    out = F.when(is_smalltalk(question), "smalltalk").when(F.coalesce(turns, F.lit(0)) == 0, "no_history").when(~flag(available), "unavailable")
    return out.when(flag(failed), "error").when(said == "", "unparseable").when(same, "unnecessary").otherwise("rewritten")


def judge(answer: Column, context: Column, available: Column | bool = False, raw: Column | None = None, failed: Column | bool = False) -> Column:
    """struct<status, score> of a faithfulness check: no_context, unavailable (no judge), error, unparseable, or judged with a score from 0 to 1. A blank answer claims nothing and scores 1; else no score is made up."""
    flag = lambda x: F.lit(x) if isinstance(x, bool) else x
    blank = lambda c: F.coalesce(trim(c), F.lit("")) == ""
    told = F.lit(None).cast("string") if raw is None else raw
    value = F.from_json(F.nullif(json_part(told), F.lit("")), "score string")["score"].try_cast("double")
    status = F.when(blank(context), "no_context").when(blank(answer), "judged").when(~flag(available), "unavailable").when(flag(failed), "error").when(value.isNull(), "unparseable").otherwise("judged")
    score = F.when(status == "judged", F.when(blank(answer), 1.0).otherwise(clamp(value)))
    return F.struct(status.alias("status"), score.alias("score"))


def time_label(raw: Column) -> Column:
    """An ISO time as `Nov 28, 2026 · 09:05 UTC`; unknown for none, and what is no time as it stands."""
    at = F.to_utc_timestamp(F.try_to_timestamp(raw), F.current_timezone())
    return F.when(F.coalesce(raw, F.lit("")).isin("", "unknown"), "unknown").otherwise(F.coalesce(F.date_format(at, "MMM dd, yyyy · HH:mm 'UTC'"), raw))


def band(score: Column) -> Column:
    return F.when(score.isNull(), "muted").when(score >= 85, "good").when(score >= 65, "warn").otherwise("bad")


def preview(text: Column, size: int = 100) -> Column:
    flat = F.regexp_replace(trim(text), "\n", " ")
    return F.when(F.length(flat) > size, F.concat(F.substring(flat, 1, size), F.lit("..."))).otherwise(flat)
