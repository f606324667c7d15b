"""Operator 2: quality rules with thresholds that adapt to language and source, from mergeable quantile sketches. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import materialize, small

MIN_WORDS, MAX_REPEATED = 50, 50
#: A group with fewer rows takes the thresholds of its language, and a language with fewer those of all rows.
MIN_ROWS = 200
#: Metric: (integer expression over the base columns, whether low values count too).
METRICS = {
    "word_size": ("100 * word_chars div n_words", True),
    "symbols": ("1000 * n_symbols div n_words", False),
    "copied_lines": ("1000 * n_dup_lines div n_words", False),
    "repeats": ("1000 * n_repeat_words div n_words", False),
    "capitals": ("1000 * n_capitals div word_chars", False),
}
#: Where at least half of a group's rows have a metric at all, a value is out if it lies beyond the group's tenth or ninetieth percentile by more than BLUR and TAIL times the way from the median to there.
TAIL = 6
#: Where fewer have it, a value is out if an empty stretch of the group's sketch parts it from the body: the lowest stretch whose ends differ by the factor GAP and beyond which at most a MINORITY-th of the rows lie. Values count BLUR more here.
GAP, MINORITY = 6, 4
#: What isn't told apart: one find in a short text already makes some 20 in 1,000 words.
BLUR = 20
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SPACES = r"[\x20\x09-\x0D]+"


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once a row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Windows are told apart by 64-bit hashes of their words; places with equal neighbours in hash order are covered and counted."""
    n = F.size(words)
    hashes = F.transform(F.slice(words, 1, n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def places(hs: Column) -> Column:
        ranked = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        hit = _with(ranked, lambda s: F.filter(s, lambda x, i: same(F.get(s, i - 1), x) | same(F.get(s, i + 1), x)))
        return F.sort_array(F.transform(hit, lambda x: x["p"]))

    none = F.lit(0).cast("long")
    return F.when(n < 4, none).otherwise(_with(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), none).otherwise(_with(places(hs), covered))))


def quality_metrics(docs: DataFrame) -> DataFrame:
    """docs with the base columns, n_capitals and base_failed added. A null text counts as empty. Columns of these names are replaced."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def measures(w: Column) -> Column:
        joined = F.array_join(w, "")
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"), _repeated(w).alias("n_repeat_words"))

    found = _with(words, measures)
    out = docs.drop(*BASE, "n_capitals", "base_failed").withColumn("_m", found)
    repeats = _with(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    without = lambda chars: (F.length(text) - F.length(F.regexp_replace(text, chars, ""))).cast("long")
    out = out.select("*", F.col("_m.n_words").alias("n_words"), F.col("_m.word_chars").alias("word_chars"), without(r"[#*$%&|<>]+").alias("n_symbols"), repeats.cast("long").alias("n_dup_lines"), F.col("_m.n_repeat_words").alias("n_repeat_words"), without("[A-Z]+").alias("n_capitals"))
    return out.drop("_m").withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words"))


def sketch(measured: DataFrame) -> DataFrame:
    """Quantile sketch of each metric by language and source: (lang, source, metric, low, n). A bin holds values that share their highest six bits, so a quantile is off by 1/32 of itself at most; bins of two sketches merge by adding n. Rows that failed the base rules don't count."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(e).cast("long").alias("v")) for m, (e, _) in METRICS.items()])
    values = measured.filter("not base_failed").select("lang", "source", F.inline(pairs))
    low = F.expr("shiftleft(shiftright(v, cast(greatest(length(bin(v)) - 6, 0) as int)), cast(greatest(length(bin(v)) - 6, 0) as int))")
    return values.withColumn("low", low).groupBy("lang", "source", "metric", "low").agg(F.count("*").alias("n"))


def limits(sketches: DataFrame, by: list[str]) -> DataFrame:
    """By group and metric: rows, the percentiles q10, q50 and q90, and the least (`low`) and greatest (`high`) value that isn't out; null without such. Sketches of the groups inside merge first; a group has at most some 1,900 bins, whatever its rows."""
    merged = sketches.groupBy(*by, "metric", "low").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "metric")
    ranked = merged.select("*", F.sum("n").over(group.orderBy("low")).alias("upto"), F.sum("n").over(group).alias("rows"), F.lead("low").over(group.orderBy("low")).alias("next"))
    at = lambda q: F.min(F.when(F.col("upto") * 10 >= F.col("rows") * q, F.col("low")))
    parted = F.expr(f"next + {BLUR} >= {GAP} * (low + {BLUR}) and {MINORITY} * (rows - upto) <= rows")
    # the middle of the stretch, as factors go
    middle = F.floor(F.sqrt((F.col("low") + BLUR) * (F.col("next") + BLUR))) - BLUR
    told = ranked.groupBy(*by, "metric").agg(F.max("rows").alias("rows"), at(1).alias("q10"), at(5).alias("q50"), at(9).alias("q90"), F.min(F.when(parted, middle)).alias("split"))
    way = lambda a, b: F.expr(f"{TAIL} * greatest({b} - {a}, q50 div 16) + {BLUR}")
    return told.select(
        *by, "metric", "rows", "q10", "q50", "q90", F.when(F.col("q50") > 0, F.col("q10") - way("q10", "q50")).alias("low"), F.when(F.col("q50") > 0, F.col("q90") + way("q50", "q90")).otherwise(F.col("split")).alias("high")
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """lang, source and for each metric the greatest, and where low values count the least, accepted value; null where all are."""
    own, lang, everything = limits(sketches, ["lang", "source"]), limits(sketches, ["lang"]), limits(sketches, [])
    name = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    a, b, c = own, name(lang, "l"), name(everything, "a")
    # languages and metrics are few rows a group: these joins have sketches' sizes, not the corpus's
    both = a.join(b, a["lang"].eqNullSafe(b["l_lang"]) & (a["metric"] == b["l_metric"])).join(F.broadcast(c), F.col("metric") == F.col("a_metric"))
    enough = lambda p: F.col(f"{p}rows") >= MIN_ROWS
    pick = lambda q: F.when(enough(""), F.col(q)).when(enough("l_"), F.col(f"l_{q}")).otherwise(F.col(f"a_{q}"))
    fences = both.select("lang", "source", "metric", pick("low").alias("low"), pick("high").alias("high"))
    cols = []
    for m, (_, both_sides) in METRICS.items():
        here = F.col("metric") == m
        cols.append(F.max(F.when(here, F.col("high"))).alias(f"{m}_high"))
        if both_sides:
            cols.append(F.max(F.when(here, F.col("low"))).alias(f"{m}_low"))
    return fences.groupBy("lang", "source").agg(*cols)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured with `kept`: false if the base rules failed, else whether every metric lies within the limits of the row's language and source. Null languages and sources are groups of their own."""
    names = limits.columns
    renamed = limits.select(*[F.col(c).alias(f"_{c}") for c in names])
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    tests = []
    for m, (e, both_sides) in METRICS.items():
        tests.append(F.coalesce(F.expr(e) <= F.col(f"_{m}_high"), F.lit(True)))
        if both_sides:
            tests.append(F.coalesce(F.expr(e) >= F.col(f"_{m}_low"), F.lit(True)))
    verdict = F.when(F.col("base_failed"), False).otherwise(reduce(lambda a, b: a & b, tests))
    return measured.join(small(renamed), same, "left").withColumn("kept", verdict).drop(*renamed.columns)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base columns, n_capitals, base_failed and kept for every row of docs.

    Null and empty texts have no words and fail; null languages and sources form groups; small groups take wider ones' thresholds; repeated rows each count; ties at a limit are kept; texts of any length are read whole; further columns don't matter; an empty table gives no rows.
    The measures are written once; the sketch, the limits and the join read that table, which holds no text.
    """
    measured = materialize(quality_metrics(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    limits = materialize(thresholds(sketch(measured)))
    return judge(measured, limits).select("doc_id", *BASE, "n_capitals", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns, whatever their names; nulls, ties and repeated rows as in quality_rules; an empty table gives no rows.

    The rows are measured once and written beside their measures; the sketch reads the measures alone, and the filter both. No text is shuffled.
    """
    whole = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), "text", "lang", "source")
    measured = materialize(quality_metrics(whole).drop("text"))
    limits = materialize(thresholds(sketch(measured)))
    return judge(measured, limits).filter("kept").select("_row.*")


def _level_sql(number: int, table: str, by: str) -> str:
    """limits() of one level of groups."""
    group = f"partition by {by}metric"
    ranks = f"select {by}metric, low, sum(n) over ({group} order by low) u, sum(n) over ({group}) z, lead(low) over ({group} order by low) x from {table}"
    told = f"select {by}metric, max(z) z, min(low) filter (u * 10 >= z) t, min(low) filter (u * 10 >= z * 5) m, min(low) filter (u * 10 >= z * 9) n, min(floor(sqrt((low + 20) * (x + 20))) - 20) filter (x + 20 >= 6 * (low + 20) and 4 * (z - u) <= z) g from a{number} group by all"
    return f"a{number} as ({ranks}),\nq{number} as (select {by}metric, z, case when m > 0 then t - 6 * greatest(m - t, m // 16) - 20 end lo, case when m > 0 then n + 6 * greatest(n - m, m // 16) + 20 else g end hi from ({told}))"


#: The same in DuckDB SQL. Windows are compared as texts there.
SQL = """
with t as (select doc_id, lang, source, coalesce(text, '') x from documents),
w as (select doc_id, lang, source, x, list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda e: e <> '') ws, list_filter(string_split(x, chr(10)), lambda e: regexp_matches(e, '[^\\x20\\x09-\\x0D]')) ls, row_number() over () rid from t),
g as (select rid, unnest(range(1, len(ws) - 1)) p, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) k from w where len(ws) > 3),
r as (select rid, p from g qualify count(*) over (partition by rid, k) > 1),
c as (select rid, count(distinct q) n from (select rid, unnest([p, p + 1, p + 2]) q from r) group by rid),
m as (
  select doc_id, lang, source, cast(len(ws) as bigint) n_words, cast(length(array_to_string(ws, '')) as bigint) word_chars, cast(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines, cast(coalesce(n, 0) as bigint) n_repeat_words, cast(length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) as bigint) n_capitals
  from w left join c using (rid)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m),
v as (
  select lang, source, unnest(['word_size', 'symbols', 'copied_lines', 'repeats', 'capitals']) metric, unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_words, 1000 * n_repeat_words // n_words, 1000 * n_capitals // word_chars]) v
  from f where not base_failed),
s as (select lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)::bigint) << greatest(length(bin(v)) - 6, 0)::bigint low, count(*) n from v group by all),
s2 as (select lang, metric, low, sum(n) n from s group by all),
s3 as (select metric, low, sum(n) n from s group by all),
{levels},
l as (
  select q1.lang, q1.source, q1.metric, case when q1.z >= 200 then q1.lo when q2.z >= 200 then q2.lo else q3.lo end lo, case when q1.z >= 200 then q1.hi when q2.z >= 200 then q2.hi else q3.hi end hi
  from q1 join q2 on q1.lang is not distinct from q2.lang and q1.metric = q2.metric join q3 on q1.metric = q3.metric),
b as (
  select lang, source, max(hi) filter (metric = 'word_size') wh, max(lo) filter (metric = 'word_size') wl, max(hi) filter (metric = 'symbols') sh, max(hi) filter (metric = 'copied_lines') ch, max(hi) filter (metric = 'repeats') rh, max(hi) filter (metric = 'capitals') kh
  from l group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, base_failed,
  case when base_failed then false else coalesce(100 * word_chars // n_words <= wh, true) and coalesce(100 * word_chars // n_words >= wl, true) and coalesce(1000 * n_symbols // n_words <= sh, true)
    and coalesce(1000 * n_dup_lines // n_words <= ch, true) and coalesce(1000 * n_repeat_words // n_words <= rh, true) and coalesce(1000 * n_capitals // word_chars <= kh, true) end kept
from f left join b on f.lang is not distinct from b.lang and f.source is not distinct from b.source
""".replace("{levels}", ",\n".join(_level_sql(k + 1, t, by) for k, (t, by) in enumerate([("s", "lang, source, "), ("s2", "lang, "), ("s3", "")])))
