"""Operator 12: URL filters by rules and by a Bloom filter cascade: levels in turn hold the listed keys and the other keys that the levels before let through, until none is wrong, so membership is exact for every key of the corpus and needs no join. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialize

#: Rules (host, path, verdict) of the registered query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: The registered query's list: addresses of hosts of which a label has one of these words between hyphens.
JUNK = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "viagra", "xxx"]
_JUNK_HOST = f"(^|[.-])({'|'.join(JUNK)})([.-]|$)"

#: Hash functions of the levels after the first, and the bounds of the first level's.
HASHES, LEAST_HASHES, MOST_HASHES = 4, 4, 30
#: Bytes that all levels of a cascade may take in a task. A list that needs more (some 20 million keys) is met by a join.
MAX_BYTES = 64 << 20
#: 64-bit words in an inner array of a level: 2^18 bits.
INNER = 1 << 12
MAX_LEVELS = 64


def host(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A to Z in lower case; empty without."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host and path together) that fits the host or a domain above it and the path's beginning, and its verdict; nulls without. Of equally long ones the first counts."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Level:
    """Bits as rows (c, longs), `size` of them, of which each key sets `hashes`. `number` salts the hashes."""

    number: int
    size: int
    hashes: int
    rows: DataFrame

    def bits(self) -> Column:
        """All bits as array<array<long>>: a scalar subquery, computed once a query and read in place by the tasks."""
        return self.rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "longs"))), lambda x: x["longs"]).alias("b")).scalar()

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.size).cast("long")) for j in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        bits = self.bits()
        tests = [F.getbit(F.get(F.get(bits, F.shiftright(p, 18).cast("int")), F.shiftright(p, 6).bitwiseAND(INNER - 1).cast("int")), p.bitwiseAND(63).cast("int")) == 1 for p in self.places(key)]
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Cascade:
    """Exact membership of the keys that it was built over; for others the answer may be wrong."""

    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether key is listed: decided by the first level that doesn't hold it, or by the last."""
        out = F.lit(bool(len(self.levels) % 2))
        for level in reversed(self.levels):
            out = F.when(level.holds(key), out).otherwise(F.lit(bool(level.number % 2)))
        return out

    @property
    def size_bytes(self) -> int:
        return sum(x.size for x in self.levels) // 8


def _size(keys: int, hashes: int) -> int:
    """Bits for so many keys at which half of them are set, in whole words."""
    return 64 * math.ceil(keys * hashes / math.log(2) / 64)


def _fill(number: int, size: int, hashes: int, keys: DataFrame) -> Level:
    """The level of keys. Words are added up in the tasks before the shuffle; words without a bit are put in, so that places count."""
    spark = keys.sparkSession
    level = Level(number, size, hashes, keys)
    places = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("place"))
    words = places.groupBy(F.expr("shiftright(place, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits"))
    every = words.unionByName(spark.range(size // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("bits"))).groupBy("w").agg(F.expr("bit_or(bits)").alias("bits"))
    inner = F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"])
    return Level(number, size, hashes, materialize(every.groupBy(F.expr(f"cast(w div {INNER} as int)").alias("c")).agg(inner.alias("longs"))))


def build_cascade(keys: DataFrame) -> Cascade | None:
    """The cascade of keys (key, listed; each key once, none null), or None if it would take more than MAX_BYTES.

    The first level has as many hash functions as leave about as many wrong keys as there are listed ones; each later one leaves about a sixteenth. Every level's work is on the keys that all levels so far hold.
    """
    live, levels, side, held = keys, [], True, 0
    while True:
        counts = {r["listed"]: r["n"] for r in live.groupBy("listed").agg(F.count("*").alias("n")).collect()}
        mine, other = counts.get(side, 0), counts.get(not side, 0)
        if not mine:
            return Cascade(tuple(levels))
        if len(levels) == MAX_LEVELS:
            raise RuntimeError(f"{mine} keys still collide after {MAX_LEVELS} levels")
        hashes = HASHES if levels else min(MOST_HASHES, max(LEAST_HASHES, math.ceil(math.log2(1 + other / mine))))
        size = _size(mine, hashes)
        held += size // 8
        if held > MAX_BYTES:
            return None
        level = _fill(len(levels), size, hashes, live.filter(F.col("listed") == side))
        levels.append(level)
        live, side = materialize(live.filter(level.holds(F.col("key")))), not side


def universe(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """key, listed: each key of the corpus once, with whether the list has it. One union is added up, without a join; listed keys that the corpus lacks are left out, null keys too."""
    both = keys.select("key", F.lit(True).alias("here"), F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(False).alias("here"), F.lit(True).alias("listed")))
    return both.filter("key is not null").groupBy("key").agg(F.bool_or("here").alias("here"), F.bool_or("listed").alias("listed")).filter("here").drop("here")


def with_membership(rows: DataFrame, key: str, listed: DataFrame, to: str = "listed") -> DataFrame:
    """rows with column `to`: whether listed (column key) has the row's key; false for null. By a cascade over all keys of rows; only where that would pass MAX_BYTES by a join with the list."""
    known = materialize(universe(rows.select(F.col(key).alias("key")), listed))
    cascade = build_cascade(known)
    if cascade is None:
        found = known.filter("listed").select(F.col("key").alias("_key"), F.lit(True).alias("_found"))
        return rows.join(found, F.col(key) == F.col("_key"), "left").withColumn(to, F.coalesce("_found", F.lit(False))).drop("_key", "_found")
    return rows.withColumn(to, F.coalesce(F.when(F.col(key).isNotNull(), cascade.listed(F.col(key))), F.lit(False)))


def junk_list(pages: DataFrame) -> DataFrame:
    """key: host and path of the pages on hosts whose labels have a junk word."""
    return pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).filter(F.col("host").rlike(_JUNK_HOST)).select(F.concat("host", "path").alias("key")).distinct()


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and listed for every row of pages (page_id, url).

    The longest fitting rule decides; without one a listed key (host and path) is blocked and any other allowed. A null url, or one without `://`, has an empty host and path and is judged like any other. Repeated rows are each judged; urls of any length are taken whole; further columns don't matter; an empty table gives no rows.
    """
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumn("key", F.concat("host", "path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    told = with_membership(parts, "key", listed)
    return told.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def _rule_sql() -> str:
    fits = lambda h, p: f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    case = lambda pick: "case " + " ".join(f"when {fits(h, p)} then '{pick(h, p, v)}'" for h, p, v in ordered) + " end"
    return f"{case(lambda h, p, v: h + p)} rule, {case(lambda h, p, v: v)} ruled"


#: The same in DuckDB SQL: exact membership is plain membership.
SQL = f"""
with u as (select page_id, case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from u),
l as (select distinct host || path k from p where regexp_matches(host, '{_JUNK_HOST}')),
j as (select *, host || path in (select k from l) listed, {_rule_sql()} from p)
select page_id, host, path, rule, coalesce(ruled, case when listed then 'block' else 'allow' end) verdict, listed from j
"""
