"""Operator 13: which of five filters removes what, in every order, from a sparse document-term matrix: words are encoded through one global dictionary, rows are kept in CSR shards, and their sums and nonzero counts decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import materialize, ship, shuffle_partitions, small

#: Bytes of text that close a shard, so that its words and its matrix stay within some 80 MB of a worker. A document is never cut.
SHARD_BYTES = 8 << 20
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 2
FILTERS = "ABCDE"
#: Bits of a global word id beside its place in a shard.
_ID_BITS = 38
_CAPITALS, _SYMBOLS = bytes(range(65, 91)), b"#$%&*|"

#: A shard: for each row its id, part, text print, marks (4: C fails, 8: D fails); the CSR arrays, those of the cells packed; the words that `indices` number.
_LOCAL = "shard long, doc_id array<long>, part array<string>, print array<binary>, marks array<int>, indptr array<int>, indices binary, data binary, words array<string>"


def _pack(values: np.ndarray) -> bytes:
    """32-bit numbers as compressed steps from one to the next, all lowest bytes first. Words ascend in a row, so steps are small."""
    steps = np.diff(values.astype("<i4"), prepend=np.int32(0)).astype("<i4")
    return len(values).to_bytes(8, "little") + pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    steps = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n).T.copy().view("<i4").ravel()
    return np.cumsum(steps, dtype=np.int32)


def _shard(number: int, rows: pa.Table) -> pa.RecordBatch:
    """One shard of rows (doc_id, part, text), with words numbered inside the shard."""
    texts = rows.column("text").combine_chunks()
    # white space of ASCII is just x20 and x09 to x0D
    lists = pc.ascii_split_whitespace(texts)
    words = lists.values.dictionary_encode()
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    place, names = np.asarray(words.indices).astype(np.int64), words.dictionary
    told = np.asarray(pc.not_equal(names, ""))
    new = np.cumsum(told) - 1  # the empty word, which leading and trailing spaces leave, has no number
    some = told[place] if len(place) else np.zeros(0, bool)
    width = max(1, len(names))
    cell, count = np.unique(row[some] * width + new[place[some]], return_counts=True)
    starts = np.searchsorted(cell // width, np.arange(len(texts) + 1))
    prints, marks = [], []
    for raw, size in zip(texts.cast(pa.binary()), pc.utf8_length(texts).to_pylist()):
        text = raw.as_py()
        prints.append(hashlib.sha256(text).digest())
        marks.append(4 * (100 * (len(text) - len(text.translate(None, _CAPITALS))) > MAX_CAPITALS_PERCENT * size) + 8 * (len(text.translate(None, _SYMBOLS)) < len(text)))
    fields = [x.split() for x in _LOCAL.split(", ")]
    kinds = {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
    values = [rows.column("doc_id").to_pylist(), rows.column("part").to_pylist(), prints, marks, starts.astype(np.int32), _pack(cell % width), _pack(count), names.filter(pa.array(told))]
    return pa.RecordBatch.from_arrays([pa.array([number]), *[pa.array([v], kinds[t]) for v, (_, t) in zip(values, fields[1:])]], names=[n for n, _ in fields])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 30
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        begin = 0
        for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            size += n
            if size >= SHARD_BYTES:
                yield _shard(number, pa.Table.from_batches([*held, batch.slice(begin, i + 1 - begin)]))
                number, held, begin, size = number + 1, [], i + 1, 0
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield _shard(number, pa.Table.from_batches(held))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words numbered from 0 in the task, whose number is p; a word stands in its first row alone."""
    task, last, at = TaskContext.get().partitionId(), None, -1
    for b in batches:
        if not b.num_rows:
            continue
        words = b.column("word")
        new = np.asarray(pc.not_equal(words, pa.concat_arrays([pa.array([last], pa.string()), words.slice(0, len(words) - 1)])).fill_null(True), bool)
        number = at + np.cumsum(new)
        last, at = words[len(words) - 1].as_py(), int(number[-1])
        yield pa.RecordBatch.from_arrays([pc.if_else(pa.array(new), words, None), pa.array(np.full(len(words), task, np.int32)), pa.array(number), b.column("shard"), b.column("at")], names=["word", "p", "i", "shard", "at"])


def numbered_words(local: DataFrame) -> DataFrame:
    """word, id, shard, at: each word of each shard with its place there and its number in the global dictionary (from 0, without gaps). The word itself stands in one row for each id, so the rows that have one are the dictionary.

    One shuffle by word; a word that is everywhere has a row for each shard.
    """
    spark = local.sparkSession
    words = local.select("shard", F.posexplode("words").alias("at", "word")).repartition(shuffle_partitions(spark), "word").sortWithinPartitions("word")
    held = materialize(words.mapInArrow(_number, "word string, p int, i long, shard long, at int"))
    offset, at = [], 0
    for r in held.groupBy("p").agg(F.max("i").alias("i")).orderBy("p").collect():  # one number a partition
        offset.append((r["p"], at))
        at += r["i"] + 1
    offsets = small(spark.createDataFrame(offset, "p int, first long"))
    return held.join(offsets, "p").select("word", (F.col("i") + F.col("first")).alias("id"), "shard", "at")


def _parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shards of docs (doc_id, part, text) beside the global ids of their words, and numbered_words().

    Only each shard's distinct words travel to the dictionary; occurrences never move.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    local = materialize(docs.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), text.alias("text")).mapInArrow(_shards, _LOCAL))
    words = numbered_words(local)
    # a shard's words are bounded; place and id travel as one number
    ids = words.groupBy("shard").agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), _ID_BITS).bitwiseOR(F.col("id"))).alias("ids"))
    return local.drop("words").join(ids, "shard", "left"), words


def _global(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """The cells' global word ids of the k-th shard of batch."""
    ids = batch.column("ids")[k]
    table = np.sort(np.asarray(ids.values)) & ((1 << _ID_BITS) - 1) if ids.is_valid else np.zeros(0, np.int64)
    return table[_unpack(batch.column("indices")[k].as_py())]


def document_term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """CSR shards of docs (doc_id, part, text), and the dictionary (word, id). A shard has doc_id, part, print and marks by row, indptr, and indices (global word ids) and data (counts) by cell. Words are maximal runs of anything but x20 and x09 to x0D."""
    parts, words = _parts(docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = b.drop_columns(["ids", "indices", "data"])
            cells = [pa.array([_global(b, k) for k in range(b.num_rows)], pa.list_(pa.int64())), pa.array([_unpack(x.as_py()) for x in b.column("data")], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *cells], names=[*kept.schema.names, "indices", "data"])

    schema = _LOCAL.split(", indices")[0] + ", indices array<long>, data array<int>"
    return parts.mapInArrow(encode, schema), words.filter("word is not null").select("word", "id")


def row_counts(docs: DataFrame) -> DataFrame:
    """doc_id, part, print, marks, n_words (row sums) and n_distinct (nonzero cells) of the matrix's rows. The cells stay in the worker that encodes them."""
    schema = "doc_id long, part string, print binary, marks int, n_words long, n_distinct long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ends, data, cells = np.asarray(b.column("indptr")[k].values), _unpack(b.column("data")[k].as_py()), _global(b, k)
                upto = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
                filled = np.concatenate([[0], np.cumsum((data != 0) & (cells >= 0), dtype=np.int64)])
                rows = [b.column(c)[k].values for c in ("doc_id", "part", "print", "marks")]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(np.diff(upto[ends])), pa.array(np.diff(filled[ends]))], names=[x.split()[0] for x in schema.split(", ")])

    return _parts(docs)[0].mapInArrow(sums, schema)


def failures(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by the set of filters that they fail (bit k: the k-th of ABCDE).

    E looks at prints alone: equal texts are first added up by part and id, so a text with any number of copies is a row for each part when its smallest id is sought.
    """
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    mask = F.col("marks") + F.when(F.col("n_words") < MIN_WORDS, 1).otherwise(0) + F.when(100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"), 2).otherwise(0)
    each = rows.groupBy("print", "part", mask.alias("mask"), "doc_id").agg(F.count("*").alias("n"))
    told = each.join(known, "doc_id", "left")
    good, toxic = (F.when(F.col(c), F.col("n")).otherwise(0) for c in ("good", "toxic"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", good.alias("good"), toxic.alias("toxic"))))
    texts = told.groupBy("print", "part", "mask").agg(F.sum("n").alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"), least.alias("least"))
    # the first of a text, and rows without id, pass E
    first = F.col("least.doc_id") == F.min("least.doc_id").over(Window.partitionBy("print"))
    at = lambda c: F.when(first, F.col(f"least.{c}")).otherwise(0)
    parted = texts.select("part", "mask", "n", "good", "toxic", (at("n") + F.col("no_id")).alias("n0"), at("good").alias("good0"), at("toxic").alias("toxic0"))
    passed = F.struct("mask", F.col("n0").alias("n"), F.col("good0").alias("good"), F.col("toxic0").alias("toxic"))
    failed = F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("n0")).alias("n"), (F.col("good") - F.col("good0")).alias("good"), (F.col("toxic") - F.col("toxic0")).alias("toxic"))
    both = parted.select("part", F.inline(F.array(passed, failed))).filter("n > 0")
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def interactions(failed: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts, from failures(): a row for each part, order of the five filters, and step. The table of orders, steps and masks has 19,200 rows, whatever the input."""
    steps = [("".join(p), k + 1, sum(1 << FILTERS.index(x) for x in p[:k]), 1 << FILTERS.index(p[k])) for p in permutations(FILTERS) for k in range(5)]
    table = failed.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, own int").withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(31))))
    fails, before = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    # a document that fails m filters is removed by each of them in 120 / m orders
    share = F.when(fails, F.col("n") * F.expr("120 div bit_count(mask)")).otherwise(0)
    return (
        failed.join(F.broadcast(table), "mask")
        .groupBy("part", "filter_order", "step")
        .agg(
            total("n", ~fails & ~before).alias("kept"), total("n", fails & ~before).alias("removed"), total("n", fails & before).alias("redundant"), total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
            total("good", fails & ~before).alias("good_lost"), total("toxic", fails & ~before).alias("toxic_lost"), F.sum(share).cast("long").alias("shapley"),
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row for each value of docs' column `part` (null and empty are one), each of the 120 orders of the filters and each step.

    Filters: A fewer than 200 words; B fewer than half of the words distinct; C over 2 % capitals A to Z; D any of #$%&*|; E text of a smaller doc_id. A null text is empty: it fails A, and E if a smaller id has an empty text too. Rows without doc_id, and repeated rows of the smallest one, pass E. A document is good or toxic if any of its label rows says so; null labels say nothing. Texts of any length are read whole; further columns don't matter; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col(part).alias("part"), "text")
    return interactions(failures(row_counts(rows), labels.select("doc_id", "quality", "toxic")))


#: The same in DuckDB SQL, without a matrix.
SQL = """
with d as (select doc_id, coalesce(source, '') part, coalesce(text, '') x from documents),
w as (select doc_id, part, x, list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda e: e <> '') ws from d),
l as (select doc_id, max(quality) quality, max(toxic) toxic from labels group by doc_id),
f as (
  select part, cast(len(ws) < 200 as int) + 2 * cast(100 * len(list_distinct(ws)) < 50 * len(ws) as int) + 4 * cast(100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 2 * length(x) as int)
    + 8 * cast(regexp_matches(x, '[#$%&*|]') as int) + 16 * cast(coalesce(doc_id > min(doc_id) over (partition by x), false) as int) mask, coalesce(quality = 1, false) good, coalesce(toxic = 1, false) toxic
  from w left join l using (doc_id)),
m as (select part, mask, count(*) n, count(*) filter (good) good, count(*) filter (toxic) toxic from f group by all),
b as (select unnest(['A', 'B', 'C', 'D', 'E']) c, unnest([1, 2, 4, 8, 16]) own),
o as (
  select b1.c || b2.c || b3.c || b4.c || b5.c filter_order, unnest([1, 2, 3, 4, 5]) step, unnest([0, b1.own, b1.own + b2.own, b1.own + b2.own + b3.own, b1.own + b2.own + b3.own + b4.own]) earlier, unnest([b1.own, b2.own, b3.own, b4.own, b5.own]) own
  from b b1, b b2, b b3, b b4, b b5 where b1.own | b2.own | b3.own | b4.own | b5.own = 31),
s as (
  select part, filter_order, step, own, sum(n) filter (mask & (earlier | own) = 0) kept, sum(n) filter (mask & own > 0 and mask & earlier = 0) removed, sum(n) filter (mask & own > 0 and mask & earlier > 0) redundant,
    sum(n) filter (mask = own) unique_fails, sum(good) filter (mask & own > 0 and mask & earlier = 0) good_lost, sum(toxic) filter (mask & own > 0 and mask & earlier = 0) toxic_lost
  from m, o group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint kept, coalesce(removed, 0)::bigint removed, coalesce(redundant, 0)::bigint redundant, coalesce(unique_fails, 0)::bigint unique_fails,
  coalesce(good_lost, 0)::bigint good_lost, coalesce(toxic_lost, 0)::bigint toxic_lost, coalesce(sum(removed) over (partition by part, own), 0)::bigint shapley
from s
"""
