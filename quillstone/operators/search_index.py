"""The persisted search index. It grows by immutable segments of chunks and postings; what a later run replaces or drops is noted as deleted, and the statistics are sums over segments less what is deleted. Chunks and postings lie in partitions by department and sensitivity, so that a question opens no file it may not see."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillstone.functions import access, text as T
from quillstone.session import ship

#: Partition columns: the department whose members see a chunk (General: everyone), and the rank of its sensitivity.
LABELS = ["in_department", "at_level"]
#: Deleted chunks whose words a Python worker counts at once; chunks, and bytes of text, that it embeds or whose words it sorts at once; postings that it hands over at once.
CHUNKS_AT_ONCE = 256
RUN, RUN_BYTES, ROWS_AT_ONCE = 2_048, 1 << 24, 1 << 16
#: Chunks of a block, about; rows of a page of the postings' files, which are skipped by the blocks' numbers.
BLOCK, PAGE_ROWS = 64, 2_048
#: Deleted keys up to which they are broadcast.
BROADCAST_KEYS = 100_000
#: Columns that the index adds to a chunk: words, norm and values of its vector, and a hash of the columns given.
ADDED = ["dl", "norm", "vector", "print"]
_MANIFEST = "segments array<string>, runs array<string>, key array<string>, dim int, deleted long, schemas map<string,string>"


@dataclass(frozen=True)
class SearchIndex:
    """chunks (key, chunk columns, ADDED, labels, segment), postings (term, block, key, tf, dl, places, labels, segment), bounds (term, block, n, top_tf, least_dl, labels, segment), terms (term, df, labels) and sizes (n, dl, labels). `name` tells the version and what of it is seen."""

    chunks: DataFrame
    postings: DataFrame
    bounds: DataFrame
    terms: DataFrame
    sizes: DataFrame
    key: tuple[str, ...] = ("doc_id", "window_no")
    name: str = ""

    def where(self, condition: Column, name: str) -> SearchIndex:
        """The index of the chunks whose labels pass."""
        return SearchIndex(self.chunks.filter(condition), self.postings.filter(condition), self.bounds.filter(condition), self.terms.filter(condition), self.sizes.filter(condition), self.key, f"{self.name}|{name}")

    def visible(self, clearance: str | None, departments: list[str] | str | None = access.ALL) -> SearchIndex:
        """What the clearance and the departments may see, as filters on the partition columns."""
        seen = F.col("at_level") <= access.clearance_rank(clearance)
        if not (departments == access.ALL or departments and access.ALL in departments):
            mine = [departments] if isinstance(departments, str) else list(departments or [])
            seen &= F.col("in_department").isin(sorted({"General", *mine}))
        return self.where(seen, f"{access.clearance_rank(clearance)},{departments}")


_ddl = StructType.fromDDL
_WORD = re.compile(r"\w+")


def _print(columns: list[str]) -> Column:
    """What tells whether a chunk has changed."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def _found(pieces: list[str]) -> list[list[str]]:
    return [(x,) if x.isalnum() else _WORD.findall(x) for x in pieces]


def _pairs(texts: pa.Array, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Words by text; then of each pair of text and word, in order of group (of the texts, ascending), word and text: the text, the word's number and where the pair's places end (from 0) in the next array, all places; and the distinct words, in order. The words of all texts are counted by one sort of their numbers."""
    ends, number, found = T.pieces_of(texts, _found)
    words = pa.array(found, pa.string()).dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    dl, n, t = np.diff(ends), max(1, len(order)), max(1, len(texts))
    text = np.repeat(np.arange(len(texts)), dl)
    of = (group[text] * n + rank[words.indices.to_numpy()[number]]) * t + text
    at, most = np.arange(len(of)) - np.repeat(ends[:-1], dl), int(dl.max(initial=1))
    if (int(group.max(initial=0)) + 1) * n * t * most < 1 << 63:  # pair and place in one number
        of, at = np.divmod(np.sort(of * most + at), most)
    else:
        sort = np.argsort(of, kind="stable")
        of, at = of[sort], at[sort]
    edges = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
    pairs = of[edges[:-1]]
    return dl, pairs % t, pairs // t % n, edges, at, words.dictionary.take(order)


def _counted(texts: list[str | None]) -> list[pa.Array]:
    """By text: words, terms, how often and at which words each occurs."""
    dl, text, word, edges, at, distinct = _pairs(pa.array(texts, pa.string()), np.arange(len(texts)))
    ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
    lists = [distinct.take(pa.array(word)), pa.array(np.diff(edges), pa.int32()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(at, pa.int32()))]
    return [pa.array(dl, pa.int32()), *(pa.ListArray.from_arrays(ends, x) for x in lists)]


def _measured(rows: DataFrame) -> DataFrame:
    """rows (chunk columns and labels) with ADDED."""
    ship(rows.sparkSession)
    columns = [c for c in rows.columns if c not in LABELS]
    told = rows.withColumn("print", _print(columns)).withColumn("_low", F.lower("content"))
    schema = StructType([*(f for f in told.schema if f.name != "_low"), *_ddl("dl int, norm double, vector array<double>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _runs(batches):
            vectors = T.vectors_of(b.column("content"))
            values, edges = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            norms = [T.norm(values[i:j].tolist()) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            dl = np.diff(T.pieces_of(b.column("_low"), _found)[0])
            made = [pa.array(dl, pa.int32()), pa.array(norms, pa.float64()), vectors]
            yield pa.RecordBatch.from_arrays([*b.drop_columns("_low").columns, *made], names=[f.name for f in schema])

    return told.mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about RUN rows and RUN_BYTES of `_low`; none ends inside a block, if rows come by blocks."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        while held is not None:
            size = np.cumsum(pc.fill_null(pc.binary_length(held.column("_low")), 0).to_numpy(zero_copy_only=False))
            ends = np.flatnonzero(np.diff(held.column("block").to_numpy())) + 1 if "block" in held.schema.names else np.arange(1, held.num_rows)
            ends = ends[ends >= min(RUN, np.searchsorted(size, RUN_BYTES) + 1)]
            if not len(ends):
                break
            yield held.slice(0, ends[0])
            held = held.slice(ends[0])
    if held is not None and held.num_rows:
        yield held


def _in_order(b: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows in order of labels and block, and the number of each one's pair of labels."""
    b = b.take(pc.sort_indices(b, sort_keys=[(c, "ascending") for c in (*LABELS, "block")]))
    changes = np.zeros(max(0, b.num_rows - 1), bool)
    for c in LABELS:
        changes |= np.diff(b.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()) != 0
    return b, np.concatenate([[0], np.cumsum(changes)]) if b.num_rows else np.zeros(0, np.int64)


def _handed(columns: list[pa.Array], schema: StructType) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
    for i in range(0, whole.num_rows, ROWS_AT_ONCE):
        yield whole.slice(i, ROWS_AT_ONCE)


def _postings(texts: DataFrame, key: list[str]) -> DataFrame:
    """A row for each chunk and word of texts (key, labels, block, dl, _low). Each run comes in order of labels, words and blocks, so that sorting a task's rows only merges its runs."""
    ship(texts.sparkSession)
    same = ["block", *key, "dl", *LABELS]
    schema = StructType([*_ddl("term string, tf int, places array<int>"), *(texts.schema[c] for c in same)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in map(_in_order, _runs(batches)):
            _, text, word, edges, at, distinct = _pairs(b.column("_low"), group)
            places = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(at, pa.int32()))
            own = b.select(same).take(pa.array(text)).columns
            yield from _handed([distinct.take(pa.array(word)), pa.array(np.diff(edges), pa.int32()), places, *own], schema)

    return texts.mapInArrow(run, schema)


def _bounds(texts: DataFrame) -> DataFrame:
    """A row for each block and word of texts (labels, block, dl, _low), whose rows come by blocks: chunks that hold the word, its greatest tf and their least dl."""
    ship(texts.sparkSession)
    same = ["block", *LABELS]
    schema = StructType([*_ddl("term string, n long, top_tf int, least_dl int"), *(texts.schema[c] for c in same)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in map(_in_order, _runs(batches)):
            _, text, word, edges, _, distinct = _pairs(b.column("_low"), group)
            if not len(text):
                continue
            block, dl = b.column("block").to_numpy()[text], b.column("dl").to_numpy()[text]
            first = np.flatnonzero((np.diff(block, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0))
            made = [np.diff(np.append(first, len(text))), np.maximum.reduceat(np.diff(edges), first), np.minimum.reduceat(dl, first)]
            own = b.select(same).take(pa.array(text[first])).columns
            yield from _handed([distinct.take(pa.array(word[first])), pa.array(made[0], pa.int64()), pa.array(made[1], pa.int32()), pa.array(made[2], pa.int32()), *own], schema)

    return texts.mapInArrow(run, schema)


def _lower(chunks: DataFrame, *columns: str) -> DataFrame:
    return chunks.select(*columns, *LABELS, F.lower("content").alias("_low"))


def _shards(spark: SparkSession) -> int:
    """Parts into which the rows of one pair of labels are dealt, so that a large one is no hot task and a small one has few files: a quarter of the tasks."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def _labelled(chunks: DataFrame, key: list[str]) -> DataFrame:
    """chunks with their labels, dealt by these and shards; Spark joins small parts."""
    department = F.coalesce(F.nullif(F.col("department"), F.lit("")), F.lit("General"))
    rows = chunks.withColumn("in_department", department).withColumn("at_level", access.rank(F.col("sensitivity")))
    return rows.repartition(*LABELS, F.pmod(F.xxhash64(*key), F.lit(_shards(chunks.sparkSession))))


def _append(df: DataFrame, path: str, name: str, *by: str) -> None:
    writer = df.write.mode("append").option("parquet.page.row.count.limit", PAGE_ROWS).option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{name}")


def _append_sorted(df: DataFrame, path: str, name: str, *order: str) -> None:
    """Files by labels, each in order. Labels that can be null would be sorted again by the writer."""
    rows = df.withColumn("in_department", F.coalesce("in_department", F.lit("General"))).withColumn("at_level", F.coalesce("at_level", F.lit(3)))
    _append(rows.sortWithinPartitions(*LABELS, *order), path, name, *LABELS)


def _read(spark: SparkSession, path: str, name: str, schemas: dict[str, str], live: Column) -> DataFrame:
    """Table `name` with its schema; empty if it has no files yet."""
    schema = StructType.fromJson(json.loads(schemas[name]))
    try:
        return spark.read.schema(schema).parquet(f"{path}/{name}").filter(live)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _schemas(chunks: DataFrame, key: list[str]) -> dict[str, str]:
    """Of every table, from the chunks that are written."""
    keys, labels, run, runs = [chunks.schema[k] for k in key], _ddl("in_department string, at_level int"), _ddl("segment string"), _ddl("segment string, run string")
    plain = [f for f in chunks.schema if f.name not in {*LABELS, "segment"}]
    tables = {
        "chunks": StructType([*plain, *run, *labels]),
        "postings": StructType([*_ddl("term string, block int"), *keys, *_ddl("tf int, dl int, places array<int>"), *run, *labels]),
        "bounds": StructType([*_ddl("term string, block int, n long, top_tf int, least_dl int"), *run, *labels]),
        "terms": StructType([*_ddl("term string, df long"), *runs, *labels]),
        "sizes": StructType([*_ddl("n long, dl long"), *labels, *runs]),
        "deleted": StructType([*keys, *runs]),
    }
    return {n: s.json() for n, s in tables.items()}


def _blocks(held: DataFrame, sizes: list[Row], key: list[str]) -> DataFrame:
    """held with `block`, a number that only chunks of one segment and pair of labels share, about BLOCK of them and whole documents."""
    first, block = 0, F.lit(None)
    for r in sizes:
        many = -(-r["n"] // BLOCK)
        of = F.lit(True)
        for c in LABELS:
            of &= F.col(c).eqNullSafe(F.lit(r[c]))
        block = F.when(of, F.pmod(F.xxhash64(key[0]), F.lit(many)) + first).otherwise(block)
        first += many
    return held.withColumn("block", block.cast("int"))


def _write_segment(rows: DataFrame, path: str, key: list[str], segment: str) -> dict[str, str] | None:
    """Write measured rows as a segment of its own; the schemas, or None if there are no rows.

    The postings of the chunks that a task reads are sorted in this task by labels, terms and blocks and written by it, so they are never shuffled, no term is a hot task, and a question's terms are found by the files' and
    pages' bounds. A block holds whole documents of one pair of labels, whose chunks share words; what it can score at most for a term follows from the greatest tf and the least length in `bounds`, which are taken where
    whole chunks have been dealt by labels and blocks. Deletions leave bounds as they are: what is left scores no more. Frequencies are sums over the bounds.
    """
    spark = rows.sparkSession
    _append(rows, path, f"chunks/segment={segment}", *LABELS)
    schemas = _schemas(rows, key)
    held = _read(spark, path, "chunks", schemas, F.col("segment") == segment)
    counts = held.groupBy(*LABELS).agg(F.count("*").alias("n"), F.sum("dl").alias("dl"))
    sizes = counts.orderBy(*LABELS).collect()  # a row for each pair of labels
    if not sizes:
        return None
    texts, part = _lower(_blocks(held, sizes, key), *key, "block", "dl"), F.pmod("block", F.lit(_shards(spark)))
    _append_sorted(_postings(texts, key), path, f"postings/segment={segment}", "term", "block")
    whole = texts.drop(*key).repartition(*LABELS, part).sortWithinPartitions("block")
    _append_sorted(_bounds(whole), path, f"bounds/segment={segment}", "term", "block")
    known = _read(spark, path, "bounds", schemas, F.col("segment") == segment)
    _append_sorted(known.groupBy(*LABELS, "term").agg(F.sum("n").alias("df")), path, f"terms/segment={segment}/run={segment}", "term")
    _append(counts.coalesce(1), path, f"sizes/segment={segment}/run={segment}")
    return schemas


def _count_lost(chunks: DataFrame, path: str, run: str) -> None:
    """Take away what the chunks count for in the statistics of their segments. Their words are found anew and counted batch by batch."""
    ship(chunks.sparkSession)
    rows = chunks.withColumn("run", F.lit(run))
    texts = _lower(rows, "segment", "run")
    schema = StructType([*(f for f in texts.schema if f.name != "_low"), *_ddl("term array<string>")])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in (batch.slice(i, CHUNKS_AT_ONCE) for i in range(0, batch.num_rows, CHUNKS_AT_ONCE)):
                yield pa.RecordBatch.from_arrays([*b.drop_columns("_low").columns, _counted(b.column("_low").to_pylist())[1]], names=[f.name for f in schema])

    words = texts.mapInArrow(terms, schema).withColumn("term", F.explode("term")).groupBy("segment", "run", *LABELS, "term").agg((-F.count("*")).alias("df"))
    _append(words.sortWithinPartitions("segment", "run", *LABELS, "term"), path, "terms", "segment", "run", *LABELS)
    _append(rows.groupBy("segment", "run", *LABELS).agg((-F.count("*")).alias("n"), (-F.sum("dl")).alias("dl")), path, "sizes", "segment", "run")


def _manifest(spark: SparkSession, path: str):
    """The last version's row, or None."""
    try:
        return spark.read.parquet(f"{path}/manifest").orderBy(F.desc("version")).first()
    except AnalysisException:
        return None


def _commit(spark: SparkSession, path: str, version: int, **values) -> None:
    """A version counts once its file is there; two writers of one version collide, and the second fails."""
    row = tuple(values[x.split()[0]] for x in _MANIFEST.split(", "))
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={version}")


def _fresh_name() -> str:
    return f"s{uuid.uuid4().hex}"


def build(chunks: DataFrame, path: str, key: tuple[str, ...] = ("doc_id", "window_no")) -> None:
    """Write the index of chunks (key, content, department, sensitivity and any further columns) below path as one segment; keys are unique. The manifest comes last, so an index that was broken off is none. If path holds an index, the new one takes its place."""
    spark, segment = chunks.sparkSession, _fresh_name()
    old = _manifest(spark, path)
    measured = _measured(_labelled(chunks, list(key)))
    schemas = _write_segment(measured, path, list(key), segment)
    _commit(spark, path, old["version"] + 1 if old else 1, segments=[segment] if schemas else [], runs=[segment], key=list(key), dim=T.DIM, deleted=0, schemas=schemas or _schemas(measured, list(key)))


def _same(a: str, b: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def newest(rows: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Of rows with one key the last in order of `by`, ties by all columns. Nulls are a key like any other; partial maxima come before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    order = F.struct(*by, *[c for c in sorted(rest) if c not in by])
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*key, "_r.*").select(*rows.columns)


def update(chunks: DataFrame, path: str, document: str = "doc_id", gone: DataFrame | None = None, by: list[str] | None = None) -> dict[str, int]:
    """Bring the index up to date with a run: `chunks` are all chunks of the documents that the run saw, `gone` (column `document`) documents that no longer exist. Gives the numbers of chunks written, deleted and unchanged.

    A chunk takes the place of the one with its key; chunks of the run's documents that the run lacks are stale and go; other documents stay untouched, and chunks with equal columns too. Of incoming rows with one key the last by `by` counts. What is written is in proportion to the change.
    """
    spark = chunks.sparkSession
    m = _manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no index manifest at {path}")
    key, run = list(m["key"]), _fresh_name()
    rows = newest(chunks, key, by or [])
    told = rows.select(*dict.fromkeys([*key, document]), _print(rows.columns).alias("new"))
    held = load(spark, path).chunks
    seen = told.select(document).distinct() if gone is None else told.select(document).union(gone.select(document)).distinct()
    narrow = held.select(*dict.fromkeys([*key, document, "segment", "print"]))
    at = narrow.alias("h").join(seen.withColumn("_seen", F.lit(True)).alias("d"), _same("h", "d", [document]), "left").join(told.alias("n"), _same("h", "n", key), "left")
    states = at.select(*[F.col(f"h.{k}").alias(k) for k in key], "h.segment", F.when(F.col("n.new") == F.col("h.print"), "same").when(F.col("n.new").isNotNull() | F.col("_seen"), "dead").alias("state")).filter("state is not null")
    scratch = f"{path}/scratch/{run}"
    states.write.parquet(scratch)
    states = spark.read.parquet(scratch)
    same, dead = states.filter("state = 'same'"), states.filter("state = 'dead'").drop("state")
    n_same, n_dead = same.count(), dead.count()
    fresh = rows.alias("n").join(same.alias("s"), _same("n", "s", key), "left_anti").select("n.*")
    schemas = _write_segment(_measured(_labelled(fresh, key)), path, key, run)
    n_new = load_segment(spark, path, m["schemas"], run).count() if schemas else 0
    if n_dead:
        _append(dead.withColumn("run", F.lit(run)), path, "deleted", "segment", "run")
        lost = held.alias("c").join(F.broadcast(dead).alias("d") if n_dead <= BROADCAST_KEYS else dead.alias("d"), _same("c", "d", [*key, "segment"]), "left_semi")
        _count_lost(lost, path, run)
    if n_new or n_dead:
        _commit(spark, path, m["version"] + 1, segments=[*m["segments"], *([run] if n_new else [])], runs=[*m["runs"], run], key=key, dim=m["dim"], deleted=m["deleted"] + n_dead, schemas=m["schemas"])
    return {"written": n_new, "deleted": n_dead, "unchanged": n_same}


def load_segment(spark: SparkSession, path: str, schemas: dict[str, str], segment: str) -> DataFrame:
    return _read(spark, path, "chunks", schemas, F.col("segment") == segment)


def merge(spark: SparkSession, path: str, below: int) -> int:
    """Rewrite the segments that have fewer than `below` chunks left as one, without what is deleted in them; how many were merged. Vectors are taken over, words are counted anew for the postings. Larger segments stay as they are."""
    m = _manifest(spark, path)
    whole = _tables(spark, path, m)
    left = {r["segment"]: r["n"] for r in whole["sizes"].groupBy("segment").agg(F.sum("n").alias("n")).collect()}  # a number a segment
    few = [s for s in m["segments"] if left.get(s, 0) < below]
    if len(few) < 2:
        return 0
    run = _fresh_name()
    rows = whole["chunks"].filter(F.col("segment").isin(few)).drop("segment")
    made = _write_segment(rows, path, list(m["key"]), run)
    segments = [*(s for s in m["segments"] if s not in few), *([run] if made else [])]
    still = _read(spark, path, "deleted", m["schemas"], F.col("segment").isin(segments) & F.col("run").isin(list(m["runs"]))).count()
    _commit(spark, path, m["version"] + 1, segments=segments, runs=[*m["runs"], run], key=m["key"], dim=m["dim"], deleted=still, schemas=m["schemas"])
    return len(few)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether path holds a whole index."""
    return _manifest(spark, path) is not None


def _tables(spark: SparkSession, path: str, m) -> dict[str, DataFrame]:
    live, runs = F.col("segment").isin(list(m["segments"])), F.col("run").isin(list(m["runs"]))
    of = {n: live & runs if n in ("terms", "sizes", "deleted") else live for n in m["schemas"]}
    out = {n: _read(spark, path, n, m["schemas"], c) for n, c in of.items()}
    if m["deleted"]:
        # a key is deleted in the segment that had it; a later one may hold it again
        dead = out["deleted"].drop("run")
        dead = F.broadcast(dead) if m["deleted"] <= BROADCAST_KEYS else dead
        for n in ("chunks", "postings"):
            out[n] = out[n].alias("a").join(dead.alias("d"), _same("a", "d", [*m["key"], "segment"]), "left_anti")
    return out


def load(spark: SparkSession, path: str) -> SearchIndex:
    """The index below path as its last version has it; FileNotFoundError without a manifest."""
    m = _manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no index manifest at {path}")
    t = _tables(spark, path, m)
    return SearchIndex(t["chunks"], t["postings"], t["bounds"], t["terms"], t["sizes"], tuple(m["key"]), f"{path}@{m['version']}")


def found_score(spark: SparkSession, path: str) -> float | None:
    """The quality metric index_found: 0 without an index; with one it doesn't count."""
    return None if exists(spark, path) else 0.0
