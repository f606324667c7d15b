"""Approximate nearest neighbours by cosine from a persisted index: inverted lists around k-means centroids, each list a partition of its own, of which a query reads those whose centroids are nearest."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.session import ship

#: Rows that k-means is fitted on, and queries that the number of probes is measured on, about.
SAMPLE, TRIALS = 200_000, 200
MOST_LISTS = 4_096
#: Rows and queries that a task compares at once.
PART_ROWS, PART_QUERIES = 20_000, 2_000
RECALL = 0.95


@dataclass(frozen=True)
class AnnIndex:
    """lists (list, key, vector, norm), the centroids, and the number of lists that a query needs for the recall asked when it was built, at the given k."""

    lists: DataFrame
    centroids: np.ndarray
    probes: int
    key: str


def _usable(rows: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """key, vector and norm of the rows that have a direction: null, zero and otherwise long vectors, and those with null or non-finite values, take no part."""
    fine = F.expr(f"size(vector) = {dim} and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    held = rows.select(F.col(key), F.col(vector).cast("array<double>").alias("vector")).filter(fine)
    return held.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).filter("norm > 0")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, dim)


def _order(units: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """The nearest centroids of each row, nearest first."""
    far = (centroids**2).sum(1)[None, :] - 2 * units @ centroids.T
    return np.argsort(far, axis=1, kind="stable")[:, :probes]


def _assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, list int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                units = _matrix(b.column("vector"), centroids.shape[1]) / np.asarray(b.column("norm"))[:, None]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_order(units, centroids, 1)[:, 0].astype(np.int32))], names=[*b.schema.names, "list"])

    return rows.mapInArrow(run, schema)


def _best(ids: list, queries: np.ndarray, norms: np.ndarray, rows: pa.Table, key: str, k: int) -> list[tuple]:
    """(query_id, key, list, score) of the k nearest of each query among rows, ties to the smaller key; a row is no neighbour of itself."""
    vectors, sizes = _matrix(rows.column("vector").combine_chunks(), queries.shape[1]), np.asarray(rows.column("norm"))
    keys, lists = np.asarray(rows.column(key)), np.asarray(rows.column("list"))
    scores = queries @ vectors.T / norms[:, None] / sizes[None, :]
    out = []
    for q, line in zip(ids, scores):
        line = np.where(keys == q, -np.inf, line)
        near = np.nonzero(line >= np.partition(line, len(line) - k)[len(line) - k] - 1e-12)[0] if len(line) > k else np.arange(len(line))
        near = near[np.lexsort((keys[near], -np.round(line[near], 12)))][:k]
        out += [(q, keys[i], lists[i], line[i]) for i in near if np.isfinite(line[i])]
    return out


_FOUND = "query_id {0}, `{1}` {0}, list int, score double"


def _table(found: list[tuple], key: str, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), (), (), ()]
    kinds = [kind, kind, pa.int32(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["query_id", key, "list", "score"])


def _top(found: DataFrame, key: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), key))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def _against_all(rows: DataFrame, key: str, trials: list[tuple], k: int) -> DataFrame:
    """Exact neighbours of a few trial queries (id, vector, norm), with their lists."""
    ids, queries, norms = [t[0] for t in trials], np.array([t[1] for t in trials]), np.array([t[2] for t in trials])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _table(_best(ids, queries, norms, pa.Table.from_batches([b]), key, k), key, b.schema.field(key).type)

    kind = rows.schema[key].dataType.simpleString()
    return _top(rows.mapInArrow(run, _FOUND.format(kind, key)), key, k)


def build(vectors: DataFrame, path: str, key: str = "vec_id", vector: str = "embedding", k: int = 10, recall: float = RECALL, lists: int | None = None) -> None:
    """Write the index of vectors (an integer key, vector) below path; the manifest comes last. Every usable row is in a list.

    Centroids are fitted on about SAMPLE rows, and are about as many as the root of the rows, up to MOST_LISTS. How many lists must be read for the recall asked is measured: the exact k neighbours of about TRIALS rows among all rows, against the order of these rows' lists.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    ship(spark)
    first = vectors.select(F.max(F.size(F.col(vector)))).first()[0]
    dim = max(first or 1, 1)
    rows = _usable(vectors, key, vector, dim)
    n = rows.count()
    wanted = min(max(1, lists or round(math.sqrt(n))), MOST_LISTS)
    pick = lambda most, salt: F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30))
    centroids = np.zeros((1, dim))
    if n:
        unit = F.transform("vector", lambda x: x / F.col("norm"))
        sample = rows.filter(pick(SAMPLE, 1) | F.lit(n <= SAMPLE)).select(array_to_vector(unit).alias("features"))
        centroids = np.array(KMeans(k=wanted, seed=7, maxIter=10).fit(sample).clusterCenters()) if wanted > 1 else centroids
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_ROWS)) if n > PART_ROWS else 1
    store = f"{path}/{uuid.uuid4().hex}"
    _assigned(rows, centroids).repartitionByRange(parts, "list", key).write.partitionBy("list").parquet(store)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, vector array<double>, norm double, list int"
    probes = 1
    if n:
        held = spark.read.schema(schema).parquet(store)
        trials = [tuple(r) for r in held.filter(pick(TRIALS, 2) | F.lit(n <= TRIALS)).select(key, "vector", "norm").limit(2 * TRIALS).collect()]
        if trials:
            order = {t[0]: {c: i for i, c in enumerate(o)} for t, o in zip(trials, _order(np.array([t[1] for t in trials]) / np.array([t[2] for t in trials])[:, None], centroids, len(centroids)))}
            places = sorted(order[r["query_id"]][r["list"]] for r in _against_all(held, key, trials, k).select("query_id", "list").collect())
            probes = places[min(len(places) - 1, math.ceil(recall * len(places)) - 1)] + 1 if places else 1
    row = (uuid.uuid4().hex, store, schema, key, centroids.tolist(), probes)
    spark.createDataFrame([row], "id string, store string, schema string, key string, centroids array<array<double>>, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def load(spark: SparkSession, path: str) -> AnnIndex:
    """The index below path; FileNotFoundError without its manifest."""
    try:
        m = spark.read.parquet(f"{path}/manifest").first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no index manifest at {path}") from e
    try:
        lists = spark.read.schema(m["schema"]).parquet(m["store"])
    except AnalysisException:  # no usable row
        lists = spark.createDataFrame([], m["schema"])
    return AnnIndex(lists, np.array(m["centroids"]), m["probes"], m["key"])


def add(index: AnnIndex, vectors: DataFrame, path: str, vector: str = "embedding") -> None:
    """Append further vectors to the lists of their nearest centroids; what is written is their own rows. Keys must be new."""
    spark = vectors.sparkSession
    ship(spark)
    m = spark.read.parquet(f"{path}/manifest").first()
    _assigned(_usable(vectors, index.key, vector, index.centroids.shape[1]), index.centroids).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "list", index.key).write.mode("append").partitionBy("list").parquet(m["store"])


def search(index: AnnIndex, queries: DataFrame, k: int = 10, probes: int | None = None, vector: str = "embedding") -> DataFrame:
    """query_id, rank, key, score: the k nearest by cosine of each of queries (key, vector) among the rows of the `probes` lists nearest to it (as many as the index's recall needs, if None; with all lists the answer is exact), ties to the smaller key; a row is no neighbour of the query with its key.

    Only the files of probed lists are read. A list is cut into parts of about PART_ROWS rows and PART_QUERIES queries, so neither a large list nor a much-asked one is a hot task.
    """
    spark, key = queries.sparkSession, index.key
    ship(spark)
    centroids, wanted = index.centroids, min(probes or index.probes, len(index.centroids))
    asked = _usable(queries, key, vector, centroids.shape[1])
    kind = asked.schema[key].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                units = _matrix(b.column("vector"), centroids.shape[1]) / np.asarray(b.column("norm"))[:, None]
                lists = pa.array(_order(units, centroids, wanted).astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(key), b.column("vector"), b.column("norm"), lists], names=["query_id", "query", "size", "lists"])

    routed = asked.mapInArrow(route, f"query_id {kind}, query array<double>, size double, lists array<int>").select("query_id", "query", "size", F.explode("lists").alias("list"))
    counts = routed.groupBy("list").agg(F.count("*").alias("asked"))
    probed = [r["list"] for r in counts.select("list").collect()]  # at most MOST_LISTS numbers
    rows = index.lists.filter(F.col("list").isin(probed))
    parts = rows.groupBy("list").agg((F.floor(F.count("*") / PART_ROWS) + 1).cast("int").alias("parts")).join(counts.select("list", (F.floor(F.col("asked") / PART_QUERIES) + 1).cast("int").alias("blocks")), "list")
    parts = F.broadcast(parts)
    spread = lambda c, by: F.pmod(F.xxhash64(c), F.col(by)).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
    left = routed.join(parts, "list").withColumn("block", spread("query_id", "blocks")).withColumn("part", every("parts"))
    right = rows.join(parts, "list").withColumn("part", spread(key, "parts")).withColumn("block", every("blocks"))

    def compare(_, a: pa.Table, b: pa.Table) -> pa.Table:
        found = _best(a.column("query_id").to_pylist(), _matrix(a.column("query").combine_chunks(), centroids.shape[1]), np.asarray(a.column("size")), b, key, k) if a.num_rows and b.num_rows else []
        return pa.Table.from_batches([_table(found, key, b.schema.field(key).type)])

    at = ["list", "part", "block"]
    found = left.select(*at, "query_id", "query", "size").groupBy(*at).cogroup(right.select(*at, key, "vector", "norm").groupBy(*at)).applyInArrow(compare, _FOUND.format(kind, key))
    return _top(found, key, k).select("query_id", "rank", key, "score")


def kept(spark: SparkSession, path: str, vectors: Callable[[], DataFrame], **how) -> AnnIndex:
    """The index below path, built of vectors() if there is none."""
    try:
        return load(spark, path)
    except FileNotFoundError:
        build(vectors(), path, **how)
        return load(spark, path)
