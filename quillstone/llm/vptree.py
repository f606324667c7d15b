"""Operator 6: nearest neighbours by vantage-point trees, one a shard, with triangle-inequality pruning relaxed by a factor. Shards lie around pivots, so a query visits only those that can hold a better neighbour."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import materialize, ship

#: Bytes of a shard's vectors, vectors of a leaf, queries searched at once.
SHARD_BYTES, LEAF, QUERY_ROWS = 8 << 20, 256, 4096
#: Pivots, each the middle of a cell, come from a sample of so many rows and bytes at most; a cell of many rows is split around second pivots of its own.
PIVOTS, PIVOT_BYTES = 1024, 4 << 20
#: What names a shard: length of its vectors, first and second pivot, and part where both have too many rows.
SHARD = ["dim", "cell", "sub", "part"]
#: A subtree is passed over if its least possible distance exceeds FACTOR times the distance of the k-th neighbour so far. 1 restores exact search; smaller prunes more.
FACTOR = 1.0
#: Slack of bounds and of scores that are computed in blocks, in units of the vectors' lengths.
LOOSE, CLOSE = 1e-7, 1e-12


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of the rows, at any scale."""
    top = np.abs(x).max(1)
    return top * np.sqrt(((x / np.where(top > 0, top, 1.0)[:, None]) ** 2).sum(1))


def lift(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Unit points whose distance from (query, 0), for a unit query, falls as the inner product with the query grows: one more coordinate gives all vectors the length `norm`, which then is the unit."""
    x = vectors / norm
    return np.column_stack([x, np.sqrt(np.maximum(1.0 - (x * x).sum(1), 0.0))])


def build(points: np.ndarray, leaf: int = LEAF) -> dict:
    """A tree over the points' places. Each node splits its points by distance from a vantage point at the median; bounds of both halves' distances are kept."""

    def node(places: np.ndarray) -> dict:
        if len(places) <= leaf:
            return {"places": places}
        mean = points[places].mean(0)
        vantage = points[places[np.argmax(((points[places] - mean) ** 2).sum(1))]]
        distance = np.sqrt(((points[places] - vantage) ** 2).sum(1))
        order = np.argsort(distance, kind="stable")
        half = len(order) // 2
        near, far = order[:half], order[half:]
        return {"vantage": vantage, "near_max": float(distance[near].max()), "far_min": float(distance[far].min()), "far_max": float(distance[far].max()), "near": node(places[near]), "far": node(places[far])}

    return node(np.arange(len(points)))


class Best:
    """The k best candidates of each query so far, by exact inner product (products summed in order), then least id. Rows of one id are candidates of their own. `floor`: scores below it are of no use."""

    def __init__(self, queries: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.queries, self.k = queries, k
        self.score = np.full((len(queries), k), -np.inf)
        self.id = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.own = np.zeros((len(queries), k), bool)
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def add(self, rows: np.ndarray, rough: np.ndarray, slack: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query_ids: np.ndarray) -> None:
        """Merge vectors with ids, whose scores (rows by vectors) are known up to slack. Whatever may be among the k best is measured exactly before the cut."""
        limit = self.worst(rows)
        if rough.shape[1] > self.k:
            limit = np.maximum(limit, np.partition(rough, -self.k, axis=1)[:, -self.k] - slack)
        row, col = np.nonzero(rough >= (limit - slack)[:, None])
        if not len(row):
            return
        at = rows[row]
        exact = np.concatenate([np.cumsum(self.queries[at[i : i + 65536]] * vectors[col[i : i + 65536]], axis=1)[:, -1] for i in range(0, len(at), 65536)])
        same = ids[col] == query_ids[at]
        own = same.copy()
        own[same] = (self.queries[at[same]] == vectors[col[same]]).all(1)
        some = np.unique(at)
        kept = np.isfinite(self.score[some])
        r = np.concatenate([np.repeat(some, kept.sum(1)), at])
        s, i, o = np.concatenate([self.score[some][kept], exact]), np.concatenate([self.id[some][kept], ids[col]]), np.concatenate([self.own[some][kept], own])
        order = np.lexsort((i, -s, r))
        r = r[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1])
        place = np.arange(len(r)) - np.repeat(first, np.diff([*first, len(r)]))
        top = place < self.k
        r, place, order = r[top], place[top], order[top]
        self.score[r, place], self.id[r, place], self.own[r, place] = s[order], i[order], o[order]


def search(tree: dict, vectors: np.ndarray, ids: np.ndarray, norm: float, query_ids: np.ndarray, best: Best, factor: float = FACTOR) -> None:
    """Merge the tree's neighbours of all queries into best. Queries go down to their own leaf first, which bounds the rest; then all leaves that no bound excludes are scored."""
    queries = best.queries
    size = lengths(queries)
    padded = np.column_stack([queries / size[:, None], np.zeros(len(queries))])

    def bound(rows: np.ndarray) -> np.ndarray:
        """Distance of the k-th neighbour so far, from its inner product."""
        return factor * np.sqrt(np.maximum(2 - 2 * best.worst(rows) / size[rows] / norm, 0.0)) + LOOSE

    def score(node: dict, rows: np.ndarray) -> None:
        x = vectors[node["places"]]
        best.add(rows, queries[rows] @ x.T, CLOSE * size[rows] * norm, x, ids[node["places"]], query_ids)

    def distances(node: dict, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((padded[rows] - node["vantage"]) ** 2).sum(1))

    own = np.full(len(queries), -1)

    def descend(node: dict, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if "places" in node:
            own[rows] = id(node)
            score(node, rows)
            return
        near = distances(node, rows) < (node["near_max"] + node["far_min"]) / 2
        descend(node["near"], rows[near])
        descend(node["far"], rows[~near])

    def visit(node: dict, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if "places" in node:
            if len(rows := rows[own[rows] != id(node)]):
                score(node, rows)
            return
        d = distances(node, rows)
        visit(node["near"], rows[d - node["near_max"] <= bound(rows)])
        limit = bound(rows)
        visit(node["far"], rows[(node["far_min"] - d <= limit) & (d - node["far_max"] <= limit)])

    everyone = np.arange(len(queries))
    descend(tree, everyone)
    visit(tree, everyone)


def usable(df: DataFrame) -> DataFrame:
    """Rows whose vector has components, all of them finite, not all zero."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & fine & F.exists(e, lambda x: x != 0))


def sample_pivots(rows: DataFrame, shard_bytes: int) -> dict[int, np.ndarray]:
    """Pivots by vector length, from the rows whose hashes are smallest: one for each shard_bytes of vectors, but PIVOTS of them, of PIVOT_BYTES in all, at most."""
    size = rows.agg(F.sum(F.col("dim").cast("long") * 8)).first()[0] or 0
    held = rows.select("dim", "embedding").orderBy(F.xxhash64("embedding"), "dim").limit(min(PIVOTS, -(-size // shard_bytes))).collect()
    out: dict[int, list] = {}
    left = PIVOT_BYTES
    for r in held:
        left -= 8 * r["dim"]
        if left >= 0:
            out.setdefault(r["dim"], []).append(r["embedding"])
    return {d: np.unique(np.array(v, np.float64), axis=0) for d, v in out.items()}


def cell_of(x: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """The nearest pivot of each vector, by direction; one cell where a length has no pivot."""
    if pivots is None:
        return np.zeros(len(x), np.int32)
    unit = lambda v: v / lengths(v)[:, None]
    return np.argmax(unit(x) @ unit(pivots).T, axis=1).astype(np.int32)


def _by_dim(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """The batch's rows by length of their vectors, which stand in column `place`."""
    for batch in batches:
        dims = batch.column(place).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(dims).tolist():
            part = batch.take(pa.array(np.flatnonzero(dims == d)))
            yield part, d, part.column(place).flatten().to_numpy().reshape(-1, d).astype(np.float64)


def distant(x: np.ndarray, k: int) -> np.ndarray:
    """Places of k rows, or all, each the furthest from those before it; the first is the nearest to the mean."""
    gap = lambda i: ((x - x[i]) ** 2).sum(1)
    x = x / np.abs(x).max()
    out = [int(((x - x.mean(0)) ** 2).sum(1).argmin())]
    least = gap(out[0])
    while len(out) < min(k, len(x)):
        out.append(int(least.argmax()))
        least = np.minimum(least, gap(out[-1]))
    return np.array(out)


def _split_cells(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """placed with `sub`, the nearest second pivot of its cell (0 in cells of one shard).

    A cell's second pivots lie far from one another in a sample of about eight rows a shard; they are twice as many as its shards, but 2 * PIVOTS at most. A row is drawn by a hash of its place, so a vector with many copies fills its share of the sample
    and no more. A large cell is met in chunks, each with the cell's second pivots.
    """
    told = placed.join(sizes, ["dim", "cell"])
    if sizes.filter("shards > 1").isEmpty():
        return told.withColumn("sub", F.lit(0)).drop("rows", "shards")
    large = told.filter("shards > 1")
    drawn = large.filter(F.pmod(F.xxhash64("h"), F.col("rows")) < 8 * F.least("shards", F.lit(PIVOTS))).select("dim", "cell", "embedding", "shards")

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        shards = int(rows["shards"].iloc[0])
        x = np.unique(np.stack(rows["embedding"].to_numpy()).astype(np.float64), axis=0)
        far = distant(x, 2 * min(shards, PIVOTS))
        return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "cell": [rows["cell"].iloc[0]], "shards": [shards], "pivots": [list(x[far])]})

    second = materialize(drawn.groupBy("dim", "cell").applyInPandas(spread, "dim int, cell int, shards int, pivots array<array<double>>"))
    right = second.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("chunk"), "pivots")

    def assign(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = rows[["vec_id", "embedding", "dim", "cell", "h"]].assign(sub=np.int32(0))
        if len(held) and len(rows):
            centres = np.unique(np.stack([np.asarray(v, np.float64) for v in held["pivots"].iloc[0]]), axis=0)
            x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
            scale, middle = np.abs(centres).max(), centres.mean(0)
            x, centres = (x - middle) / scale, (centres - middle) / scale
            # by distance, as vectors of a cell differ little in direction
            out["sub"] = np.argmax(x @ centres.T - (centres * centres).sum(1) / 2, axis=1).astype(np.int32)
        return out

    keys = ["dim", "cell", "chunk"]
    chunks = large.withColumn("chunk", F.pmod("h", "shards").cast("int"))
    dealt = chunks.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(assign, "vec_id long, embedding array<double>, dim int, cell int, h long, sub int")
    columns = ["vec_id", "embedding", "dim", "cell", "h", "sub"]
    return told.filter("shards <= 1").withColumn("sub", F.lit(0)).select(*columns).unionByName(materialize(dealt).select(*columns))


def build_index(vectors: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(trees, pivots). trees has a row a shard: dim, cell, sub, part, norm, centre, radius and the tree, pickled with its vectors and ids.

    Every usable row is indexed, in the cell of its nearest pivot. A cell of over shard_bytes is split around second pivots of its own, so that its shards get balls of their own. What still is over shard_bytes
    (copies of one vector, say) is cut into parts by a hash of its rows, so no shard grows with a hot cell or id.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.size("embedding").alias("dim"))
    pivots = sample_pivots(rows, shard_bytes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d, x in _by_dim(batches, 1):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell_of(x, pivots.get(d)))], names=[*part.schema.names, "cell"])

    placed = materialize(rows.mapInArrow(assign, "vec_id long, embedding array<double>, dim int, cell int"))
    shards = lambda: F.ceil(F.count("*") * F.col("dim") * 8 / shard_bytes).cast("int")
    sizes = placed.groupBy("dim", "cell").agg(F.count("*").alias("rows"), shards().alias("shards"))
    # the row's place in its file spreads equal rows
    split = _split_cells(placed.withColumn("h", F.xxhash64("vec_id", F.monotonically_increasing_id())), sizes)
    parts = split.groupBy("dim", "cell", "sub").agg(shards().alias("parts"))
    dealt = split.join(parts, ["dim", "cell", "sub"]).withColumn("part", F.pmod("h", "parts").cast("int"))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        norm = float(lengths(x).max())
        centre = x.mean(0)
        blob = pickle.dumps((build(lift(x, norm)), x.astype(np.float32) if np.array_equal(x.astype(np.float32), x) else x, pdf["vec_id"].to_numpy()), protocol=5)
        place = {c: [int(pdf[c].iloc[0])] for c in ("dim", "cell", "sub", "part")}
        return pd.DataFrame({**place, "norm": [norm], "centre": [centre], "radius": [float(lengths(x - centre).max())], "tree": [blob]})

    made = dealt.select("vec_id", "embedding", *SHARD).groupBy(*SHARD).applyInPandas(tree, "dim int, cell int, sub int, part int, norm double, centre array<double>, radius double, tree binary")
    return materialize(made), pivots


def balls(trees: DataFrame, *by: str) -> DataFrame:
    """A ball for each group of shards: around the centre of its first one, wide enough for all of them. `parts` counts the shards."""
    first = trees.groupBy(*by).agg(F.min_by("centre", F.struct("sub", "part")).alias("c"))
    gap = F.sqrt(F.aggregate(F.zip_with("c", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    return trees.drop("tree").join(first, list(by)).groupBy(*by).agg(F.count("*").cast("int").alias("parts"), F.max(gap + F.col("radius")).alias("radius"), F.max("norm").alias("norm"), F.first("c").alias("centre"))


class Balls:
    """Rows of `balls` as arrays."""

    def __init__(self, rows: dict[str, list]):
        self.cell, self.sub, self.parts = (np.asarray(rows[c], np.int32) for c in ("cell", "sub", "parts"))
        self.centre, self.radius, self.norm = np.array(list(rows["centre"]), np.float64), np.asarray(rows["radius"], np.float64), np.asarray(rows["norm"], np.float64)

    def home(self, q: np.ndarray) -> np.ndarray:
        """The ball where each query begins: any would do, the one whose middle lies furthest in its direction is likely to hold near neighbours."""
        return np.argmax((q / lengths(q)[:, None]) @ self.centre.T, axis=1)

    def reached(self, q: np.ndarray, floor: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, ball) wherever the ball can hold a better neighbour than the floor: no inner product in it is greater; in the tree's distances the k-th neighbour's is the factor's."""
        size = lengths(q)
        scale = size[:, None] * self.norm
        most = np.minimum(q @ self.centre.T + size[:, None] * self.radius, scale)
        reach = factor * np.sqrt(np.maximum(2 - 2 * floor[:, None] / scale, 0.0)) + LOOSE
        return np.nonzero(np.sqrt(np.maximum(2 - 2 * most / scale, 0.0)) <= reach)

    def shards(self, n: np.ndarray, q: np.ndarray, floor: np.ndarray | None, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, ball, part): all shards that each query reaches; without floors the one where it begins."""
        if floor is None:
            own = self.home(q)
            return np.arange(len(q)), own, n % self.parts[own]
        row, at = self.reached(q, floor, factor)
        times = self.parts[at]
        row, at = np.repeat(row, times), np.repeat(at, times)
        return row, at, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)


_ROUTED = "n long, query_id long, q array<double>, floor double, dim int, cell int, sub int, part int"


def _route_flat(asked: DataFrame, held: dict[int, Balls], factor: float) -> DataFrame:
    """Queries (n, query_id, q, floor) with the shards they go to, from all balls at once. Without the column floor each goes to the one shard where it begins."""
    begin = "floor" not in asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d, q in _by_dim(batches, 2):
            if d not in held:
                continue
            b = held[d]
            floor = np.full(len(q), -np.inf) if begin else part.column(3).to_numpy(zero_copy_only=False)
            row, at, shard = b.shards(part.column(0).to_numpy(), q, None if begin else floor, factor)
            for i in range(0, len(row), 8192):
                r, a = row[i : i + 8192], at[i : i + 8192]
                places = [floor[r], np.full(len(r), d, np.int32), b.cell[a], b.sub[a], shard[i : i + 8192].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(r)).columns[:3], *map(pa.array, places)], names=["n", "query_id", "q", "floor", *SHARD])

    return asked.mapInArrow(run, _ROUTED)


def _route_deep(asked: DataFrame, cells: dict[int, Balls], pivots: dict[int, np.ndarray], inner: DataFrame, factor: float) -> DataFrame:
    """The same in two levels: queries go to cells, of which there are PIVOTS at most, and meet the balls in these there."""
    begin = "floor" not in asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d, q in _by_dim(batches, 2):
            if d not in cells:
                continue
            b = cells[d]
            floor = np.full(len(q), -np.inf) if begin else part.column(3).to_numpy(zero_copy_only=False)
            known = {c: i for i, c in enumerate(b.cell.tolist())}
            row, at = (np.arange(len(q)), np.array([known.get(c, 0) for c in cell_of(q, pivots.get(d)).tolist()])) if begin else b.reached(q, floor, factor)
            for i in range(0, len(row), 8192):
                r, a = row[i : i + 8192], at[i : i + 8192]
                places = [floor[r], np.full(len(r), d, np.int32), b.cell[a]]
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(r)).columns[:3], *map(pa.array, places)], names=["n", "query_id", "q", "floor", "dim", "cell"])

    pairs = materialize(asked.mapInArrow(run, "n long, query_id long, q array<double>, floor double, dim int, cell int"))
    blocks = pairs.groupBy("dim", "cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    left = pairs.join(blocks, ["dim", "cell"]).withColumn("b", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int")).drop("blocks")
    right = inner.join(blocks, ["dim", "cell"]).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def meet(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["n", "query_id", "q", "floor", "dim", "cell"]
        out = [rows.iloc[:0][columns].assign(sub=np.int32(0), part=np.int32(0))]
        if len(held):
            b = Balls(held.to_dict("list"))
            for i in range(0, len(rows), 256):
                some = rows.iloc[i : i + 256]
                row, at, part = b.shards(some["n"].to_numpy(), np.stack(some["q"].to_numpy()), None if begin else some["floor"].to_numpy(), factor)
                out.append(some.iloc[row][columns].assign(sub=b.sub[at], part=part.astype(np.int32)))
        return pd.concat(out)

    keys = ["dim", "cell", "b"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, _ROUTED)


def _search_shards(asked: DataFrame, trees: DataFrame, k: int, factor: float) -> DataFrame:
    """(n, query_id, vec_id, score, own): the k best of each shard for the queries (n, query_id, q, floor) sent to it. Queries of a shard are searched in blocks; its tree goes to each block."""
    blocks = asked.groupBy(*SHARD).agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    left = asked.join(blocks, SHARD).withColumn("b", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int")).drop("blocks")
    right = trees.join(blocks, SHARD).select(*SHARD, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "norm", "tree")

    def find(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"n": np.empty(0, np.int64), "query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0), "own": np.empty(0, bool)})
        tree, x, ids = pickle.loads(held["tree"].iloc[0])
        best = Best(np.stack(asked["q"].to_numpy()), k, asked["floor"].to_numpy())
        search(tree, x.astype(np.float64), ids, float(held["norm"].iloc[0]), asked["query_id"].to_numpy(), best, factor)
        row, col = np.nonzero(np.isfinite(best.score))
        return pd.DataFrame({"n": asked["n"].to_numpy()[row], "query_id": asked["query_id"].to_numpy()[row], "vec_id": best.id[row, col], "score": best.score[row, col], "own": best.own[row, col]})

    keys = [*SHARD, "b"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(find, "n long, query_id long, vec_id long, score double, own boolean")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of greatest inner product with each row of queries; ties go to the smaller vec_id. One row with the query's id and vector counts as the query's own and is left out.

    Vectors that are null, zero or hold null or non-finite components, and null ids, take no part; only vectors of the query's length are compared; all candidates, if fewer than k. Repeated
    rows are candidates of their own, so an id may come twice, and a repeated query has a list for each of its rows. An empty table on either side gives no rows. Further columns are not read.
    A query is first searched in one shard near it. Then it goes to all other shards whose ball can, by the factor, hold a better neighbour than its k-th there: each shard is searched once.
    """
    spark = vectors.sparkSession
    trees, pivots = build_index(vectors, shard_bytes)
    inner = materialize(balls(trees, "dim", "cell", "sub"))
    # the bounds of all shards go with the tasks while these have the size of the pivots; beyond, those of the cells do, and shards are found inside the cells
    flat = inner.agg(F.coalesce(F.sum(F.col("dim") * 8), F.lit(0))).first()[0] <= PIVOT_BYTES
    told: dict[int, dict[str, list]] = {}
    for r in (inner if flat else balls(trees, "dim", "cell").withColumn("sub", F.lit(0))).collect():
        of = told.setdefault(r["dim"], {c: [] for c in ("cell", "sub", "parts", "centre", "radius", "norm")})
        for c, held in of.items():
            held.append(r[c])
    held = {d: Balls(rows) for d, rows in told.items()}
    ship(spark)
    route = lambda rows: _route_flat(rows, held, factor) if flat else _route_deep(rows, held, pivots, inner, factor)
    asked = materialize(usable(queries).select(F.monotonically_increasing_id().alias("n"), F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("q")))
    begun = materialize(route(asked))
    # one more than k everywhere, as the query's own row may be among them
    first = materialize(_search_shards(begun, trees, k + 1, factor))
    floors = first.groupBy("n").agg(F.when(F.count("*") > k, F.min("score")).alias("floor"))
    rest = route(asked.join(floors, "n", "left").select("n", "query_id", "q", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))
    found = first.unionByName(_search_shards(rest.join(begun.select("n", *SHARD), ["n", *SHARD], "left_anti"), trees, k + 1, factor))
    place = Window.partitionBy("n").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    top = found.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
    passed = F.count_if("own").over(place.rowsBetween(Window.unboundedPreceding, 0))
    ranked = top.withColumn("passed", passed).filter(~(F.col("own") & (F.col("passed") == 1)))
    rank = (F.col("place") - F.when(F.col("passed") > 0, 1).otherwise(0)).cast("int")
    return ranked.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


#: The same in DuckDB SQL, at FACTOR 1, with every twentieth id as a query.
SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: x::double) e, row_number() over () n from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0)
select query_id, rank::int as rank, vec_id, score from (
  select q.vec_id query_id, v.vec_id, list_inner_product(q.e, v.e) score, row_number() over (partition by q.n order by list_inner_product(q.e, v.e) desc, v.vec_id) as rank
  from v q join v on q.n <> v.n and len(q.e) = len(v.e) where q.vec_id % 20 = 0)
where rank <= 20
"""
