"""Ranking: cosine, BM25, reciprocal-rank fusion, and hybrid search under access control applied before any ranking."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quillstone.functions import access, text as T
from quillstone.operators.search_index import ADDED, LABELS, SearchIndex
from quillstone.session import ship

K1, B, NEGATIVE_IDF = 1.5, 0.75, 0.25
RRF_K, CANDIDATES, TOP = 60, 30, 5


def visible(chunks: DataFrame, clearance: str, departments: list[str] | str = access.ALL) -> DataFrame:
    """Rows that the clearance and the departments may see."""
    return chunks.filter(access.is_allowed(F.col("sensitivity"), clearance) & access.department_visible(F.col("department"), departments))


def embed_query(spark: SparkSession, question: str, dim: int = T.DIM) -> list[float]:
    """The question's hash embedding, as values for a literal."""
    return spark.range(1).select(T.hash_embedding(F.lit(question), dim)).first()[0]


def vector_literal(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]) if values else F.array().cast("array<double>")


def cosine_topk(rows: DataFrame, vector: Column, query: list[float], order: list[str], k: int) -> DataFrame:
    """The k rows nearest to the query: one pass, no shuffle but the final k of each task. Ties go by `order`."""
    return rows.withColumn("score", T.cosine(vector, vector_literal(query))).orderBy(F.desc("score"), *order).limit(k)


def question_terms(spark: SparkSession, question: str) -> dict[str, int]:
    """The question's words, each with how often it stands there."""
    found: dict[str, int] = {}
    for t in spark.range(1).select(T.tokens(F.lit(question))).first()[0]:
        found[t] = found.get(t, 0) + 1
    return found


def semantic(index: SearchIndex, question: str) -> DataFrame:
    """key and cosine score of every chunk of the index; it has the vectors and their norms, of which only the places that the question fills count."""
    spark = index.chunks.sparkSession
    query = embed_query(spark, question)
    size = T.norm(query)
    if not size:
        return index.chunks.select(*index.key, F.lit(0.0).alias("score"))
    ship(spark)

    @F.pandas_udf(DoubleType())
    def dot(vector: pd.Series) -> pd.Series:
        return vector.map(lambda v: T.fused_dot(v.tolist(), query), na_action="ignore")

    score = F.when(F.col("norm") > 0, F.coalesce(dot(F.slice("vector", 1, len(query))), F.lit(0.0)) / (F.col("norm") * size)).otherwise(0.0)
    return index.chunks.select(*index.key, score.alias("score"))


#: Numbers of what an index's version shows that any question may need, by its name.
_KNOWN: dict[tuple[str, str], tuple] = {}


def _known(index: SearchIndex, what: str, find: Callable[[], tuple]) -> tuple:
    if (index.name, what) not in _KNOWN:
        _KNOWN[index.name, what] = find()
    return _KNOWN[index.name, what]


def _idf(n: Column, df: Column) -> Column:
    return F.ln(n - df + 0.5) - F.ln(df + 0.5)


def _mean_idf(index: SearchIndex, n: int) -> float:
    df = index.terms.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    return df.agg(F.avg(_idf(F.lit(n), F.col("df")))).first()[0]


def _gain(tf: Column, dl: Column, mean_dl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / mean_dl))


def _term_weights(index: SearchIndex, question: str) -> tuple[dict[str, float], float]:
    """The weights of the question's words that the index holds, and the chunks' mean length. Statistics are over exactly the index's chunks."""
    asked = question_terms(index.postings.sparkSession, question)
    n, dl = _known(index, "sizes", lambda: tuple(index.sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("dl"), F.lit(0))).first()))
    found = {r["term"]: r["df"] for r in index.terms.filter(F.col("term").isin(list(asked))).groupBy("term").agg(F.sum("df").alias("df")).collect()} if n else {}
    idf = {t: math.log(n - df + 0.5) - math.log(df + 0.5) for t, df in found.items() if df > 0}
    if any(v < 0 for v in idf.values()):
        mean = _known(index, "mean idf", lambda: (_mean_idf(index, n),))[0]
        idf = {t: v if v >= 0 else NEGATIVE_IDF * mean for t, v in idf.items()}
    return {t: asked[t] * v for t, v in idf.items()}, dl / n if dl else 1.0


def _weight(weights: dict[str, float]) -> Column:
    """The weight of a row's term."""
    return F.element_at(F.map_from_arrays(F.array(*map(F.lit, weights)).cast("array<string>"), F.array(*map(F.lit, weights.values())).cast("array<double>")), F.col("term"))


#: Scores are added up as multiples of 1 / UNIT, so that equal shares give equal sums in whatever order they come.
UNIT = float(2**40)


def _total(share: Column) -> Column:
    return F.sum(F.rint(share * UNIT).cast("long")) / UNIT  # round() would go through decimal strings


def _bm25_scores(hits: DataFrame, key: tuple[str, ...], weights: dict[str, float], mean_dl: float) -> DataFrame:
    return hits.groupBy(*key).agg(_total(_weight(weights) * _gain(F.col("tf"), F.col("dl"), F.lit(mean_dl))).alias("score"))


def bm25(index: SearchIndex, question: str) -> DataFrame:
    """key and score of all chunks that hold a word of the question. Statistics are over exactly the index's chunks.

    The question's words are looked up first, and only their postings are read. The mean idf, which replaces a negative one, needs a pass over all words; it is made only if a word is in over half of the chunks, and remembered for what of the version is seen.
    """
    weights, mean_dl = _term_weights(index, question)
    return _bm25_scores(index.postings.filter(F.col("term").isin(list(weights))), index.key, weights, mean_dl)


#: Blocks scored first, ranges of blocks that are pushed down into the scan, and slices of the blocks' numbers from which the ranges are made.
FIRST_BLOCKS, RANGES, SLICES = 32, 16, 1_024
#: What sums in another order may differ by, relative and absolute.
ROUNDING = 1e-9


def _in_ranges(blocks: DataFrame) -> Column:
    """A condition on `block` that holds for all of blocks, and for few others: at most RANGES ranges, parted at the widest gaps between the blocks of SLICES slices."""
    last = blocks.agg(F.max("block")).first()[0]
    if last is None:
        return F.lit(False)
    width = last // SLICES + 1
    found = sorted(tuple(r) for r in blocks.groupBy(F.floor(F.col("block") / width)).agg(F.min("block").alias("low"), F.max("block").alias("high")).select("low", "high").collect())
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][1] - found[i][0])[: RANGES - 1]
    cuts = [0, *sorted(gaps), len(found)]
    out = F.lit(False)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out = out | F.col("block").between(found[a][0], found[b - 1][1])
    return out


def bm25_hits(index: SearchIndex, weights: dict[str, float], mean_dl: float, k: int) -> DataFrame:
    """The postings among which the k best chunks by BM25 are. The bound of a block is the sum of what its greatest tf and least length score for each word. The FIRST_BLOCKS of greatest bound are scored; blocks whose bound is less than the k-th score there hold none of the k best and are left out."""
    place = ["segment", *LABELS, "block"]
    asked = F.col("term").isin(list(weights))
    most = F.greatest(_weight(weights), F.lit(0.0)) * _gain(F.col("top_tf"), F.col("least_dl"), F.lit(mean_dl))
    blocks = index.bounds.filter(asked).groupBy(*place).agg((F.sum(most) * (1 + ROUNDING) + ROUNDING).alias("most"))
    first = [r["block"] for r in blocks.orderBy(F.desc("most"), *place).limit(FIRST_BLOCKS).collect()]
    hits = index.postings.filter(asked)
    best = _bm25_scores(hits.filter(F.col("block").isin(first)), index.key, weights, mean_dl).orderBy(F.desc("score")).limit(k).collect()
    if len(best) < k:
        return hits
    kept = blocks.filter(F.col("most") >= best[-1]["score"]).select(*place)
    return hits.filter(_in_ranges(kept)).join(kept, place, "left_semi")


def bm25_best(index: SearchIndex, question: str, k: int) -> DataFrame:
    """key and score of the k best chunks by bm25, ties by key, from the blocks that can hold them."""
    weights, mean_dl = _term_weights(index, question)
    return _bm25_scores(bm25_hits(index, weights, mean_dl, k), index.key, weights, mean_dl).orderBy(F.desc("score"), *index.key).limit(k)


def term_hits(index: SearchIndex, question: str) -> DataFrame:
    """key and score: occurrences of any of the question's words."""
    hits = index.postings.filter(F.col("term").isin(list(question_terms(index.postings.sparkSession, question))))
    return hits.groupBy(*index.key).agg(F.sum("tf").cast("double").alias("score"))


#: Weight of an occurrence in a cover.
COVER_WEIGHT = 0.1


def cover_score(places: list[list[int]]) -> float:
    """Cover density of a chunk from the ascending places of each asked word in it: the sum over its least covers (stretches that hold every word and no shorter one that does) of COVER_WEIGHT / (1 + the words in the stretch that weren't asked)."""
    merged = sorted((at, word) for word, found in enumerate(places) for at in found)
    held, inside, left, covers = [0] * len(places), 0, 0, []
    for right, (at, word) in enumerate(merged):
        held[word] += 1
        inside += held[word] == 1
        while inside == len(places):
            first, leaves = merged[left]
            held[leaves] -= 1
            left += 1
            if not held[leaves]:  # without its first word the stretch is no cover: it was the least one that begins there
                inside -= 1
                covers.append((first, at, right - left + 1))
    # more - 1 of the words between first and last were asked
    return sum(COVER_WEIGHT / (1 + (last - first) - more) for first, last, more in covers)


@F.pandas_udf(DoubleType())
def _cover_scores(places: pd.Series) -> pd.Series:
    return places.map(lambda p: cover_score([list(x) for x in p]))


def cover_density(index: SearchIndex, question: str, every_word: bool = False) -> DataFrame:
    """key and score: how densely a chunk covers the question's words. Of a question that any word answers each occurrence is a cover of its own, so the score is COVER_WEIGHT for each; with every_word a chunk must hold all of them, and its covers are found by merging the words' places.

    Only the postings of the question's words are read; a chunk's places come together for those alone.
    """
    ship(index.postings.sparkSession)
    asked = list(question_terms(index.postings.sparkSession, question))
    hits = index.postings.filter(F.col("term").isin(asked))
    if not every_word:
        return hits.groupBy(*index.key).agg((F.sum("tf") * COVER_WEIGHT).alias("score"))
    held = hits.groupBy(*index.key).agg(F.collect_list("places").alias("p")).filter((F.size("p") == len(asked)) & F.lit(bool(asked)))
    return held.select(*index.key, _cover_scores("p").alias("score"))


def ranked(scores: DataFrame, order: list[str], k: int, name: str) -> DataFrame:
    """The k best with their place from 1, as column `name`. The window runs over k rows."""
    top = scores.orderBy(F.desc("score"), *order).limit(k)
    return top.withColumn(name, F.row_number().over(Window.orderBy(F.desc("score"), *order)))


def rrf(lists: list[DataFrame], key: list[str], k: int = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists (key, score, rank, list_id); lists of even numbers are semantic."""
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    return out.groupBy(*key).agg(F.sum(1.0 / (k + F.col("rank"))).alias("rrf_score"), F.min(F.when(F.col("list_id") % 2 == 0, F.col("rank"))).alias("semantic_rank"), F.max(F.when(F.col("list_id") % 2 == 0, F.col("score"))).alias("semantic_score"), F.min(F.when(F.col("list_id") % 2 == 1, F.col("rank"))).alias("lexical_rank"))


def hybrid_search(index: SearchIndex, question: str, clearance: str, departments: list[str] | str = access.ALL, top_k: int = TOP, candidate_k: int = CANDIDATES, rrf_k: int = RRF_K, by_department: bool = False) -> DataFrame:
    """The fused top_k of what may be seen: key columns, the chunk's columns, score, rrf_score, in_semantic_results, in_lexical_results and mode: hybrid, or semantic_only for a question without words to look up.

    Filters come before both rankings. Ties: higher rrf_score, then semantic place, then lexical place. by_department ranks every department on its own, all in one pass, and fuses the lists.
    """
    keys = list(index.key)
    if by_department:
        one = index.chunks.sparkSession.createDataFrame([(0, question)], "question_no int, question string")
        return search_many(index, one, clearance, departments, top_k, candidate_k, rrf_k, by_department=True).drop("question_no", "place")
    seen = index.visible(clearance, departments)
    lexical_mode = bool(question_terms(index.chunks.sparkSession, question))
    lists = [ranked(semantic(seen, question), keys, candidate_k, "rank").withColumn("list_id", F.lit(0))]
    if lexical_mode:
        lists.append(ranked(bm25(seen, question).filter("score > 0"), keys, candidate_k, "rank").withColumn("list_id", F.lit(1)))
    fused = rrf(lists, keys, rrf_k)
    top = fused.orderBy(F.desc("rrf_score"), F.asc_nulls_last("semantic_rank"), F.asc_nulls_last("lexical_rank"), *keys).limit(top_k)
    return _shown(index, seen, top.withColumn("mode", F.lit("hybrid" if lexical_mode else "semantic_only")), [])


def _shown(index: SearchIndex, seen: SearchIndex, top: DataFrame, more: list[str]) -> DataFrame:
    """The chunks of a few fused rows."""
    hidden = {*index.key, *ADDED, *LABELS, "segment"}
    rest = [c for c in seen.chunks.columns if c not in hidden]
    out = seen.chunks.select(*index.key, *rest).join(F.broadcast(top), list(index.key))
    return out.select(*more, *index.key, *rest, F.coalesce("semantic_score", F.lit(0.0)).alias("score"), "rrf_score", F.col("semantic_rank").isNotNull().alias("in_semantic_results"), F.col("lexical_rank").isNotNull().alias("in_lexical_results"), "mode")


#: Questions whose vectors go to the tasks together: 12 MB.
QUESTIONS_AT_ONCE = 2_000


def best_by(scores: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The k best rows of each group with their place from 1 as `rank`. Spark keeps k rows of a group in each task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), *order))
    return scores.withColumn("rank", place).filter(F.col("rank") <= k)


def lexical_many(index: SearchIndex, questions: DataFrame, scope: Column, k: int) -> DataFrame:
    """question_no, scope, key, score, rank: the k best by BM25 for each of questions (question_no, question) and value of scope (a column of labels, or a constant), whose statistics are the scope's own.

    The questions' words, of which there are few, meet the postings in one join without shuffling these.
    """
    keys = list(index.key)
    asked = questions.select("question_no", F.explode(T.tokens(F.col("question"))).alias("term")).groupBy("question_no", "term").agg(F.count("*").alias("weight"))
    sizes = index.sizes.groupBy(scope.alias("scope")).agg(F.sum("n").alias("n"), (F.sum("dl") / F.sum("n")).alias("mean_dl"))
    # scopes are few, so their statistics are
    df = index.terms.groupBy(scope.alias("scope"), "term").agg(F.sum("df").alias("df")).filter("df > 0")
    idf = df.join(F.broadcast(sizes), "scope").withColumn("idf", _idf(F.col("n"), F.col("df")))
    means = idf.groupBy("scope").agg(F.avg("idf").alias("mean"))
    words = F.broadcast(asked.select("term").distinct())
    weights = idf.join(words, "term").join(F.broadcast(means), "scope")
    value = F.when(F.col("idf") < 0, NEGATIVE_IDF * F.col("mean")).otherwise(F.col("idf"))
    weights = weights.join(asked, "term").select("question_no", "scope", "term", "mean_dl", (F.col("weight") * value).alias("w"))
    hits = index.postings.select(scope.alias("scope"), "term", *keys, "tf", "dl").join(F.broadcast(weights), ["term", "scope"])
    scores = hits.groupBy("question_no", "scope", *keys).agg(_total(F.col("w") * _gain(F.col("tf"), F.col("dl"), F.col("mean_dl"))).alias("score")).filter("score > 0")
    return best_by(scores, ["question_no", "scope"], keys, k)


#: Questions whose products with a batch of chunks are held together: 5 MB.
PRODUCTS_AT_ONCE = 64


def _nearest(keys: list[str], numbers: list[int], questions: list[list[float]], k: int) -> Callable:
    """For batches of chunks (scope, keys, norm, vector as far as a question goes): each question's k best of each scope in the batch, from matrix products; the few that may be among them are measured again, term by term, so that equal vectors get equal scores."""
    width = max(1, *map(len, questions))
    vectors, sizes = np.array([np.pad(v, (0, width - len(v))) for v in questions]), [T.norm(v) for v in questions]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("vector")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            row, start = np.repeat(np.arange(b.num_rows), counts), np.cumsum(counts) - counts
            matrix = np.zeros((b.num_rows, width))
            matrix[row, np.arange(len(row)) - np.repeat(start, counts)] = np.asarray(lists.flatten())
            norms = np.asarray(b.column("norm"))
            scopes = b.column("scope").to_pylist()
            groups = {s: np.array([i for i, x in enumerate(scopes) if x == s]) for s in set(scopes)}
            key_rows = list(zip(*(b.column(c).to_pylist() for c in keys)))
            out: list[tuple] = []
            for q, number in enumerate(numbers):
                if q % PRODUCTS_AT_ONCE == 0:
                    rough = matrix @ vectors[q : q + PRODUCTS_AT_ONCE].T
                    length = norms[:, None] * np.array(sizes[q : q + PRODUCTS_AT_ONCE])[None, :]
                    rough = np.divide(rough, length, out=np.zeros_like(rough), where=length > 0)
                for s, rows in groups.items():
                    score = rough[rows, q % PRODUCTS_AT_ONCE]
                    least = np.partition(score, len(score) - k)[len(score) - k] - 1e-9 if len(score) > k else -np.inf
                    near = rows[score >= least].tolist()
                    exact = [T.fused_dot(matrix[i].tolist(), questions[q]) / (norms[i] * sizes[q]) if norms[i] > 0 and sizes[q] > 0 else 0.0 for i in near]
                    first = sorted(zip(exact, near), key=lambda x: (-x[0], [(v is not None, v) for v in key_rows[x[1]]]))[:k]
                    out += [(number, s, key_rows[i], d) for d, i in first]
            columns = [pa.array([r[2][j] for r in out], b.schema.field(c).type) for j, c in enumerate(keys)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()), *columns, pa.array([r[3] for r in out], pa.float64())], names=["question_no", "scope", *keys, "score"])

    return run


def semantic_many(index: SearchIndex, questions: DataFrame, scope: Column, k: int) -> DataFrame:
    """question_no, scope, key, score, rank: the k best by cosine for each of questions (question_no, question) and value of scope.

    The chunks are read once for QUESTIONS_AT_ONCE questions, whose vectors go with the tasks; no vector is shuffled, only each batch's best.
    """
    keys = list(index.key)
    chunks = index.chunks.select(scope.alias("scope"), *keys, "norm", "vector")  # of the vectors only what the questions fill is sent
    kinds = ", ".join(f"`{c}` {index.chunks.schema[c].dataType.simpleString()}" for c in keys)
    vectors = questions.select("question_no", T.hash_vectors("question").alias("v"))
    parts, block, numbers = None, [], []

    def flush() -> DataFrame:
        width = max(1, *map(len, block))
        scores = chunks.withColumn("vector", F.slice("vector", 1, width)).mapInArrow(_nearest(keys, numbers, block, k), f"question_no long, scope string, {kinds}, score double")
        return scores if parts is None else parts.unionByName(scores)

    for r in vectors.toLocalIterator():  # a block of questions at a time
        block.append(list(r["v"] or []))
        numbers.append(r["question_no"])
        if len(block) == QUESTIONS_AT_ONCE:
            parts = flush()
            block, numbers = [], []
    if block or parts is None:
        block, numbers = block or [[0.0]], numbers or [-1]
        parts = flush()
    return best_by(parts, ["question_no", "scope"], keys, k)


def search_many(index: SearchIndex, questions: DataFrame, clearance: str, departments: list[str] | str = access.ALL, top_k: int = TOP, candidate_k: int = CANDIDATES, rrf_k: int = RRF_K, by_department: bool = False) -> DataFrame:
    """hybrid_search for every row of questions (question_no, question; numbers are unique), with question_no and `place` in its result: one plan for all. A null question is empty; without questions no rows.

    by_department ranks each known department on its own and fuses all lists.
    """
    ship(index.chunks.sparkSession)
    keys = list(index.key)
    seen = index.visible(clearance, departments)
    scope = F.lit("")
    if by_department:
        seen, scope = seen.where(F.col("in_department").isin(access.DEPARTMENTS), "known departments"), F.col("in_department")
    asked = questions.select(F.col("question_no").cast("long").alias("question_no"), F.coalesce("question", F.lit("")).alias("question"))
    lists = semantic_many(seen, asked, scope, candidate_k).withColumn("list_id", F.lit(0)).unionByName(lexical_many(seen, asked, scope, candidate_k).withColumn("list_id", F.lit(1)))
    fused = rrf([lists], ["question_no", *keys], rrf_k)
    order = Window.partitionBy("question_no").orderBy(F.desc("rrf_score"), F.asc_nulls_last("semantic_rank"), F.asc_nulls_last("lexical_rank"), *keys)
    top = fused.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top_k)
    mode = F.when(F.size(T.tokens(F.col("question"))) > 0, "hybrid").otherwise("semantic_only")
    told = asked.select(F.col("question_no").alias("_q"), mode.alias("mode"))
    return _shown(index, seen, top.join(told, F.col("question_no") == F.col("_q")), ["question_no", "place"])


def regression(index: SearchIndex, labelled: DataFrame, source: str, clearance: str = "Restricted", top_k: int = 3) -> DataFrame:
    """question_no, hit of labelled (question_no, question, expected): whether the expected name stands in the source of one of the question's first top_k chunks. All questions are answered in one plan."""
    found = search_many(index, labelled, clearance, top_k=top_k).select(F.col("question_no").alias("_q"), F.col(source).alias("_s"))
    hit = F.coalesce(F.bool_or(F.col("_s").contains(F.col("expected"))), F.lit(False))
    return labelled.join(found, F.col("question_no") == F.col("_q"), "left").groupBy("question_no").agg(hit.alias("hit"))


def regression_score(hits: DataFrame) -> DataFrame:
    """The quality metric retrieval_regression: percent of questions that hit."""
    return hits.agg(F.lit("retrieval_regression").alias("metric"), F.round(100.0 * F.count_if("hit") / F.nullif(F.count("*"), F.lit(0)), 1).alias("score")).select("metric", "score")


def context(results: DataFrame, order: list[str], group: list[str] | None = None) -> DataFrame:
    """The chunks of a result as a prompt's context: numbered from 1 and parted by blank lines. A result is a top-k, so the group is small."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, "content"))), lambda x, i: F.concat(F.lit("Chunk "), (i + 1).cast("string"), F.lit(": "), x["content"]))
    return (results.groupBy(*group) if group else results).agg(F.array_join(parts, "\n\n").alias("context"))


def fallback_text(order: list[str], size: int = 400) -> Column:
    """Aggregate: the answer without a model, the leading characters of each retrieved chunk in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.substring("content", 1, size).alias("part")))), lambda x: x["part"])
    return F.when(F.count("*") == 0, "No relevant context was found.").otherwise(F.concat(F.lit("Based on the retrieved context, the answer appears to be: "), F.array_join(parts, " ")))


def fallback_answer(results: DataFrame, order: list[str], group: list[str] | None = None, size: int = 400) -> DataFrame:
    """fallback_text of a result, or of each group of it. A retrieved list is a top-k, so the group is small."""
    return (results.groupBy(*group) if group else results).agg(fallback_text(order, size).alias("answer"))


def evaluate(results: DataFrame, answer: Column | None = None) -> DataFrame:
    """Mean fused score and number of chunks of a result, words of the answer (an aggregate over the result, as fallback_text), and status: ok, or no_context without chunks."""
    words = F.lit(0) if answer is None else F.coalesce(F.size(T.words(answer)), F.lit(0))
    return results.agg(F.count("*").alias("chunk_count"), F.round(F.coalesce(F.sum("rrf_score"), F.lit(0.0)) / F.greatest(F.lit(1), F.count("*")), 6).alias("mean_score"), words.alias("answer_words"), F.when(F.count("*") > 0, "ok").otherwise("no_context").alias("status"))
