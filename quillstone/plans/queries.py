"""Registered queries with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import access, dialogue, sql as functions_sql, text as T
from quillstone.operators import accuracy, ann_index, chunking, index, joins, quality_report, registry, retrieval, search_index, session, validation
from quillstone.plans import views as V
from quillstone.plans.views import QUESTION, RANK, WORDS, WS, ranking_ctes, sql
from quillstone.session import shared_dir, ship
from quillstone.sources import files
from quillstone.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


ROUND = lambda c: F.round(c, 5)


_FUSE = """rs{tag} as (select doc_id, window_no, score, row_number() over (order by score desc, doc_id, window_no) r from sem{tag} qualify r <= 30),
rl{tag} as (select doc_id, window_no, row_number() over (order by score desc, doc_id, window_no) r from lex{tag} where score > 0 qualify r <= 30)"""
_FUSED = """doc_id, window_no, round(coalesce(score, 0), 5) score, round(rrf, 8) rrf_score, sr is not null in_semantic_results, lr is not null in_lexical_results
from (select coalesce(rs.doc_id, rl.doc_id) doc_id, coalesce(rs.window_no, rl.window_no) window_no, rs.score, rs.r sr, rl.r lr, coalesce(1.0::double / (60 + rs.r), 0) + coalesce(1.0::double / (60 + rl.r), 0) rrf from rs full join rl on rs.doc_id = rl.doc_id and rs.window_no = rl.window_no)
order by rrf desc, sr nulls last, lr nulls last, doc_id, window_no limit 5"""


def _hybrid(clearance: str, departments="All", **how):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = retrieval.hybrid_search(V.index(spark, sf_dir), QUESTION, clearance, departments, **how)
        return out.select("doc_id", "window_no", ROUND("score").alias("score"), F.round("rrf_score", 8).alias("rrf_score"), "in_semantic_results", "in_lexical_results")

    return run


# Chunking


@query(sql("select chunk_id, doc_id, chunk_number::int chunk_number, total_chunks_in_document, chunk_size, content_hash from chunks", "chunks"))
def chunk_lineage(spark, sf_dir):
    return V.chunks(spark, sf_dir).select("chunk_id", "doc_id", "chunk_number", "total_chunks_in_document", "chunk_size", "content_hash")


@query(sql("select chunk_id, doc_id, chunk_number::int chunk_number, total_chunks_in_document, chunk_size, content_hash from chunks", "chunks"))
def chunk_lineage_sql(spark, sf_dir):
    """chunk_lineage written in Spark SQL with the kernel's functions."""
    functions_sql.register(spark)
    V.governed(spark, sf_dir).createOrReplaceTempView("qs_governed")
    return spark.sql("""
        with windows as (
            select d.doc_id, qs_document_id(d.text) document_id, c.window_no, c.content, sha2(c.content, 256) content_hash
            from qs_governed d, lateral qs_chunk_text(d.text, 512, 100) c),
        firsts as (
            select content_hash, min_by(struct(doc_id, document_id, window_no, content), struct(doc_id is null, doc_id, window_no)) r from windows group by content_hash),
        placed as (
            select r.*, content_hash, row_number() over (partition by r.doc_id, r.document_id order by r.window_no) chunk_number, count(*) over (partition by r.doc_id, r.document_id) total_chunks_in_document from firsts)
        select qs_chunk_id(document_id, chunk_number) chunk_id, doc_id, chunk_number, total_chunks_in_document, size(qs_words(content)) chunk_size, content_hash from placed""")


@query(sql(f"select doc_id, len({WORDS('text')})::int n_words, sha256(array_to_string({WORDS('text')}, ' ')) collapsed, {RANK.format('sensitivity')} as level, {RANK.format('sensitivity')} <= 1 as internal from governed", "governed"))
def kernel_sql(spark, sf_dir):
    """Words, white space and access rules by the functions of Spark SQL."""
    functions_sql.register(spark)
    V.governed(spark, sf_dir).createOrReplaceTempView("qs_governed")
    return spark.sql("select doc_id, size(qs_words(text)) n_words, sha2(qs_collapse(text), 256) collapsed, qs_access_rank(sensitivity) level, qs_is_allowed(sensitivity, 'Internal') internal from qs_governed")


@query(sql("select doc_id, window_no::int window_no, sha256(content) content_hash from windowed", "windowed"))
def chunk_windows(spark, sf_dir):
    return chunking.windowed(V.governed(spark, sf_dir)).select("doc_id", "window_no", "content_hash")


@query(sql("select doc_id, min(window_no)::int first_window, count(*) n_windows from (select *, sha256(content) h from windowed qualify row_number() over (partition by sha256(content) order by doc_id, window_no) = 1) group by doc_id", "windowed"))
def dedup_first(spark, sf_dir):
    return chunking.first_occurrences(chunking.windowed(V.governed(spark, sf_dir))).groupBy("doc_id").agg(F.min("window_no").alias("first_window"), F.count("*").alias("n_windows"))


@query("select doc_id, 'doc_' || substr(sha256(text), 1, 16) document_id, sha256(text) file_hash, sha256(array_to_string(" + WORDS("text") + ", ' ')) content_hash from documents")
def doc_ids(spark, sf_dir):
    h = F.sha2("text", 256)
    return V.table(spark, sf_dir, "documents").select("doc_id", T.document_id(h).alias("document_id"), h.alias("file_hash"), T.content_hash(F.col("text")).alias("content_hash"))


_BOILER = T.BOILERPLATE_RE.replace("(?i)^", "^")


@query(
    sql(
        f"""select doc_id, len(string_split(c, chr(10))) n_lines, sha256(c) cleaned_hash from (
select doc_id, regexp_replace(regexp_replace(coalesce(string_agg(regexp_replace(x, '{WS}$', ''), chr(10) order by i), ''), '^{WS}', ''), '{WS}$', '') c from (
select doc_id, x, i, regexp_matches(x, '[^\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]') b, lag(b) over (partition by doc_id order by i) p from (
select doc_id, unnest(l) x, unnest(range(len(l))) i from (select doc_id, string_split(text, chr(10)) l from markdown)) where not regexp_matches(x, '{_BOILER}', 'i')) where b or p is null or p group by doc_id)""",
        "markdown",
    )
)
def clean_lines(spark, sf_dir):
    c = T.clean(F.col("text"))
    return V.markdown(spark, sf_dir).select("doc_id", c.alias("c")).select("doc_id", F.size(F.split("c", "\n")).alias("n_lines"), F.sha2("c", 256).alias("cleaned_hash"))


@query(
    sql(
        f"""select doc_id, (row_number() over (partition by doc_id order by s) - 1)::int section_no, title, sha256(b) body_hash from (
select doc_id, s, regexp_replace(regexp_replace(any_value(t) filter (h), '^#+\\s+', ''), '{WS}$', '') title, regexp_replace(regexp_replace(coalesce(string_agg(t, chr(10) order by i) filter (not h), ''), '^{WS}', ''), '{WS}$', '') b from (
select *, count(*) filter (h) over (partition by doc_id order by i) s from (
select doc_id, t, i, regexp_matches(t, '^#{{1,6}}\\s+.+$') h from (select doc_id, unnest(l) t, unnest(range(len(l))) i from (select doc_id, string_split(text, chr(10)) l from markdown)))) where s > 0 group by doc_id, s) where b <> ''""",
        "markdown",
    )
)
def split_sections(spark, sf_dir):
    rows = V.markdown(spark, sf_dir).select("doc_id", F.posexplode(T.sections(F.col("text"))).alias("section_no", "s"))
    return rows.select("doc_id", "section_no", F.col("s.title").alias("title"), F.sha2("s.body", 256).alias("body_hash"))


# Embeddings and ranking


@query(
    "select doc_id, coalesce(n, 0)::int n_dims, coalesce(round(t, 3), 0) total, coalesce(f, 0) first_value from documents left join (select doc_id, count(*) n, sum(v) t, max(v) filter (d = 0) f from (select doc_id, d, round(sum(x), 6) v from (select doc_id, i % 768 d, ('0x' || substr(sha256(t), 1, 8))::ubigint::double / 4294967295 x from (select doc_id, unnest(w) t, unnest(range(len(w))) i from (select doc_id, "
    + WORDS("translate(text, chr(10) || '/', '  ')")
    + " w from documents))) group by all) group by doc_id) using (doc_id)"
)
def hash_embedding(spark, sf_dir):
    """Every document's vector; a text without a word has the zero vector, of which no value is kept."""
    ship(spark)
    v = V.table(spark, sf_dir, "documents").select("doc_id", T.hash_vectors(F.col("text")).alias("v"))
    return v.select("doc_id", F.size("v").alias("n_dims"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 3).alias("total"), F.coalesce(F.get("v", F.lit(0)), F.lit(0.0)).alias("first_value"))


@query("select vec_id, round(list_cosine_similarity(embedding::double[], (select embedding::double[] from embeddings where vec_id = 0)), 5) score from embeddings order by list_cosine_similarity(embedding::double[], (select embedding::double[] from embeddings where vec_id = 0)) desc, vec_id limit 10")
def cosine_topk(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    query_vector = rows.filter("vec_id = 0").first()["embedding"]
    return retrieval.cosine_topk(rows, F.col("embedding"), query_vector, ["vec_id"], 10).select("vec_id", ROUND("score").alias("score"))


@query(sql(f"select * from (with {ranking_ctes('true')} select doc_id, window_no::int window_no, round(score, 4) score from lex where score > 0 order by lex.score desc, doc_id, window_no limit 30)", "tokens"))
def bm25_topk(spark, sf_dir):
    scores = retrieval.bm25(V.index(spark, sf_dir), QUESTION).filter("score > 0")
    return scores.orderBy(F.desc("score"), "doc_id", "window_no").limit(30).select("doc_id", "window_no", F.round("score", 4).alias("score"))


@query(sql(f"select * from (with {ranking_ctes('true')} select doc_id, window_no::int window_no, round(score, 4) score from lex where score > 0 order by lex.score desc, doc_id, window_no limit 30)", "tokens"))
def bm25_early_end(spark, sf_dir):
    """As bm25_topk, from the blocks of postings alone that can reach the thirtieth score."""
    return retrieval.bm25_best(V.index(spark, sf_dir), QUESTION, 30).filter("score > 0").select("doc_id", "window_no", F.round("score", 4).alias("score"))


@query(sql("select doc_id, window_no::int window_no, len(list_filter(ts, lambda t: t in ('the', 'privacy', 'and', 'license')))::double score from tokens where score > 0 order by score desc, doc_id, window_no limit 30", "tokens"))
def term_hits_topk(spark, sf_dir):
    return retrieval.term_hits(V.index(spark, sf_dir), QUESTION).orderBy(F.desc("score"), "doc_id", "window_no").limit(30)


@query(sql("select doc_id, window_no::int window_no, round(0.1 * len(list_filter(ts, lambda t: t in ('the', 'privacy', 'and', 'license'))), 6)::double score from tokens where score > 0 order by score desc, doc_id, window_no limit 30", "tokens"))
def cover_density_topk(spark, sf_dir):
    """Chunks by cover density of a question that any of its words answers."""
    scores = retrieval.cover_density(V.index(spark, sf_dir), QUESTION)
    return scores.select("doc_id", "window_no", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc_id", "window_no").limit(30)


_COVERED = "the and of"


@query()
def cover_density_every_word(spark, sf_dir):
    """Every chunk that holds all words of a question, with its cover density."""
    return retrieval.cover_density(V.index(spark, sf_dir), _COVERED, every_word=True).select("doc_id", "window_no", F.round("score", 6).alias("score"))


def _rank_lists(tag: str = "") -> str:
    return _FUSE.format(tag=tag)


@query(sql(f"select doc_id, window_no::int window_no, round(rrf, 8) rrf_score from (with {ranking_ctes('true')}, {_rank_lists()} select coalesce(rs.doc_id, rl.doc_id) doc_id, coalesce(rs.window_no, rl.window_no) window_no, coalesce(1.0::double / (60 + rs.r), 0) + coalesce(1.0::double / (60 + rl.r), 0) rrf from rs full join rl on rs.doc_id = rl.doc_id and rs.window_no = rl.window_no)", "tokens"))
def rrf_fusion(spark, sf_dir):
    held, key = V.index(spark, sf_dir), ["doc_id", "window_no"]
    semantic = retrieval.ranked(retrieval.semantic(held, QUESTION), key, 30, "rank").withColumn("list_id", F.lit(0))
    lexical = retrieval.ranked(retrieval.bm25(held, QUESTION).filter("score > 0"), key, 30, "rank").withColumn("list_id", F.lit(1))
    return retrieval.rrf([semantic, lexical], key).select(*key, F.round("rrf_score", 8).alias("rrf_score"))


def _hybrid_oracle(clearance: int, where: str = "true") -> str:
    return sql(f"select doc_id, window_no::int window_no, score, rrf_score, in_semantic_results, in_lexical_results from (with {ranking_ctes(f'{RANK.format("sensitivity")} <= {clearance} and {where}')}, {_rank_lists()} select {_FUSED})", "tokens")


for _name, _rank in (("public", 0), ("internal", 1), ("restricted", 3)):
    QUERIES[f"hybrid_search_{_name}"] = _hybrid(_name.capitalize())
    ORACLES[f"hybrid_search_{_name}"] = _hybrid_oracle(_rank)
QUERIES["hybrid_department"] = _hybrid("Confidential", ["Legal"])
ORACLES["hybrid_department"] = _hybrid_oracle(2, "(department is null or department in ('', 'General', 'Legal'))")


def _by_department_oracle() -> str:
    parts, lists = [], []
    for d in sorted(access.DEPARTMENTS):
        tag = f"_{d.lower()}"
        parts.append(ranking_ctes(f"{RANK.format('sensitivity')} <= 3 and coalesce(department, 'General') = '{d}'", tag=tag) + ", " + _rank_lists(tag))
        lists += [f"select doc_id, window_no, score, r sr, null lr from rs{tag}", f"select doc_id, window_no, null, null, r from rl{tag}"]
    body = f"select doc_id, window_no, max(score) score, min(sr) sr, min(lr) lr, sum(1.0::double / (60 + coalesce(sr, lr))) rrf from ({' union all '.join(lists)}) group by doc_id, window_no order by rrf desc, sr nulls last, lr nulls last, doc_id, window_no limit 5"
    return sql(f"select doc_id, window_no::int window_no, round(coalesce(score, 0), 5) score, round(rrf, 8) rrf_score, sr is not null in_semantic_results, lr is not null in_lexical_results from (with {', '.join(parts)} {body})", "tokens")


QUERIES["hybrid_by_department"] = _hybrid("Restricted", by_department=True)
ORACLES["hybrid_by_department"] = _by_department_oracle()


_GROWN = "(doc_id % 9 <> 0 or doc_id % 2 = 0)"


@query(sql(f"select * from (with {ranking_ctes(_GROWN)} select doc_id, window_no::int window_no, round(score, 4) score from lex where score > 0 order by lex.score desc, doc_id, window_no limit 30)", "tokens"))
def index_update_bm25(spark, sf_dir):
    """BM25 over an index that grew by inserts, changes, deletions and a merge: as over one built anew."""
    scores = retrieval.bm25(V.grown_index(spark, sf_dir), QUESTION).filter("score > 0")
    return scores.orderBy(F.desc("score"), "doc_id", "window_no").limit(30).select("doc_id", "window_no", F.round("score", 4).alias("score"))


def _grown_hybrid(spark, sf_dir):
    out = retrieval.hybrid_search(V.grown_index(spark, sf_dir), QUESTION, "Confidential", ["Legal", "HR"])
    return out.select("doc_id", "window_no", ROUND("score").alias("score"), F.round("rrf_score", 8).alias("rrf_score"), "in_semantic_results", "in_lexical_results")


QUERIES["index_update_hybrid"] = _grown_hybrid
ORACLES["index_update_hybrid"] = _hybrid_oracle(2, f"(department is null or department in ('', 'General', 'Legal', 'HR')) and {_GROWN}")


@query("select department, sensitivity, count(*) n, sum(len(content))::bigint chars from (" + sql(f"select department, sensitivity, content from chunks where {_GROWN}", "chunks") + ") group by all")
def index_update_chunks(spark, sf_dir):
    """What the grown index holds."""
    return V.grown_index(spark, sf_dir).chunks.groupBy("department", "sensitivity").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"))


def _many_oracle() -> str:
    """Hybrid search of all benchmark texts over the Internal chunks, fused by question."""
    value = "('0x' || substr(sha256(t), 1, 8))::ubigint::double / 4294967295"
    vec = lambda c: f"list_transform(list_filter(string_split_regex(translate({c}, chr(10) || '/', '  '), '{WS}'), lambda x: x <> ''), lambda t: round({value}, 6))"
    word = lambda c: f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+')"
    body = f"""seen as (select * from tokens where {RANK.format('sensitivity')} <= 1),
q as (select item_id, text, {vec('text')} qv from benchmark),
sem as (select item_id, doc_id, window_no, case when len(v) = 0 or len(qv) = 0 then 0.0 else list_inner_product(v[1:least(len(v), len(qv))], qv[1:least(len(v), len(qv))]) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(qv, qv))) end score from (select doc_id, window_no, {vec('content')} v from seen), q),
rs as (select item_id, doc_id, window_no, row_number() over (partition by item_id order by score desc, doc_id, window_no) r from sem qualify r <= 30),
st as (select count(*) n, avg(len(ts)) avgdl from seen),
df as (select term, count(*) df from (select unnest(list_distinct(ts)) term from seen) group by term),
idf as (select term, ln(n - df + 0.5) - ln(df + 0.5) idf from df, st),
asked as (select item_id, term, count(*) weight from (select item_id, unnest({word('text')}) term from q) group by all),
w as (select item_id, term, weight * case when idf < 0 then 0.25 * (select avg(idf) from idf) else idf end w from idf join asked using (term)),
tf as (select doc_id, window_no, len(ts) dl, term, count(*) tf from (select doc_id, window_no, ts, unnest(ts) term from seen) group by all),
lex as (select item_id, doc_id, window_no, sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) score from tf join w using (term), st group by all),
rl as (select item_id, doc_id, window_no, row_number() over (partition by item_id order by score desc, doc_id, window_no) r from lex where score > 0 qualify r <= 30),
f as (select item_id, doc_id, window_no, min(sr) sr, min(lr) lr, sum(1.0::double / (60 + coalesce(sr, lr))) rrf from (select item_id, doc_id, window_no, r sr, null lr from rs union all select item_id, doc_id, window_no, null, r from rl) group by all)
select item_id, (row_number() over (partition by item_id order by rrf desc, sr nulls last, lr nulls last, doc_id, window_no))::int place, doc_id, window_no::int window_no, round(rrf, 8) rrf_score from f qualify place <= 5"""
    return sql(f"select * from (with {body})", "tokens")


@query(_many_oracle())
def hybrid_search_benchmark(spark, sf_dir):
    """Every benchmark text asked of all chunks that Internal may see, in one plan."""
    asked = V.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_no"), F.col("text").alias("question"))
    found = retrieval.search_many(V.index(spark, sf_dir), asked, "Internal")
    return found.select(F.col("question_no").alias("item_id"), "place", "doc_id", "window_no", F.round("rrf_score", 8).alias("rrf_score"))


ANN_K = 10


@query()
def ann_topk(spark, sf_dir):
    """Approximate cosine neighbours of every hundredth vector among all others, from the lists that the persisted index's measured recall needs."""
    asked = V.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 100 == 0)
    return ann_index.search(V.ann(spark, sf_dir), asked, ANN_K).withColumn("score", F.round("score", 5))


@query("select query_id, row_number() over (partition by query_id order by s desc, vec_id)::int rank, vec_id, round(s, 5) score from (select a.vec_id query_id, b.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 12) s from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0) qualify rank <= 10")
def ann_all_lists(spark, sf_dir):
    """The same from all lists: exact."""
    held = V.ann(spark, sf_dir)
    asked = V.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 100 == 0)
    return ann_index.search(held, asked, ANN_K, probes=len(held.centroids)).withColumn("score", F.round("score", 5))


#: Labelled questions: the expected name stands in a source of the first chunks found.
LABELLED = [(QUESTION, "src1"), ("license of the source", "src0"), ("et de la maison", "src7")]


def _labelled(spark):
    return spark.createDataFrame([(i, *x) for i, x in enumerate(LABELLED)], "question_no int, question string, expected string")


def _regression_oracle() -> str:
    parts, hits = [], []
    for i, (question, expected) in enumerate(LABELLED):
        tag = f"_q{i}"
        parts.append(ranking_ctes("true", question, tag) + ", " + _rank_lists(tag))
        top = f"select coalesce(a.doc_id, b.doc_id) doc_id, coalesce(a.window_no, b.window_no) window_no from rs{tag} a full join rl{tag} b on a.doc_id = b.doc_id and a.window_no = b.window_no order by coalesce(1.0::double / (60 + a.r), 0) + coalesce(1.0::double / (60 + b.r), 0) desc, a.r nulls last, b.r nulls last, 1, 2 limit 3"
        hits.append(f"select {i} question_no, coalesce(bool_or(contains(source, '{expected}')), false) hit from ({top}) x join tokens using (doc_id, window_no)")
    return sql(f"select * from (with {', '.join(parts)} {' union all '.join(hits)})", "tokens")


@query(_regression_oracle())
def retrieval_regression(spark, sf_dir):
    return retrieval.regression(V.index(spark, sf_dir), _labelled(spark), "source").select(F.col("question_no").cast("int").alias("question_no"), "hit")


@query(f"select 'retrieval_regression' metric, round(100.0 * count(*) filter (hit) / count(*), 1)::double score from ({_regression_oracle()})")
def retrieval_regression_score(spark, sf_dir):
    return retrieval.regression_score(retrieval.regression(V.index(spark, sf_dir), _labelled(spark), "source"))


_WORDLESS = "!!! ??? -- ..."


@query(sql(f"select doc_id, window_no::int window_no, round(1.0::double / (60 + r), 8) rrf_score, 'semantic_only' as mode from (with {ranking_ctes('true', _WORDLESS)}, {_rank_lists()} select * from rs) order by r limit 5", "tokens"))
def semantic_only(spark, sf_dir):
    """A question without words to look up: the lexical list is left out, and the mode says so."""
    return retrieval.hybrid_search(V.index(spark, sf_dir), _WORDLESS, "Restricted").select("doc_id", "window_no", F.round("rrf_score", 8).alias("rrf_score"), "mode")


# Access


_LEVELS = ["Public", "Internal", "Confidential", "Restricted"]


@query(sql(" union all ".join(f"select '{c}' clearance, coalesce(sensitivity, 'none') label, count(*) n, count(*) filter ({RANK.format('sensitivity')} <= {i}) n_allowed from governed group by sensitivity" for i, c in enumerate(_LEVELS)), "governed"))
def access_matrix(spark, sf_dir):
    docs = V.governed(spark, sf_dir)
    levels = F.explode(F.array(*map(F.lit, _LEVELS)))
    counts = docs.groupBy("sensitivity").agg(F.count("*").alias("n")).withColumn("clearance", levels)
    return counts.select("clearance", F.coalesce("sensitivity", F.lit("none")).alias("label"), "n", F.when(access.rank(F.col("sensitivity")) <= access.rank(F.col("clearance")), F.col("n")).otherwise(0).alias("n_allowed"))


@query(sql("select 'HR' member, count(*) filter (department is null or department in ('', 'General', 'HR')) visible from governed union all select 'Finance,IT', count(*) filter (department is null or department in ('', 'General', 'Finance', 'IT')) from governed union all select 'All', count(*) from governed", "governed"))
def department_visibility(spark, sf_dir):
    seen = lambda m, d: F.struct(F.lit(m).alias("member"), F.count_if(access.department_visible(F.col("department"), d)).alias("visible"))
    return V.governed(spark, sf_dir).agg(F.array(seen("HR", ["HR"]), seen("Finance,IT", access.parse_departments("Finance, IT")), seen("All", access.parse_departments("ALL"))).alias("r")).select(F.inline("r"))


@query(sql(f"select source, ['Public', 'Internal', 'Confidential', 'Restricted'][max({RANK.format('sensitivity')}) + 1] label from governed group by source", "governed"))
def max_sensitivity_per_source(spark, sf_dir):
    return V.governed(spark, sf_dir).groupBy("source").agg(access.max_sensitivity(F.col("sensitivity")).alias("label"))


# Validation and accuracy

_RULES = """select doc_id, case when classifier = 'llm_failed' or coalesce(department, '') = 'UNCLASSIFIED' then ['classification_failed'] else list_filter([
case when coalesce(department not in ('HR', 'Finance', 'Legal', 'IT', 'General'), true) then 'unknown_department' end,
case when coalesce(doc_type not in ('Policy', 'Invoice', 'Report', 'Contract', 'Data Table', 'Document', 'Email'), true) then 'unknown_doc_type' end,
case when coalesce(sensitivity not in ('Public', 'Internal', 'Confidential', 'Restricted'), true) then 'unknown_sensitivity' end,
case when coalesce(language not in ('EN', 'FR', 'AR'), true) then 'unexpected_language' end,
case when confidence is null then 'missing_confidence' end, case when confidence < 0.5 then 'low_confidence' end,
case when doc_type = 'Contract' and sensitivity in ('Public', 'Internal') then 'contract_under_classified' end], lambda x: x is not null) end rules from governed"""
_JUDGED = f"select doc_id, array_to_string(rules, ',') rules, len(rules) = 0 passed, len(list_filter(rules, lambda x: x not in ('unexpected_language', 'low_confidence'))) > 0 needs_review from ({_RULES})"


@query(sql(_JUDGED, "governed"))
def validate_rules(spark, sf_dir):
    out = validation.validate(V.governed(spark, sf_dir))
    return out.select("doc_id", F.array_join(F.transform("violations", lambda v: v["rule"]), ",").alias("rules"), "passed", "needs_review")


@query(sql(f"select count(*) total, count(*) filter (passed) passed, count(*) filter (needs_review) needs_review, round(count(*) filter (passed) / count(*)::double, 4) pass_rate from ({_JUDGED})", "governed"))
def validation_summary(spark, sf_dir):
    return validation.summary(validation.validate(V.governed(spark, sf_dir)))


@query(sql(" union all ".join(f"select '{c}' field, coalesce({c}, 'Unknown') label, count(*) n from governed group by {c}" for c in ("department", "doc_type", "sensitivity")), "governed"))
def label_histogram(spark, sf_dir):
    return validation.label_histogram(V.governed(spark, sf_dir), ["department", "doc_type", "sensitivity"])


_NORM = "lower(trim(coalesce({}, '')))"
_EQUAL = "(" + " or ".join([f"{_NORM.format('true_doc_type')} = {_NORM.format('doc_type')}", *[f"{_NORM.format('true_doc_type')} = '{k}' and {_NORM.format('doc_type')} in ({', '.join(repr(x) for x in v)})" for k, v in accuracy.EQUIVALENTS.items()]]) + ")"


def _accuracy_sql(equivalents: bool, present: bool) -> str:
    ok = lambda f: _EQUAL if equivalents and f == "doc_type" else f"{_NORM.format('true_' + f)} = {_NORM.format(f)}"
    return sql(" union all ".join(f"select '{f}' field, count(*) filter ({ok(f)}) n_correct, count(*) n_total, round(100.0 * count(*) filter ({ok(f)}) / count(*), 1)::double accuracy_pct from truth{f' where true_{f} is not null' if present else ''}" for f in accuracy.FIELDS), "truth")


@query(_accuracy_sql(False, False))
def accuracy_strict(spark, sf_dir):
    return accuracy.field_accuracy(V.truth(spark, sf_dir))


@query(_accuracy_sql(True, True))
def accuracy_equivalence(spark, sf_dir):
    return accuracy.field_accuracy(V.truth(spark, sf_dir), equivalents=True, only_present=True)


@query(sql("select count(*) n, count(*) filter (" + " and ".join(f"true_{f} is not distinct from {f}" for f in accuracy.FIELDS) + ") n_exact, round(avg(confidence), 4) avg_confidence, min(confidence) min_confidence, max(confidence) max_confidence from truth", "truth"))
def accuracy_exact(spark, sf_dir):
    return accuracy.exact_match(V.truth(spark, sf_dir))


def _fields_sql(table: str) -> str:
    same = lambda f: f"{_NORM.format('true_' + f)} = {_NORM.format(f)}"
    return " union all ".join(f"select '{f}' field, count(*) filter ({same(f)}) n_correct, count(*) n_total, round(100.0 * count(*) filter ({same(f)}) / count(*), 1)::double accuracy_pct from {table}" for f in accuracy.FIELDS)


@query(f"select sum(n_correct)::bigint n_correct, sum(n_total)::bigint n_total, round(100.0 * sum(n_correct) / sum(n_total), 1)::double accuracy_pct from ({_accuracy_sql(False, False)})")
def accuracy_overall(spark, sf_dir):
    return accuracy.overall(accuracy.field_accuracy(V.truth(spark, sf_dir)))


@query(sql(" union all ".join(f"select '{f}' field, count(*) filter (true_{f} is not distinct from {f}) n_correct, count(*) n_total, round(100.0 * count(*) filter (true_{f} is not distinct from {f}) / count(*), 1)::double accuracy_pct from truth" for f in accuracy.FIELDS), "truth"))
def accuracy_exact_fields(spark, sf_dir):
    return accuracy.field_accuracy(V.truth(spark, sf_dir), exact=True)


_STEM = "regexp_replace({}, '\\.[^.]*$', '')"
_GOLD = f"g as (select {_STEM.format('filename')} stem, * from gold where filename is not null qualify row_number() over (partition by filename order by line desc) = 1), p as (select {_STEM.format('filename')} stem, department, doc_type, language, sensitivity from truth where doc_id % 3 <> 0)"


def _predictions(spark, sf_dir):
    return V.truth(spark, sf_dir).filter("doc_id % 3 <> 0").select(files.stem(F.col("filename")).alias("stem"), *accuracy.FIELDS)


def _gold(spark, sf_dir):
    return accuracy.load_truth(V.gold(spark, sf_dir), "line")


@query(sql(f"select * from (with {_GOLD} select coalesce(g.stem, p.stem) stem, case when p.stem is null then 'missing_prediction' when g.stem is null then 'missing_truth' else 'matched' end status from g full join p on g.stem = p.stem)", "truth", "gold"))
def truth_join(spark, sf_dir):
    return joins.matched(_gold(spark, sf_dir), _predictions(spark, sf_dir), "stem", "prediction", "truth").select("stem", "status")


@query(sql(f"select * from (with {_GOLD}, j as (select p.*, g.true_department, g.true_doc_type, g.true_language, g.true_sensitivity from p join g using (stem) where stem not like '%topics%') {_fields_sql('j')})", "truth", "gold"))
def gold_accuracy(spark, sf_dir):
    """Predictions against the gold labels of selected stems only."""
    selected = V.truth(spark, sf_dir).select(files.stem(F.col("filename")).alias("stem")).filter(~F.col("stem").contains("topics"))
    return accuracy.field_accuracy(joins.selected(_predictions(spark, sf_dir), _gold(spark, sf_dir), "stem", selected))


@query(sql("select filename, case when filename like '%\\_topics\\_%.csv' escape '\\' then 'General' else true_department end true_department, 'Public' true_sensitivity, true_sensitivity is distinct from 'Public' changed_sensitivity, filename like '%\\_topics\\_%.csv' escape '\\' and true_department is distinct from 'General' changed_department from truth", "truth"))
def gold_correction(spark, sf_dir):
    return accuracy.corrected_truth(V.truth(spark, sf_dir)).select("filename", "true_department", "true_sensitivity", "changed_sensitivity", "changed_department")


@query()
def strong_sample(spark, sf_dir):
    rows = V.truth(spark, sf_dir).withColumn("is_ambiguous", F.col("doc_id") % 17 == 0).withColumn("is_duplicate_of", F.when(F.col("doc_id") % 19 == 0, "x"))
    return accuracy.strong_sample(rows)


# Registry


def _assets(spark, sf_dir):
    events = V.stage_events(spark, sf_dir)
    return registry.states(events).join(events.groupBy("document_id").agg(F.min("doc_id").alias("doc_id"), F.min("doc_type").alias("doc_type"), F.max("department").alias("department")), "document_id")


@query(sql("select document_id, status, n_events from assets", "assets"))
def registry_state_fold(spark, sf_dir):
    return registry.states(V.stage_events(spark, sf_dir)).select("document_id", "status", "n_events")


@query(sql("select document_id, status, n_events, epoch(to_timestamp(ingested_at))::bigint ingested_at, coalesce(epoch(to_timestamp(classified_at))::bigint, 0) classified_at from assets", "assets"))
def registry_snapshot(spark, sf_dir):
    """States from a log of three batches, of which two are folded in a snapshot and the third, with late events, is read beside it."""
    events, part = V.stage_events(spark, sf_dir), F.pmod(F.xxhash64("document_id", "stage", "at"), F.lit(3))
    path = f"{shared_dir(spark)}/registry/{uuid.uuid4().hex}"
    for n in range(3):
        registry.save(events.filter(part == n), path)
        if n == 1:
            registry.snapshot(spark, path)
    return registry.load(spark, path).select("document_id", "status", "n_events", F.unix_timestamp("ingested_at").alias("ingested_at"), F.coalesce(F.unix_timestamp("classified_at"), F.lit(0)).alias("classified_at"))


@query("select 'f' || doc_id || '.json' file, case doc_id % 8 when 1 then 'malformed' when 2 then 'empty' when 3 then 'not an object' when 4 then 'wrong type: n_chars' when 5 then 'missing: lang' when 7 then 'empty' end reason, case when doc_id % 8 in (0, 6) then lang end lang, case when doc_id % 8 in (0, 6) then n_chars else 0 end n_chars from documents")
def json_quarantine(spark, sf_dir):
    """Documents as JSON files of changing shape: cut short, empty, of another shape, with a field of the wrong type, lacking one, with more than is asked for. Every file is either read or listed with its reason."""
    k, said = F.col("doc_id") % 8, F.to_json(F.struct("doc_id", "lang", "n_chars", "text"))
    body = F.when(k == 1, F.left(said, F.length(said) - 5)).when(k == 2, " \n").when(k == 3, F.concat(F.lit("["), said, F.lit("]"))).when(k == 4, F.to_json(F.struct("doc_id", "lang", F.lit("many").alias("n_chars")))).when(k == 5, F.to_json(F.struct("doc_id", "n_chars"))).when(k != 7, said)
    read, bad = files.json_documents(V.table(spark, sf_dir, "documents").select(F.format_string("f%d.json", "doc_id").alias("file"), body.alias("body")), "doc_id long, lang string, n_chars long", ["lang"])
    return read.select("file", F.lit(None).cast("string").alias("reason"), "lang", "n_chars").unionByName(bad.select("file", "reason", F.lit(None).cast("string").alias("lang"), F.lit(0).cast("long").alias("n_chars")))


@query(sql("select count(*) total_documents, count(*) filter (status = 'ingested') ingested, count(*) filter (status = 'classified') classified, count(*) filter (status = 'chunked') chunked, count(*) filter (status = 'indexed') indexed, sum(coalesce(n, 0))::bigint total_chunks, sum(case when status = 'indexed' then coalesce(n, 0) else 0 end)::bigint chunks_indexed from assets left join (select doc_id, count(*) n from chunks group by doc_id) using (doc_id)", "assets", "chunks"))
def registry_summary(spark, sf_dir):
    return registry.summary(registry.with_chunk_counts(_assets(spark, sf_dir), V.chunks(spark, sf_dir), "doc_id"))


@query(sql("select chunk_id, status, department from chunks join (select doc_id, status from assets) using (doc_id)", "assets", "chunks"))
def chunk_registry_join(spark, sf_dir):
    return V.chunks(spark, sf_dir).select("doc_id", "chunk_id", "department").join(_assets(spark, sf_dir).select("doc_id", "status"), "doc_id").select("chunk_id", "status", "department")


@query(sql("select document_id, status, department from assets where status = 'indexed' and department = 'HR'", "assets"))
def registry_lookup(spark, sf_dir):
    return registry.lookup(_assets(spark, sf_dir), status="indexed", department="HR").select("document_id", "status", "department")


@query(sql("select document_id, status from assets where chunked_at > classified_at", "assets"))
def compliance_reindexed(spark, sf_dir):
    return registry.reindexed_after_classification(registry.states(V.stage_events(spark, sf_dir))).select("document_id", "status")


@query(sql("select doc_type, count(*) n, round(avg(classified_at - ingested_at), 3) classify_s, round(avg(chunked_at - classified_at), 3) chunk_s from assets group by doc_type", "assets"))
def stage_durations(spark, sf_dir):
    return registry.stage_durations(_assets(spark, sf_dir), "doc_type")


# Index upkeep


@query("select doc_id, sha256(text) file_hash from documents where sha256(text) not in (select sha256(text) from documents where doc_id % 3 = 0 and doc_id % 9 <> 0)")
def manifest_antijoin(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    manifest = docs.filter("doc_id % 3 = 0").select("file_hash", F.when(F.col("doc_id") % 9 == 0, "error").otherwise("new").alias("status"))
    return index.new_files(docs, manifest).select("doc_id", "file_hash")


@query("with h as (select doc_id, doc_id % 50 path, sha256(text) file_hash from documents), m as (select path, file_hash, case when doc_id % 9 = 0 then 'error' else 'new' end status from h where doc_id % 3 = 0) select case when file_hash in (select file_hash from m where status <> 'error') then 'unchanged' when path in (select path from m) then 'updated' else 'new' end status, count(*) n from h group by all")
def ingest_counts(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 50).alias("source_path"), F.sha2("text", 256).alias("file_hash"))
    manifest = docs.filter("doc_id % 3 = 0").select("source_path", "file_hash", F.when(F.col("doc_id") % 9 == 0, "error").otherwise("new").alias("status"))
    return index.ingest_status(docs, manifest).groupBy("status").agg(F.count("*").alias("n"))


def _versions(spark, sf_dir):
    """Chunks as indexed before (texts of every tenth document cut, its later chunks kept) and as they come now (first chunks of every seventh document gone)."""
    chunks = V.chunks(spark, sf_dir).select("doc_id", "document_id", "chunk_id", "chunk_number", "content")
    existing = chunks.withColumn("content", F.when(F.col("doc_id") % 10 == 0, F.substring("content", 1, 50)).otherwise(F.col("content")))
    return existing, chunks.filter((F.col("doc_id") % 2 == 0) & ~((F.col("doc_id") % 7 == 0) & (F.col("chunk_number") == 1)))


_OLD = "existing as (select doc_id, document_id, chunk_id, chunk_number, case when doc_id % 10 = 0 then substr(content, 1, 50) else content end content from chunks), incoming as (select doc_id, document_id, chunk_id, chunk_number, content from chunks where doc_id % 2 = 0 and not (doc_id % 7 = 0 and chunk_number = 1))"


@query(sql(f"select * from (with {_OLD} select chunk_id, sha256(content) h from incoming union all select chunk_id, sha256(content) from existing where chunk_id not in (select chunk_id from incoming))", "chunks"))
def upsert_chunks(spark, sf_dir):
    existing, incoming = _versions(spark, sf_dir)
    return index.upsert(existing, incoming).select("chunk_id", F.sha2("content", 256).alias("h"))


@query(sql(f"select * from (with {_OLD} select chunk_id from existing where document_id not in (select document_id from incoming) or chunk_id in (select chunk_id from incoming))", "chunks"))
def stale_chunk_delete(spark, sf_dir):
    existing, incoming = _versions(spark, sf_dir)
    return index.delete_stale(existing, incoming).select("chunk_id")


@query(sql(f"select * from (with {_OLD} select case when sha256(e.content) is not distinct from sha256(i.content) then 'reused' else 'hash_fallback' end embedding_source, count(*) n from chunks i left join existing e using (chunk_id) group by all)", "chunks"))
def embedding_reuse(spark, sf_dir):
    ship(spark)
    existing, _ = _versions(spark, sf_dir)
    incoming = V.chunks(spark, sf_dir).select("chunk_id", "content")
    cache = existing.select("chunk_id", F.sha2("content", 256).alias("content_hash"), T.hash_vectors(F.col("content")).alias("embedding"))
    return index.reuse_embeddings(incoming.withColumn("content_hash", F.sha2("content", 256)), cache).groupBy("embedding_source").agg(F.count("*").alias("n"))


@query(sql("select coalesce(department, 'General') department, 'rag_chunks_' || lower(coalesce(department, 'General')) table_name, count(*) chunk_count from chunks where coalesce(department, 'General') in ('HR', 'Finance', 'Legal', 'IT', 'General') group by all", "chunks"))
def department_manifest(spark, sf_dir):
    return index.department_manifest(V.chunks(spark, sf_dir))


@query(sql("select department, count(*) n from chunks where coalesce(department, 'General') not in ('HR', 'Finance', 'Legal', 'IT', 'General') group by all", "chunks"))
def unknown_departments(spark, sf_dir):
    return index.unknown_departments(V.chunks(spark, sf_dir))


@query(sql("select string_agg(distinct department, ',' order by department) departments_seen, string_agg(distinct department, ',' order by department) filter (department not in ('HR', 'Finance', 'Legal', 'IT', 'General')) unknown_departments from chunks where department <> ''", "chunks"))
def departments_seen(spark, sf_dir):
    return index.departments_seen(V.chunks(spark, sf_dir))


@query(sql("select stem, title, origin from (select 'doc_' || doc_id stem from governed) left join (select 'doc_' || doc_id stem, 'Title ' || doc_id title, source origin from documents where doc_id % 5 <> 0) using (stem)", "governed"))
def metadata_join(spark, sf_dir):
    """Markdown files with their stage-1 metadata, which may be missing."""
    return V.classified(spark, sf_dir).select("stem").join(V.metadata(spark, sf_dir), "stem", "left")


@query("select 'doc_' || doc_id stem, case when doc_id % 7 = 0 then 'missing_markdown' else 'matched' end status from documents")
def classified_join(spark, sf_dir):
    """Classified files with their Markdown; those without it are skipped and told."""
    markdown = V.markdown(spark, sf_dir).filter("doc_id % 7 <> 0").select(F.format_string("doc_%d", "doc_id").alias("stem"), "text")
    return joins.matched(V.classified(spark, sf_dir).select("stem", "doc_type"), markdown, "stem", "markdown", "classification").select("stem", "status")


@query(sql(f"select count(*) total_classified, count(*) filter (classifier = 'llm_failed') failed, count(*) filter (doc_id % 13 = 0 and doc_id % 2 = 0) access_denied, count(*) filter (needs_review) needs_review from governed join (select doc_id, needs_review from ({_JUDGED})) using (doc_id)", "governed"))
def classification_summary(spark, sf_dir):
    return validation.run_summary(validation.validate(V.classified(spark, sf_dir)))


@query(sql("select count(*) total_chunks, count(distinct document_id) total_documents, (select count(*) from documents) documents_processed, 512 chunk_size, 100 as overlap from chunks", "chunks"))
def chunking_summary(spark, sf_dir):
    return chunking.summary(V.chunks(spark, sf_dir), V.governed(spark, sf_dir))


@query(sql(f"select * from (select row_number() over (order by doc_id)::int place, doc_id || ': ' || rules line from ({_JUDGED}) where needs_review) where place <= 5 union all select 6, '... and ' || (count(*) - 5) || ' more' from ({_JUDGED}) where needs_review having count(*) > 5", "governed"))
def first_errors(spark, sf_dir):
    judged = validation.validate(V.governed(spark, sf_dir)).filter("needs_review")
    return validation.first_rows(judged.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(": "), F.array_join(F.transform("violations", lambda v: v["rule"]), ",")).alias("line")), "doc_id", "line").drop("doc_id")


@query("select doc_id, json_extract_string(m, '$.filename') filename, json_extract_string(m, '$.size')::bigint size from (select doc_id, to_json({'filename': 'doc_' || doc_id || '.txt', 'size': length(text)}) m from documents)")
def metadata_json(spark, sf_dir):
    """Metadata written as JSON and read back with a schema."""
    packed = V.table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct(F.format_string("doc_%d.txt", "doc_id").alias("filename"), F.length("text").alias("size"))).alias("m"))
    return packed.select("doc_id", F.from_json("m", "filename string, size long").alias("m")).select("doc_id", "m.filename", "m.size")


# Quality

_HEALTH = f"select *, len({WORDS('content')}) nw, lower(array_to_string({WORDS('content')}, ' ')) k from windowed"
_HEALTHY = f"(select *, nw >= 5 and row_number() over (partition by nw >= 5, k order by doc_id, window_no) = 1 healthy from ({_HEALTH}))"
_SCORES = f"""select unnest(['embedding_coverage', 'sensitivity_label_validity', 'department_coverage', 'chunk_health']) metric, unnest([round(100.0 * count(*) filter (doc_id % 4 = 0) / nullif(count(*) filter (doc_id % 4 < 3), 0), 1),
round(100.0 * count(*) filter (sensitivity in ('Public', 'Internal', 'Confidential', 'Restricted')) / count(*), 1), round(100.0 * count(*) filter (department is not null and department not in ('', 'General')) / count(*), 1), round(100.0 * count(*) filter (healthy) / count(*), 1)])::double score from {_HEALTHY}"""


def _scored(spark, sf_dir):
    rows = chunking.windowed(V.governed(spark, sf_dir))
    source = F.when(F.col("doc_id") % 4 == 0, "llm").when(F.col("doc_id") % 4 < 3, "hash_fallback").otherwise("reused")
    return quality_report.scores(rows.withColumn("embedding_source", source))


@query(sql(_SCORES, "windowed"))
def quality_scores(spark, sf_dir):
    return _scored(spark, sf_dir)


@query(sql("select 'index_found' metric, null::double score, count(*) n_chunks, count(distinct department) n_departments from chunks union all select 'index_found', 0.0, 0, 0", "chunks"))
def index_found(spark, sf_dir):
    """The metric for the index of the chunks, which is there and doesn't count, and for one that was never written."""
    held = V.index(spark, sf_dir)
    there = search_index.found_score(spark, held.name.split("@")[0])
    missing = search_index.found_score(spark, f"{held.name.split('@')[0]}/none")
    scored = lambda v: [F.lit("index_found").alias("metric"), F.lit(v).cast("double").alias("score")]
    row = held.chunks.agg(F.count("*").alias("n_chunks"), F.countDistinct("department").alias("n_departments")).select(*scored(there), "n_chunks", "n_departments")
    none = held.chunks.limit(0).agg(F.count("*").alias("n_chunks"), F.countDistinct("department").alias("n_departments")).select(*scored(missing), "n_chunks", "n_departments")
    return row.unionByName(none)


@query(sql(f"select round(avg(score), 1) overall_score, count(score) n_scored from ({_SCORES})", "windowed"))
def quality_overall(spark, sf_dir):
    return quality_report.overall(_scored(spark, sf_dir))


@query(
    sql(
        "select run, metric, score, previous, round(score - previous, 3) delta, case when place = 1 then 'no_baseline' when round(score - previous, 6) < -5 then 'drift' else 'stable' end status from (select *, lag(score) over (partition by metric order by run) previous, row_number() over (partition by metric order by run) place from history) where place = 1 or (score is not null and previous is not null)",
        "history",
    )
)
def drift_history(spark, sf_dir):
    return quality_report.drift(V.history(spark, sf_dir))


@query(sql("select metric, max(run) run, arg_max(score, run) score from history group by metric", "history"))
def latest_report(spark, sf_dir):
    return quality_report.latest(V.history(spark, sf_dir))


@query(sql("select run, metric, score, row_number() over (partition by metric order by run)::int place from history where score is not null", "history"))
def score_trend(spark, sf_dir):
    return quality_report.trend(V.history(spark, sf_dir))


@query("select event_id, case when event_id % 3 = 0 then 'unknown' when event_id % 3 = 1 then 'not a time' else strftime(ts, '%b %d, %Y · %H:%M UTC') end said from events")
def time_labels(spark, sf_dir):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, "").when(k == 1, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return V.table(spark, sf_dir, "events").select("event_id", dialogue.time_label(raw).alias("said"))


@query(sql("select run, metric, case when score is null then 'muted' when score >= 85 then 'good' when score >= 65 then 'warn' else 'bad' end band from history", "history"))
def score_bands(spark, sf_dir):
    return V.history(spark, sf_dir).select("run", "metric", dialogue.band(F.col("score")).alias("band"))


# Conversations


@query(sql(f"select conv_id, turn from turns where {RANK.format('sensitivity_level')} <= 1", "turns"))
def history_visible(spark, sf_dir):
    return session.visible_turns(V.turns(spark, sf_dir), "Internal").select("conv_id", "turn")


@query("select conv_id, turn from conversations qualify row_number() over (partition by conv_id order by turn desc) <= 5")
def history_last_n(spark, sf_dir):
    return session.last_turns(V.table(spark, sf_dir, "conversations")).select("conv_id", "turn")


@query("select conv_id, coalesce(string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) order by turn) filter (trim(text) <> ''), '') history from (select * from conversations qualify row_number() over (partition by conv_id order by turn desc) <= 3) group by conv_id")
def history_format(spark, sf_dir):
    return session.history_text(V.table(spark, sf_dir, "conversations"))


_SMALL = ", ".join("'" + w.replace("'", "''") + "'" for w in dialogue.SMALLTALK)
_SAID = "(select conv_id, turn, case when (conv_id + turn) % 3 = 0 then 'Hello!?' when (conv_id + turn) % 3 = 1 then ' hi !' else text end t from conversations)"


def _said(spark, sf_dir):
    k = (F.col("conv_id") + F.col("turn")) % 3
    return V.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(k == 0, "Hello!?").when(k == 1, " hi !").otherwise(F.col("text")).alias("t"))


@query(f"select conv_id, turn, regexp_replace(lower(regexp_replace(t, '^{WS}|{WS}$', '', 'g')), '[!.?،؟]+$', '') in ({_SMALL}) smalltalk from {_SAID}")
def smalltalk_exact(spark, sf_dir):
    return _said(spark, sf_dir).select("conv_id", "turn", dialogue.is_smalltalk(F.col("t")).alias("smalltalk"))


@query()
def smalltalk_fuzzy(spark, sf_dir):
    ship(spark)
    k = (F.col("conv_id") + F.col("turn")) % 4
    said = F.when(k == 0, "Helo!").when(k == 1, "bonjuor mon ami").when(k == 2, "thansk for the long answer").otherwise(F.col("text"))
    return V.table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("said"), dialogue.is_near_smalltalk(said).alias("smalltalk"))


@query(f"select doc_id, case when doc_id % 19 = 0 then 'detector_unavailable' when length(regexp_replace(text, '^{WS}|{WS}$', '', 'g')) < 12 then 'too_short' when doc_id % 17 = 0 then 'detection_failed' when lang in ('en', 'fr', 'ar') then 'detected' else 'outside_expected_languages' end status from documents")
def language_status(spark, sf_dir):
    detected = F.when(F.col("doc_id") % 17 != 0, F.col("lang"))
    return V.table(spark, sf_dir, "documents").select("doc_id", dialogue.language_status(F.col("text"), detected, F.col("doc_id") % 19 != 0).alias("status"))


_SMALL_FORM = f"regexp_replace(lower(regexp_replace(t, '^{WS}|{WS}$', '', 'g')), '[!.?،؟]+$', '')"


@query(f"select conv_id, turn, case when {_SMALL_FORM} in ({_SMALL}) then 'smalltalk' when turn = 0 then 'no_history' when conv_id % 7 = 0 then 'unavailable' when conv_id % 7 = 1 then 'error' when conv_id % 7 = 2 then 'unparseable' when conv_id % 7 = 3 then 'unnecessary' else 'rewritten' end status from {_SAID}")
def rewrite_status(spark, sf_dir):
    """What becomes of each turn for answers that a model might give: none, an error, a blank, the question itself, another question."""
    k, t = F.col("conv_id") % 7, F.col("t")
    answer = F.when(k == 2, ' "" ').when(k == 3, F.concat(F.lit('" '), t, F.lit('"'))).when(k > 3, F.concat(t, F.lit(" in full")))
    return _said(spark, sf_dir).select("conv_id", "turn", dialogue.rewrite_status(t, F.col("turn"), k != 0, answer, k == 1).alias("status"))


_JUDGE = "case doc_id % 6 when 3 then 'no json' when 4 then '{\"score\": \"high\"}' else '{\"score\": 1.5}' end"


@query("select doc_id, case when doc_id % 6 = 0 then 'no_context' when trim(text) = '' then 'judged' when doc_id % 6 = 1 then 'unavailable' when doc_id % 6 = 2 then 'error' when doc_id % 6 in (3, 4) then 'unparseable' else 'judged' end status, case when doc_id % 6 = 0 then null when trim(text) = '' or doc_id % 6 = 5 then 1.0::double end score from documents")
def judge_status(spark, sf_dir):
    """Statuses and scores of faithfulness checks for answers that a judge might give."""
    k = F.col("doc_id") % 6
    raw = F.when(k == 3, "no json").when(k == 4, '{"score": "high"}').otherwise('{"score": 1.5}')
    told = dialogue.judge(F.col("text"), F.when(k != 0, "some context"), k != 1, raw, k == 2)
    return V.table(spark, sf_dir, "documents").select("doc_id", told.alias("j")).select("doc_id", "j.status", "j.score")


_MESSAGE = "case doc_id % 4 when 0 then 'HTTP 429 ' || lang when 1 then 'Invalid API key for ' || source when 2 then 'Rate Limit, 403' else text end"


def _message():
    k = F.col("doc_id") % 4
    return F.when(k == 0, F.concat(F.lit("HTTP 429 "), F.col("lang"))).when(k == 1, F.concat(F.lit("Invalid API key for "), F.col("source"))).when(k == 2, "Rate Limit, 403").otherwise(F.col("text"))


_ANY = lambda words: "(" + " or ".join(f"contains(lower(m), '{w}')" for w in words) + ")"


@query(f"select doc_id, {_ANY(dialogue.RATE_LIMIT)} rate_limited, {_ANY(dialogue.ACCESS_DENIED)} access_denied from (select doc_id, {_MESSAGE} m from documents)")
def error_signals(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", dialogue.contains_any(_message(), dialogue.RATE_LIMIT).alias("rate_limited"), dialogue.contains_any(_message(), dialogue.ACCESS_DENIED).alias("access_denied"))


_ANSWER = "case doc_id % 3 when 0 then '```json' || chr(10) || '{\"score\": ' || (doc_id % 30) / 20.0 || '}' || chr(10) || '```' when 1 then 'Sure: {\"score\": 0.25} done' else 'no json' end"


@query(f"select doc_id, case when s is not null then greatest(0, least(1, s)) end score from (select doc_id, json_extract_string(nullif(regexp_extract(m, '(?s)(\\{{.*\\}})', 1), ''), '$.score')::double s from (select doc_id, {_ANSWER} m from documents))")
def json_extract(spark, sf_dir):
    k = F.col("doc_id") % 3
    m = F.when(k == 0, F.concat(F.lit('```json\n{"score": '), ((F.col("doc_id") % 30) / 20.0).cast("string"), F.lit("}\n```"))).when(k == 1, 'Sure: {"score": 0.25} done').otherwise("no json")
    part = F.from_json(F.nullif(dialogue.json_part(m), F.lit("")), "score double")["score"]
    return V.table(spark, sf_dir, "documents").select("doc_id", F.when(part.isNotNull(), dialogue.clamp(part)).alias("score"))


@query("select item_id, array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+'), ' | ') tsquery from benchmark")
def tsquery_or(spark, sf_dir):
    return V.table(spark, sf_dir, "benchmark").select("item_id", F.array_join(T.tokens(F.col("text")), " | ").alias("tsquery"))


@query(f"select doc_id, case when length(f) > 100 then substr(f, 1, 100) || '...' else f end preview from (select doc_id, replace(regexp_replace(text, '^{WS}|{WS}$', '', 'g'), chr(10), ' ') f from documents)")
def result_preview(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", dialogue.preview(F.col("text")).alias("preview"))


@query(sql("select source, 'Based on the retrieved context, the answer appears to be: ' || string_agg(substr(content, 1, 400), ' ' order by doc_id, window_no) answer from (select source, doc_id, window_no, content from chunks qualify row_number() over (partition by source order by doc_id, window_no) <= 5) group by source", "chunks"))
def fallback_answer(spark, sf_dir):
    from pyspark.sql import Window

    rows = V.chunks(spark, sf_dir)
    top = rows.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("doc_id", "window_no"))).filter("r <= 5")
    return retrieval.fallback_answer(top, ["doc_id", "window_no"], ["source"])


_FOUND = _hybrid_oracle(1)


_SAID = f"'Based on the retrieved context, the answer appears to be: ' || string_agg(substr(content, 1, 400), ' ' order by doc_id, window_no)"


@query(f"select count(*) chunk_count, round(sum(rrf_score) / greatest(1, count(*)), 6) mean_score, len({WORDS(_SAID)})::int answer_words, 'ok' status from ({_FOUND}) join ({sql('select doc_id, window_no, content from chunks', 'chunks')}) using (doc_id, window_no)")
def retrieval_eval(spark, sf_dir):
    found = retrieval.hybrid_search(V.index(spark, sf_dir), QUESTION, "Internal")
    return retrieval.evaluate(found, retrieval.fallback_text(["doc_id", "window_no"]))


@query(sql("select source, string_agg('Chunk ' || r || ': ' || content, chr(10) || chr(10) order by r) context from (select source, content, row_number() over (partition by source order by doc_id, window_no) r from chunks qualify r <= 3) group by source", "chunks"))
def prompt_context(spark, sf_dir):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id", "window_no"))
    return retrieval.context(V.chunks(spark, sf_dir).withColumn("r", place).filter("r <= 3"), ["doc_id", "window_no"], ["source"])


# Sources and streams


@query()
def html_to_markdown(spark, sf_dir):
    return files.html_markdown(V.table(spark, sf_dir, "pages"))


@query("select n_nationkey, '| ' || n_nationkey || ' | ' || n_name || ' | ' || n_regionkey || ' |' line from nation")
def csv_markdown(spark, sf_dir):
    rows = V.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return files.csv_table(rows).select("n_nationkey", "line")


@query("select epoch(date_trunc('hour', ts))::bigint as start, event_type, count(*) n, round(sum(value), 2) total from events group by all")
def event_windows(spark, sf_dir):
    return ingest.event_counts(V.table(spark, sf_dir, "events")).select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))
