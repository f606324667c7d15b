"""Views over the given tables that the registered queries share, as DataFrames and as DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.operators import ann_index, search_index
from quillstone.operators.chunking import chunks as make_chunks
from quillstone.session import shared_dir

DEPARTMENT = ["HR", "Finance", "Legal", "IT", "General", None, "Marketing"]
SENSITIVITY = ["Public", "Internal", "Confidential", "Restricted", None, "TopSecret"]
DOC_TYPE = ["Policy", "Invoice", "Report", "Contract", "Data Table", "Document", "Email", "Memo"]
TRUE_DEPARTMENT = ["HR", "finance", "Legal", "IT", "General", "HR", "General"]
TRUE_TYPE = ["Policy", "invoice", "article", "Contract", "datasheet", "reference", "memo", "Memo"]
TRUE_SENSITIVITY = ["Public", "internal", "Confidential", "Restricted", "Public", None]
QUESTION = "the privacy and license privacy"


def pick(values: list[str | None], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), (number % len(values)).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def governed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with labels that follow from doc_id, null and unknown ones among them."""
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source",
        pick(DEPARTMENT, i).alias("department"), pick(SENSITIVITY, i).alias("sensitivity"), pick(DOC_TYPE, i).alias("doc_type"), F.upper("lang").alias("language"),
        F.when(i % 11 != 0, (i * 37 % 101) / F.lit(100.0)).alias("confidence"), F.when(i % 13 == 0, "llm_failed").otherwise("litellm").alias("classifier"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_chunks(governed(spark, sf_dir))


_INDEXES: dict[tuple[str, str, str], str] = {}
INDEXED = ["doc_id", "window_no", "chunk_id", "source", "department", "sensitivity", "content"]


def _kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> search_index.SearchIndex:
    """An index that the session's first question writes into the shared folder and all later ones read."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _INDEXES or not search_index.exists(spark, _INDEXES[at]):
        path = f"{shared_dir(spark)}/search-index/{uuid.uuid4().hex}"
        build(path)
        _INDEXES[at] = path
    return search_index.load(spark, _INDEXES[at])


def index(spark: SparkSession, sf_dir: str) -> search_index.SearchIndex:
    """The search index of all chunks."""
    return _kept(spark, sf_dir, "all", lambda path: search_index.build(chunks(spark, sf_dir).select(*INDEXED), path))


def grown_index(spark: SparkSession, sf_dir: str) -> search_index.SearchIndex:
    """A search index after several runs: every tenth document came shortened and with a window too many and was mended later, others came late, every ninth was deleted, and half of these came back; the small segments are merged."""

    def build(path: str) -> None:
        chunks(spark, sf_dir).select(*INDEXED).write.parquet(f"{path}/given")  # all runs read these
        rows, i = spark.read.parquet(f"{path}/given"), F.col("doc_id")
        short = rows.filter(i % 10 == 0).withColumn("content", F.substring("content", 1, 200))
        stale = short.withColumn("window_no", F.col("window_no") + 1000)
        search_index.build(rows.filter(~(i % 10).isin(0, 3)).unionByName(short).unionByName(stale), path)
        search_index.update(rows.filter((i % 10).isin(0, 3)), path)
        search_index.update(rows.limit(0), path, gone=table(spark, sf_dir, "documents").filter(i % 9 == 0))
        search_index.update(rows.filter((i % 9 == 0) & (i % 2 == 0)), path)
        search_index.merge(spark, path, below=rows.count() // 2)

    return _kept(spark, sf_dir, "grown", build)


def ann(spark: SparkSession, sf_dir: str) -> ann_index.AnnIndex:
    """The inverted lists of the embeddings, kept like the search index."""
    at = (spark.sparkContext.applicationId, sf_dir, "ann")
    path = _INDEXES.setdefault(at, f"{shared_dir(spark)}/ann-index/{uuid.uuid4().hex}")
    return ann_index.kept(spark, path, lambda: table(spark, sf_dir, "embeddings"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """governed labels beside ground truth under file names."""
    i = F.col("doc_id")
    name = F.when(i % 10 < 3, F.format_string("doc_%d_hr_topics_en.csv", i)).otherwise(F.format_string("doc_%d.txt", i))
    return governed(spark, sf_dir).drop("text").select(
        "*", name.alias("filename"), pick(TRUE_DEPARTMENT, i).alias("true_department"), pick(TRUE_TYPE, i).alias("true_doc_type"), F.when(i % 9 == 0, " en ").otherwise(F.upper("lang")).alias("true_language"), pick(TRUE_SENSITIVITY, i).alias("true_sensitivity"),
    )


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry events of the documents: all are ingested, fewer reach each later stage, and some are classified anew after chunking."""
    i = F.col("doc_id")
    at = lambda s: F.timestamp_seconds(F.lit(1_767_225_600) + i * 60 + s)
    steps = F.array(
        F.struct(F.lit("ingested").alias("stage"), at(0).alias("at")),
        F.struct(F.when(i % 4 >= 1, "classified").alias("stage"), at(F.lit(5) + i % 7).alias("at")),
        F.struct(F.when(i % 4 >= 2, "chunked").alias("stage"), at(F.lit(20) + i % 3).alias("at")),
        F.struct(F.when(i % 4 == 3, "indexed").alias("stage"), at(30).alias("at")),
        F.struct(F.when((i % 4 >= 2) & (i % 5 == 0), "classified").alias("stage"), at(40).alias("at")),
    )
    return governed(spark, sf_dir).select(T.document_id(F.sha2(F.concat(F.lit("d"), i.cast("string")), 256)).alias("document_id"), "doc_id", "doc_type", "department", F.inline(steps)).filter("stage is not null")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of six runs for each language."""
    run = F.col("doc_id") % 6 + 1
    rows = table(spark, sf_dir, "documents").groupBy(run.alias("run"), F.col("lang").alias("metric")).agg(F.round(100.0 * F.count_if((F.col("doc_id") * 7) % 13 > 2 + run) / F.count("*"), 1).alias("s"))
    return rows.select("run", "metric", F.when((F.col("run") == 3) & (F.col("metric") == "es"), None).otherwise(F.col("s")).alias("score"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files' metadata from the ingest and from the classifier: every fifth file lacks the former; a failed model may have been denied."""
    i = F.col("doc_id")
    denied = (i % 13 == 0) & (i % 2 == 0)
    return governed(spark, sf_dir).select("*", F.format_string("doc_%d", i).alias("stem"), denied.alias("access_denied"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage-1 metadata by stem, for four of five files."""
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").filter(i % 5 != 0).select(F.format_string("doc_%d", i).alias("stem"), F.concat(F.lit("Title "), i.cast("string")).alias("title"), F.col("source").alias("origin"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth lines (line, filename, true labels): three of four documents, some files without a document, some lines without a name, every ninth file named twice."""
    i = F.col("doc_id")
    lines = F.array(F.struct(F.lit(0).alias("again"), F.pmod(i, F.lit(6)).alias("k")), F.struct(F.when(i % 9 == 0, 1).alias("again"), F.pmod(i + 1, F.lit(6)).alias("k")))
    rows = truth(spark, sf_dir).filter(i % 4 != 0).select("doc_id", "filename", "true_department", "true_doc_type", "true_language", F.inline(lines)).filter("again is not null")
    name = F.when(i % 11 == 0, F.format_string("lost_%d.txt", i)).when(i % 23 != 0, F.col("filename"))
    return rows.select((i * 2 + F.col("again")).alias("line"), name.alias("filename"), "true_department", "true_doc_type", "true_language", pick(TRUE_SENSITIVITY, F.col("k")).alias("true_sensitivity"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").withColumn("sensitivity_level", pick(SENSITIVITY, F.col("conv_id") + F.col("turn")))


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as Markdown with a preamble, headings, boilerplate lines and runs of blank lines."""
    head = F.concat(F.lit("Opening words\nPage 3 of 9\n# Document "), F.col("doc_id").cast("string"), F.lit("\nDRAFT\n-----\n"))
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("  \n\n\n## Part\nCompany Name: x\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(head, body).alias("text"))


def _list(values: list[str | None], number: str) -> str:
    return "[" + ", ".join("null" if v is None else f"'{v}'" for v in values) + f"][cast({number} % {len(values)} as int) + 1]"


WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def WORDS(column: str) -> str:  # noqa: N802
    """The column's words in SQL."""
    return f"list_filter(string_split_regex({column}, '{WS}'), lambda x: x <> '')"



RANK = "case {} when 'Public' then 0 when 'Internal' then 1 when 'Confidential' then 2 else 3 end"
#: Common table expressions with what they need.
CTES: dict[str, tuple[str, list[str]]] = {
    "governed": (
        f"select doc_id, text, lang, source, {_list(DEPARTMENT, 'doc_id')} department, {_list(SENSITIVITY, 'doc_id')} sensitivity, {_list(DOC_TYPE, 'doc_id')} doc_type, upper(lang) as language, case when doc_id % 11 <> 0 then (doc_id * 37 % 101) / 100.0::double end confidence, case when doc_id % 13 = 0 then 'llm_failed' else 'litellm' end classifier from documents",
        [],
    ),
    "windowed": (
        f"select doc_id, source, department, sensitivity, doc_type, 'doc_' || substr(sha256(text), 1, 16) document_id, s // 412 window_no, array_to_string(list_slice(w, s + 1, s + 512), ' ') content from (select *, unnest(range(0, greatest(len(w), 1), 412)) s from (select *, {WORDS('text')} w from governed))",
        ["governed"],
    ),
    "chunks": (
        f"select *, document_id || '_c' || case when chunk_number < 10000 then lpad(chunk_number::varchar, 4, '0') else chunk_number::varchar end chunk_id, cast(len({WORDS('content')}) as int) chunk_size from (select *, row_number() over (partition by doc_id order by window_no) chunk_number, count(*) over (partition by doc_id) total_chunks_in_document from (select *, sha256(content) content_hash from windowed qualify row_number() over (partition by sha256(content) order by doc_id, window_no) = 1))",
        ["windowed"],
    ),
    "truth": (
        f"select * exclude (text), case when doc_id % 10 < 3 then 'doc_' || doc_id || '_hr_topics_en.csv' else 'doc_' || doc_id || '.txt' end filename, {_list(TRUE_DEPARTMENT, 'doc_id')} true_department, {_list(TRUE_TYPE, 'doc_id')} true_doc_type, case when doc_id % 9 = 0 then ' en ' else upper(lang) end true_language, {_list(TRUE_SENSITIVITY, 'doc_id')} true_sensitivity from governed",
        ["governed"],
    ),
    "events_log": (
        "select * from (select 'doc_' || substr(sha256('d' || doc_id), 1, 16) document_id, doc_id, doc_type, department, unnest([1767225600 + doc_id * 60, 1767225600 + doc_id * 60 + 5 + doc_id % 7, 1767225600 + doc_id * 60 + 20 + doc_id % 3, 1767225600 + doc_id * 60 + 30, 1767225600 + doc_id * 60 + 40]) at_s, unnest(['ingested', case when doc_id % 4 >= 1 then 'classified' end, case when doc_id % 4 >= 2 then 'chunked' end, case when doc_id % 4 = 3 then 'indexed' end, case when doc_id % 4 >= 2 and doc_id % 5 = 0 then 'classified' end]) stage from governed) where stage is not null",
        ["governed"],
    ),
    "assets": (
        "select document_id, any_value(doc_id) doc_id, any_value(doc_type) doc_type, max(department) department, arg_max(stage, at_s * 10 + list_position(['ingested', 'classified', 'chunked', 'indexed'], stage)) status, count(*) n_events, max(at_s) filter (stage = 'ingested') ingested_at, max(at_s) filter (stage = 'classified') classified_at, max(at_s) filter (stage = 'chunked') chunked_at from events_log group by document_id",
        ["events_log"],
    ),
    "gold": (
        f"select doc_id * 2 + again line, case when doc_id % 11 = 0 then 'lost_' || doc_id || '.txt' when doc_id % 23 <> 0 then filename end filename, true_department, true_doc_type, true_language, {_list(TRUE_SENSITIVITY, '(doc_id + again)')} true_sensitivity from (select *, unnest(case when doc_id % 9 = 0 then [0, 1] else [0] end) again from truth where doc_id % 4 <> 0)",
        ["truth"],
    ),
    "history": (
        "select run, metric, case when run = 3 and metric = 'es' then null else s end score from (select doc_id % 6 + 1 run, lang metric, round(100.0 * count(*) filter ((doc_id * 7) % 13 > 2 + doc_id % 6 + 1) / count(*), 1)::double s from documents group by all)",
        [],
    ),
    "turns": (f"select *, {_list(SENSITIVITY, '(conv_id + turn)')} sensitivity_level from conversations", []),
    "markdown": (
        "select doc_id, 'Opening words' || chr(10) || 'Page 3 of 9' || chr(10) || '# Document ' || doc_id || chr(10) || 'DRAFT' || chr(10) || '-----' || chr(10) || replace(text, chr(10), '  ' || chr(10) || chr(10) || chr(10) || '## Part' || chr(10) || 'Company Name: x' || chr(10)) text from documents",
        [],
    ),
    "tokens": ("select doc_id, window_no, source, sensitivity, department, content, regexp_extract_all(lower(content), '[\\p{L}\\p{N}_]+') ts from chunks", ["chunks"]),
}


def sql(body: str, *names: str) -> str:
    """body with the named expressions, and those that they need, before it."""
    order: list[str] = []

    def need(n: str) -> None:
        for x in CTES[n][1]:
            need(x)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    return ("with " + ", ".join(f"{n} as ({CTES[n][0]})" for n in order) + " " if order else "") + body


def ranking_ctes(where: str, question: str = QUESTION, tag: str = "") -> str:
    """Semantic and lexical scores of the chunks that `where` lets through, as CTEs seen, sem, lex."""
    value = "('0x' || substr(sha256(t), 1, 8))::ubigint::double / 4294967295"
    vec = lambda c: f"list_transform(list_filter(string_split_regex(translate({c}, chr(10) || '/', '  '), '{WS}'), lambda x: x <> ''), lambda t: round({value}, 6))"
    return f"""seen{tag} as (select * from tokens where {where}),
q{tag} as (select {vec(f"'{question}'")} qv),
sem{tag} as (select doc_id, window_no, case when len(v) = 0 or len(qv) = 0 then 0.0 else list_inner_product(v[1:least(len(v), len(qv))], qv[1:least(len(v), len(qv))]) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(qv, qv))) end score from (select doc_id, window_no, {vec('content')} v from seen{tag}), q{tag}),
st{tag} as (select count(*) n, avg(len(ts)) avgdl from seen{tag}),
df{tag} as (select term, count(*) df from (select unnest(list_distinct(ts)) term from seen{tag}) group by term),
idf{tag} as (select term, ln(n - df + 0.5) - ln(df + 0.5) idf from df{tag}, st{tag}),
asked{tag} as (select term, count(*) weight from (select unnest(regexp_extract_all(lower('{question}'), '[\\p{{L}}\\p{{N}}_]+')) term) group by term),
w{tag} as (select term, weight * case when idf < 0 then 0.25 * (select avg(idf) from idf{tag}) else idf end w from idf{tag} join asked{tag} using (term)),
tf{tag} as (select doc_id, window_no, len(ts) dl, term, count(*) tf from (select doc_id, window_no, ts, unnest(ts) term from seen{tag}) group by all),
lex{tag} as (select doc_id, window_no, sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) score from tf{tag} join w{tag} using (term), st{tag} group by doc_id, window_no)"""
