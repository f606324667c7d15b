"""Operators on small tables, plans, and every registered query against its SQL."""

import difflib
import math
import os
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone import plugins
from quillstone.functions import dialogue, text as T
from quillstone.operators import accuracy, chunking, index, quality_report, registry, retrieval, search_index, validation
from quillstone.plans import queries, views
from quillstone.sources import files


def rows_of(frame, columns):
    say = lambda v: "" if v is None or v != v else repr(round(float(v), 9)) if isinstance(v, float) else str(v)
    return sorted(tuple(say(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    if name not in queries.ORACLES:
        assert len(got) > 0
        return
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    want = c.sql(queries.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and rows_of(got, columns) == rows_of(want, columns)


def test_rule_counts(spark, sf):
    out = validation.validate(views.governed(spark, sf))
    fired = Counter(r[0] for r in out.select(F.explode("violations.rule")).collect())
    order = ["classification_failed", "unknown_department", "unknown_doc_type", "unknown_sensitivity", "unexpected_language", "missing_confidence", "low_confidence", "contract_under_classified"]
    assert [fired[k] for k in order] == [16, 51, 23, 62, 47, 17, 76, 7] and out.filter("passed").count() == 30
    assert validation.summary(out.limit(0)).first().pass_rate is None


def test_first_copy_of_a_text_is_kept_and_numbered(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    out = chunking.chunks(docs).select("doc_id", "chunk_number", "total_chunks_in_document").collect()
    assert sorted(map(tuple, out)) == [(1, 1, 1), (3, 1, 1)]


def test_first_copies_of_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (None, "only here"), (2, "two"), (2, "two"), (3, "x"), (3, "y")], "doc_id long, text string")
    out = sorted((str(r.doc_id), r.content, r.chunk_number) for r in chunking.chunks(docs).collect())
    assert out == [("1", "a b c", 1), ("2", "two", 1), ("3", "x", 1), ("3", "y", 1), ("None", "only here", 1)]


def made_index(spark, tmp_path, texts, **labels):
    rows = spark.createDataFrame([(k, 0, v, labels.get("department"), labels.get("sensitivity", "Public")) for k, v in texts.items()], "doc_id long, window_no int, content string, department string, sensitivity string")
    search_index.build(rows, f"file://{tmp_path}/index")
    return search_index.load(spark, f"file://{tmp_path}/index")


def test_bm25_by_hand(spark, tmp_path):
    texts = {1: "red fish blue fish", 2: "red red dog", 3: "one cat", 4: "two birds fish"}
    got = {r.doc_id: r.score for r in retrieval.bm25(made_index(spark, tmp_path, texts), "red fish fish").collect()}
    toks = {k: v.split() for k, v in texts.items()}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    idf = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(idf.values()) / len(idf)
    for k, t in toks.items():
        want = sum((idf[w] if idf[w] >= 0 else 0.25 * mean) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in ["red", "fish", "fish"])
        assert abs(got.get(k, 0.0) - want) < 1e-9


def test_index_needs_its_manifest(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    with pytest.raises(FileNotFoundError):
        search_index.load(spark, path)
    assert search_index.found_score(spark, path) == 0.0
    empty = made_index(spark, tmp_path, {})
    assert search_index.found_score(spark, path) is None
    assert retrieval.hybrid_search(empty, "red fish", "Public").count() == 0
    with pytest.raises(FileNotFoundError):
        index.read_by_department(spark, f"{tmp_path}/nothing")


def test_a_question_without_words_is_answered_by_vectors_alone(spark, tmp_path):
    held = made_index(spark, tmp_path, {1: "!!! ok", 2: "red fish"})
    assert {r.mode for r in retrieval.hybrid_search(held, "!!!", "Public").collect()} == {"semantic_only"}
    assert {r.mode for r in retrieval.hybrid_search(held, "red", "Public").collect()} == {"hybrid"}


def test_a_question_reads_its_postings_alone(spark, sf):
    held = views.index(spark, sf)
    plan = retrieval.bm25(held, "privacy license")._jdf.queryExecution().executedPlan().toString()
    # a word that the index lacks isn't asked for
    assert "EqualTo(term,license)" in plan or "In(term, [license,privacy])" in plan or "In(term, [privacy,license])" in plan
    assert "content" not in plan and "vector" not in plan


def test_access_filter_stands_below_both_rankings(spark, sf):
    got = retrieval.hybrid_search(views.index(spark, sf), "the privacy", "Public", ["HR"])
    rows = got.collect()
    assert rows and all(r.sensitivity == "Public" and r.department in (None, "General", "HR") for r in rows)
    assert {"doc_id", "window_no", "department", "sensitivity", "content", "score", "rrf_score", "in_semantic_results", "in_lexical_results", "mode"} <= set(got.columns)


def test_hash_vectors_are_the_expression(spark):
    texts = ["", "one", "a/b\nc a", " ".join(f"w{i % 700}" for i in range(2000)), None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.hash_vectors("t").alias("a"), T.hash_embedding(F.coalesce("t", F.lit(""))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and len(rows[3].a) == 768


def test_ann_recall(spark, sf):
    got = {(r.query_id, r.vec_id) for r in queries.ann_topk(spark, sf).collect()}
    v = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    unit = {i: x / np.linalg.norm(x) for i, x in v.items()}
    want = {(q, j) for q in unit if q % 100 == 0 for _, j in sorted((-float(unit[q] @ x), j) for j, x in unit.items() if j != q)[:10]}
    assert len(got & want) >= 0.9 * len(want)


def test_scans_read_only_what_a_query_needs(spark, sf):
    plan = queries.validate_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_rrf_ties_and_sums(spark):
    a = spark.createDataFrame([(1, 1, 0, 0.5), (2, 2, 0, 0.4)], "id long, rank int, list_id int, score double")
    b = spark.createDataFrame([(2, 1, 1, 3.0), (3, 2, 1, 2.0)], "id long, rank int, list_id int, score double")
    got = {r.id: r.rrf_score for r in retrieval.rrf([a, b], ["id"]).collect()}
    assert got == {1: 1 / 61, 2: pytest.approx(1 / 62 + 1 / 61), 3: 1 / 62}


def test_index_upkeep(spark):
    cols = "document_id string, chunk_id string, v int"
    old = spark.createDataFrame([("d1", "d1_c1", 1), ("d1", "d1_c2", 1), ("d_1", "d_1_c1", 1)], cols)
    new = spark.createDataFrame([("d1", "d1_c1", 2)], cols)
    assert sorted(map(tuple, index.upsert(old, new).select("chunk_id", "v").collect())) == [("d1_c1", 2), ("d1_c2", 1), ("d_1_c1", 1)]
    twice = spark.createDataFrame([("d1", "d1_c1", 3), ("d1", "d1_c1", 5), ("d1", "d1_c1", 4), (None, None, 7)], cols)
    held = index.upsert(old.unionByName(twice.filter("v = 7").withColumn("v", F.lit(6))), twice, order="v")
    assert sorted((str(r.chunk_id), r.v) for r in held.collect()) == [("None", 7), ("d1_c1", 5), ("d1_c2", 1), ("d_1_c1", 1)]
    assert sorted(r.chunk_id for r in index.delete_stale(old, new).collect()) == ["d1_c1", "d_1_c1"]
    assert index.delete_stale(old, new.limit(0)).count() == 3


def test_department_partitions(spark, sf, tmp_path):
    chunks = views.chunks(spark, sf).withColumn("source_file", F.col("source"))
    index.write_by_department(chunks, f"{tmp_path}/index")
    back = spark.read.parquet(f"{tmp_path}/index")
    assert {r.department for r in back.select("department").distinct().collect()} == {"HR", "Finance", "Legal", "IT", "General"}
    assert back.filter("sensitivity is null").count() > 0


def test_registry(spark, sf):
    events = views.stage_events(spark, sf)
    assets = registry.states(events)
    bad = spark.createDataFrame([("nope", "indexed")], "document_id string, status string")
    assert [r.document_id for r in registry.unknown(assets, bad).collect()] == ["nope"]
    assert registry.lineage(events).select(F.max(F.size("lineage"))).first()[0] == 5
    assert registry.mark(assets, bad).count() == assets.count()


def test_of_events_at_one_time_the_furthest_stage_counts(spark):
    events = spark.createDataFrame([("a", "indexed", 5), ("a", "ingested", 5), ("a", "chunked", 4), ("b", "chunked", 1), ("b", "classified", 1)], "document_id string, stage string, at int")
    assert sorted((r.document_id, r.status) for r in registry.states(events).collect()) == [("a", "indexed"), ("b", "chunked")]


def test_chunks_are_counted_in_their_table(spark):
    assets = spark.createDataFrame([("a", "indexed"), ("b", "chunked"), ("c", "ingested")], "document_id string, status string")
    chunks = spark.createDataFrame([("a",), ("a",), ("b",)], "document_id string")
    assert tuple(registry.summary(registry.with_chunk_counts(assets, chunks)).first())[-2:] == (3, 2)
    assert [r.document_id for r in registry.lookup(assets, status="chunked").collect()] == ["b"]


def test_manifest_versions(spark, tmp_path):
    path = f"file://{tmp_path}/manifest"
    assert files.load_manifest(spark, path).count() == 0
    rows = spark.createDataFrame([("p", "h", 1.0, 2, "new", None, None, None)], files.MANIFEST)
    files.save_manifest(rows, path)
    files.save_manifest(rows.unionByName(rows), path)
    assert files.load_manifest(spark, path).count() == 2
    for f in (tmp_path / "manifest" / "v2").glob("*.parquet"):
        f.write_bytes(b"broken")
    for f in (tmp_path / "manifest" / "v2").glob(".*.crc"):
        f.unlink()
    with pytest.warns(UserWarning, match="set aside"):
        assert files.load_manifest(spark, path).count() == 1
    assert (tmp_path / "manifest" / "v2.corrupt").exists()


def test_embedding_cache(spark, tmp_path):
    empty = index.load_cache(spark, f"file://{tmp_path}/none")
    one = index.reuse_embeddings(spark.createDataFrame([("c1", "a b", "h1"), ("c2", "c", "h2")], "chunk_id string, content string, content_hash string"), empty)
    cache = index.save_cache(one, empty, f"file://{tmp_path}/c1")
    two = index.reuse_embeddings(spark.createDataFrame([("c1", "a b", "h1"), ("c2", "d", "h3")], "chunk_id string, content string, content_hash string"), cache)
    assert {r.chunk_id: r.embedding_source for r in two.collect()} == {"c1": "reused", "c2": "hash_fallback"}
    assert {r.chunk_id: (r.content_hash, r.embedding_source) for r in index.save_cache(two, cache, f"file://{tmp_path}/c2").collect()} == {"c1": ("h1", "hash_fallback"), "c2": ("h3", "hash_fallback")}


def test_other_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x, y"\n2,p|q\n')
    lines, told = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert told == {"rows": 2, "columns": ["a", "b"]} and sorted(r.line for r in lines.collect()) == ["| 1 | x, y |", "| 2 | p\\|q |"]
    (tmp_path / "d1.classified.json").write_text('{\n"department": "HR"\n}')
    (tmp_path / "d2.classified.json").write_text("{broken")
    assert [(r.file_name, r.department) for r in files.read_classified(spark, str(tmp_path / "*.classified.json"), "department string").collect()] == [("d1.classified.json", "HR")]
    pages = spark.createDataFrame([(1, "http://x.y/some/page.html", "<p>a"), (2, "u", "<title>T</title>")], "page_id long, url string, html string")
    assert sorted(r.title for r in files.html_markdown(pages).collect()) == ["T", "page"]
    assert index.missing_tables(["rag_chunks_hr"], ["HR", "IT"]) == ["rag_chunks_it", "rag_chunks_general"]


def test_near_smalltalk_against_plain_python(spark, sf):
    for r in queries.smalltalk_fuzzy(spark, sf).collect():
        said = re.findall(r"[^\W\d_]+", (r.said or "").strip().lower().rstrip("!.?،؟"))
        near = bool(said) and len(said) <= 3 and any(abs(len(w) - len(said[0])) <= 2 and difflib.SequenceMatcher(None, said[0], w).ratio() >= 0.8 for w in dialogue.FUZZY)
        assert r.smalltalk == near
    assert queries.smalltalk_fuzzy(spark, sf).filter("smalltalk").count() > 0


def test_drift_bounds(spark):
    history = spark.createDataFrame([(1, "a", 90.0), (2, "a", 85.0), (3, "a", 79.9), (4, "a", None), (5, "a", 50.0)], "run int, metric string, score double")
    assert [(r.run, r.status) for r in quality_report.drift(history).orderBy("run").collect()] == [(1, "no_baseline"), (2, "stable"), (3, "drift")]


def test_chunk_health(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "one two three four five"), (3, "ONE two  three four five"), (4, "a b")], "i int, content string")
    assert [r.health for r in quality_report.chunk_health(rows, ["i"]).orderBy("i").collect()] == ["tiny", "healthy", "duplicate", "tiny"]


def test_equivalent_types(spark):
    rows = spark.createDataFrame([("Memo", "Email"), ("memo ", "Document"), ("article", "Report"), (None, "")], "t string, p string")
    assert [r[0] for r in rows.select(accuracy.matches(F.col("t"), F.col("p"), True)).collect()] == [False, True, True, True]


def test_sample_covers_departments(spark, sf):
    names = {r.filename: r for r in queries.strong_sample(spark, sf).collect()}
    assert len(names) == 10 and len({r.true_department for r in names.values()}) >= 5


def test_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("héllo", encoding="utf-8")
    (tmp_path / "in" / "sub" / "b.TXT").write_text("x")
    (tmp_path / "in" / "c.bin").write_text("no")
    found = files.discover(spark, str(tmp_path / "in"))
    assert sorted(r.extension for r in found.collect()) == ["txt", "txt"]
    assert sorted((r.title, r.markdown) for r in files.text_documents(found).collect()) == [("a", "héllo"), ("b", "x")]
    (tmp_path / "x.jsonl").write_text('{"filename": "a", "n": 1}\n\nnot json\n{"n": 2}\n')
    assert [tuple(r) for r in files.json_lines(spark, str(tmp_path / "x.jsonl"), "filename string, n int", "filename").collect()] == [("a", 1)]
    assert files.to_markdown("<title>T</title><h2>H</h2><p>a &amp; b</p><ul><li>x</ul><script>no</script>") == ("T", "## H\n\na & b\n\n- x")


def test_without_a_model_nothing_is_guessed(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert {r.department for r in plugins.classify(docs).collect()} == {"UNCLASSIFIED"}
    told = {r.doc_id: (r.department, r.error) for r in plugins.classify(docs, lambda t: {"department": "HR"} if t else 1 / 0).collect()}
    assert told == {1: ("HR", None), 2: ("UNCLASSIFIED", "division by zero")}
    assert plugins.generate("x") == (None, "unavailable")
