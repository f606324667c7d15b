"""The segmented search index: what runs leave equals a new build, writes follow the change, and forbidden partitions are not opened."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillstone.operators import retrieval, search_index
from quillstone.plans import views

ROWS = "doc_id long, window_no int, department string, sensitivity string, content string"
QUESTION = "red fish and blue sea"


def rows(spark, *docs):
    return spark.createDataFrame(list(docs), ROWS)


def chunk(i, w, text, department="HR", sensitivity="Public"):
    return (i, w, department, sensitivity, text)


BASE = [chunk(i, w, f"red{i % 3} fish number {i} window {w} blue sea sea" + " and" * (i % 4), ["HR", "Legal", None, "", "Ops"][i % 5], ["Public", "Internal", "Restricted", None][i % 4]) for i in range(30) for w in range(2)]


def state(index):
    """All that an index says: its rows and its statistics."""
    chunks = sorted(map(repr, map(tuple, index.chunks.select("doc_id", "window_no", "department", "sensitivity", "content", "dl").collect())))
    postings = sorted(map(repr, map(tuple, index.postings.select("term", "doc_id", "window_no", "tf", "dl", "in_department", "at_level").collect())))
    terms = sorted(map(repr, map(tuple, index.terms.groupBy("term", "in_department", "at_level").agg(F.sum("df").alias("df")).filter("df <> 0").collect())))
    sizes = sorted(map(repr, map(tuple, index.sizes.groupBy("in_department", "at_level").agg(F.sum("n").alias("n"), F.sum("dl").alias("dl")).filter("n <> 0").collect())))
    return chunks, postings, terms, sizes


def found(index):
    lexical = sorted((r.doc_id or -1, r.window_no, round(r.score, 9)) for r in retrieval.bm25(index, QUESTION).collect())
    fused = [(r.doc_id, r.window_no, round(r.rrf_score, 9)) for r in retrieval.hybrid_search(index, QUESTION, "Internal", ["HR"]).orderBy(F.desc("rrf_score"), "doc_id", "window_no").collect()]
    return lexical, fused


def test_runs_leave_what_a_new_build_has(spark, tmp_path):
    path = f"file://{tmp_path}/grown"
    search_index.build(rows(spark, *BASE), path)
    # changed text, changed labels only, a window gone, a new document, one unchanged
    run = [chunk(1, 0, "a new red text"), chunk(2, 0, *[BASE[4][4], "Legal", "Confidential"]), BASE[5], BASE[6], chunk(99, 0, "late fish")]
    told = search_index.update(rows(spark, *run), path)
    # 1: first changed, second stale; 2: first changed, second kept; 3: first kept, second stale; 99 is new
    assert told == {"written": 3, "deleted": 4, "unchanged": 2}
    told = search_index.update(rows(spark), path, gone=rows(spark, chunk(4, 0, ""), chunk(5, 0, ""), chunk(1234, 0, "")))
    assert told == {"written": 0, "deleted": 4, "unchanged": 0}
    told = search_index.update(rows(spark, chunk(4, 0, "back again, red sea"), chunk(1, 0, "a third text")), path)
    assert told == {"written": 2, "deleted": 1, "unchanged": 0}
    want = [r for r in BASE if r[0] not in (1, 2, 3, 4, 5)] + [*run[1:], chunk(4, 0, "back again, red sea"), chunk(1, 0, "a third text")]
    search_index.build(rows(spark, *want), f"file://{tmp_path}/new")
    new, grown = search_index.load(spark, f"file://{tmp_path}/new"), search_index.load(spark, path)
    assert state(grown) == state(new) and found(grown) == found(new)
    assert search_index.merge(spark, path, below=10) == 2
    merged = search_index.load(spark, path)
    assert state(merged) == state(new) and found(merged) == found(new)
    assert merged.chunks.select("segment").distinct().count() == 2
    assert search_index.merge(spark, path, below=1000) == 2 and search_index.merge(spark, path, below=1000) == 0
    last = search_index.load(spark, path)
    assert state(last) == state(new) and last.chunks.select("segment").distinct().count() == 1


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def test_a_run_writes_what_it_changes(spark, sf, tmp_path):
    all_rows = views.chunks(spark, sf).select(*views.INDEXED)
    path = f"file://{tmp_path}/index"
    search_index.build(all_rows, path)
    before = size(tmp_path)
    assert search_index.update(all_rows, path)["written"] == 0 and search_index.load(spark, path).name.endswith("@1")
    few = all_rows.filter("doc_id % 50 = 0").withColumn("content", F.concat("content", F.lit(" more")))
    told = search_index.update(few, path)
    assert told["written"] == told["deleted"] == few.count()
    written = sum(size(p) for t in ("chunks", "postings") for p in (tmp_path / "index" / t).iterdir() if p.stat().st_mtime > 0) - before
    assert written < before / 5


def test_keys_of_one_run_and_null_keys(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    search_index.build(rows(spark, chunk(None, 0, "no id"), chunk(1, 0, "one"), chunk(None, None, "no window")), path)
    again = rows(spark, chunk(1, 0, "older"), chunk(1, 0, "newer"), chunk(None, 0, "no id, changed")).withColumn("at", F.when(F.col("content") == "older", 1).otherwise(2))
    search_index.update(again.drop("at"), path)
    held = {(r.doc_id, r.window_no): r.content for r in search_index.load(spark, path).chunks.collect()}
    assert held == {(1, 0): "older", (None, 0): "no id, changed"}  # equal orders: the greatest row; the stale null window goes
    newest = search_index.newest(again, ["doc_id", "window_no"], ["at"]).collect()
    assert sorted(r.content for r in newest) == ["newer", "no id, changed"]


def test_a_run_that_broke_off_counts_for_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/index"
    search_index.build(rows(spark, *BASE), path)
    before = state(search_index.load(spark, path))
    monkeypatch.setattr(search_index, "_commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        search_index.update(rows(spark, chunk(1, 0, "changed"), chunk(77, 0, "new")), path)
    monkeypatch.undo()
    assert state(search_index.load(spark, path)) == before
    assert search_index.update(rows(spark, chunk(1, 0, "changed"), chunk(77, 0, "new")), path) == {"written": 2, "deleted": 2, "unchanged": 0}
    with pytest.raises(Exception, match="(?i)exists"):
        search_index._commit(spark, path, 2, segments=[], runs=[], key=[], dim=1, deleted=0, schemas={})


def test_index_of_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    search_index.build(rows(spark), path)
    empty = search_index.load(spark, path)
    assert empty.chunks.count() == 0 and retrieval.bm25(empty, "red").count() == 0
    assert retrieval.search_many(empty, spark.createDataFrame([(1, "red")], "question_no long, question string"), "Public").count() == 0
    assert search_index.update(rows(spark, chunk(1, 0, "red")), path)["written"] == 1
    assert retrieval.bm25(search_index.load(spark, path), "red").count() == 1


def test_forbidden_partitions_are_not_opened(spark, sf):
    """No file but those of allowed partitions gives a row."""
    seen = views.index(spark, sf).visible("Internal", ["Legal"])
    for df in (seen.chunks, seen.postings, seen.terms):
        opened = {p for r in df.select(F.input_file_name().alias("f")).distinct().collect() for p in r.f.split("/") if p.startswith(("in_department=", "at_level="))}
        assert opened == {"in_department=Legal", "in_department=General", "at_level=0", "at_level=1"}


def test_an_unreadable_department_hinders_only_its_members(spark, tmp_path):
    search_index.build(rows(spark, *BASE), f"file://{tmp_path}/index")
    for f in (tmp_path / "index").rglob("in_department=Legal/**/*.parquet"):
        f.write_bytes(b"not parquet")
        f.with_name(f".{f.name}.crc").unlink()
    index = search_index.load(spark, f"file://{tmp_path}/index")
    assert retrieval.hybrid_search(index, QUESTION, "Restricted", ["HR"]).count() == 5
    with pytest.raises(Exception, match="(?i)parquet"):
        retrieval.hybrid_search(index, QUESTION, "Restricted", ["Legal"]).collect()


def test_many_questions_are_single_searches(spark, sf):
    index = views.index(spark, sf)
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("question_no"), F.col("text").alias("question")).orderBy("question_no").limit(6)
    odd = spark.createDataFrame([(1000, "!!! ..."), (1001, None), (1002, ""), (1003, "nosuchword")], "question_no long, question string")
    both = asked.unionByName(odd)
    many = {}
    for r in retrieval.search_many(index, both, "Confidential", ["HR"]).collect():
        many.setdefault(r.question_no, {})[r.place] = (r.doc_id, r.window_no, round(r.score, 9), round(r.rrf_score, 12), r.mode)
    for q in both.collect():
        one = retrieval.hybrid_search(index, q.question or "", "Confidential", ["HR"]).collect()
        one = sorted((r.doc_id, r.window_no, round(r.score, 9), round(r.rrf_score, 12), r.mode) for r in one)
        assert sorted(many.get(q.question_no, {}).values()) == one, q.question
        assert sorted(many[q.question_no]) == list(range(1, len(one) + 1))


def test_questions_come_in_blocks(spark, sf, monkeypatch):
    index = views.index(spark, sf)
    asked = spark.createDataFrame([(i, f"the privacy of number {i}") for i in range(5)], "question_no long, question string")
    whole = sorted(map(tuple, retrieval.search_many(index, asked, "Public").collect()))
    monkeypatch.setattr(retrieval, "QUESTIONS_AT_ONCE", 2)
    assert sorted(map(tuple, retrieval.search_many(index, asked, "Public").collect())) == whole


def test_mean_idf_is_taken_once_and_only_for_common_words(spark, tmp_path, monkeypatch):
    search_index.build(rows(spark, *[chunk(i, 0, f"common word{i}") for i in range(5)]), f"file://{tmp_path}/index")
    index = search_index.load(spark, f"file://{tmp_path}/index")
    calls = []
    mean = retrieval._mean_idf
    monkeypatch.setattr(retrieval, "_mean_idf", lambda *a: calls.append(1) or mean(*a))
    retrieval.bm25(index, "word1").count()
    assert not calls
    for _ in range(2):
        retrieval.bm25(index, "common").count()
    assert len(calls) == 1
    assert os.path.exists(tmp_path / "index" / "manifest")


def covers(words, asked):
    """Least stretches that hold every asked word, by trying all of them."""
    whole = [(a, b) for a in range(len(words)) for b in range(a, len(words)) if asked <= set(words[a : b + 1])]
    return [(a, b) for a, b in whole if not any((c, d) != (a, b) and a <= c and d <= b for c, d in whole)]


def test_cover_density_against_all_stretches():
    import random

    r = random.Random(1)
    for _ in range(400):
        words = [r.choice("abcdx") for _ in range(r.randint(1, 14))]
        asked = r.sample("abc", r.randint(1, 3))
        places = [[i for i, w in enumerate(words) if w == a] for a in asked]
        want = sum(0.1 / (1 + sum(w not in asked for w in words[a : b + 1])) for a, b in covers(words, set(asked)))
        if all(places):
            assert retrieval.cover_score(places) == pytest.approx(want), (words, asked)


def test_cover_density_of_chunks(spark, sf):
    import re

    index = views.index(spark, sf)
    got = {(r.doc_id, r.window_no): r.score for r in retrieval.cover_density(index, "The and of AND", every_word=True).collect()}
    want = {}
    for r in index.chunks.select("doc_id", "window_no", "content").collect():
        words = re.findall(r"\w+", r.content.lower())
        asked = {"the", "and", "of"}
        if asked <= set(words):
            at = [[i for i, w in enumerate(words) if w == a] for a in asked]
            # from each place of a word the next of every other; stretches that hold a shorter one are no least ones
            ends = [(a, max(min((x for x in p if x >= a), default=10**9) for p in at)) for p in at for a in p]
            least = {(a, b) for a, b in ends if b < 10**9 and not any(c > a and d <= b for c, d in ends)}
            want[r.doc_id, r.window_no] = sum(0.1 / (1 + sum(w not in asked for w in words[a : b + 1])) for a, b in least)
    assert got == pytest.approx(want) and want
    assert retrieval.cover_density(index, "!!", every_word=True).count() == 0


def test_early_end_gives_the_best_from_fewer_postings(spark, tmp_path, monkeypatch):
    """Rare words stand in few blocks; common ones are read there alone. After deletions and a second segment too, and with ties and too few chunks."""
    monkeypatch.setattr(search_index, "BLOCK", 4)
    monkeypatch.setattr(retrieval, "FIRST_BLOCKS", 3)
    path = f"file://{tmp_path}/blocks"
    docs = [chunk(i, w, "fish sea " + "and blue " * (i % 5) + ("coral " * (1 + i % 3) if i % 37 == 0 else "") + "pad " * (i % 11), ["HR", "Legal"][i % 2]) for i in range(300) for w in range(2)]
    search_index.build(rows(spark, *docs), path)
    for step in range(2):
        index = search_index.load(spark, path)
        for seen in (index, index.visible("Public", ["HR"])):
            for question, k in (("coral fish and sea", 5), ("fish", 7), ("fish sea", 5_000), ("nowhere", 5)):
                every = sorted(((-r.score, r.doc_id, r.window_no) for r in retrieval.bm25(seen, question).collect()))
                got = [(r.doc_id, r.window_no, r.score) for r in retrieval.bm25_best(seen, question, k).collect()]
                assert [g[2] for g in got] == pytest.approx([-x[0] for x in every[:k]], rel=1e-12)
                near = {x[1:] for x in every if -x[0] >= got[-1][2] - 1e-9} if got else set()
                assert {g[:2] for g in got} <= near and len({g[:2] for g in got}) == len(got)
        weights, mean_dl = retrieval._term_weights(index, "coral fish and sea")
        read, every = retrieval.bm25_hits(index, weights, mean_dl, 5), index.postings.filter(F.col("term").isin(list(weights)))
        assert 0 < read.count() < every.count() / 3
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(block" in plan
        search_index.update(rows(spark, *[chunk(i, 0, "coral coral fish") for i in (3, 37, 401)]), path, gone=rows(spark, chunk(74, 0, "")))


def test_scores_that_sql_holds_equal_are_equal(spark, tmp_path):
    """As SQL has them: cosines are added up by fused multiply-adds in order, and equal shares of BM25 give equal sums in any order of rows."""
    import hashlib
    import math

    import duckdb

    words = [f"w{i}" for i in range(40)]
    docs = [chunk(i, 0, " ".join([w] * n)) for i, w in enumerate(words) for n in [1 + i % 30]]
    search_index.build(rows(spark, *docs), f"file://{tmp_path}/index")
    index, question = search_index.load(spark, f"file://{tmp_path}/index"), "x0 x1 x2 x3 x4 x5 x6 x7 x8 x9"
    vec = lambda t: [math.floor(int(hashlib.sha256(w.encode()).hexdigest()[:8], 16) / 4294967295.0 * 1e6 + 0.5) / 1e6 for w in t.split()]
    want = {}
    for i, _, _, _, text in docs:
        v, q = vec(text), vec(question)
        m = min(len(v), len(q))
        want[i] = duckdb.execute("select list_inner_product(a[1:$m], b[1:$m]) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b))) from (select $a::double[] a, $b::double[] b)", {"m": m, "a": v, "b": q}).fetchone()[0]
    assert {r.doc_id: r.score for r in retrieval.semantic(index, question).collect()} == want
    asked = spark.createDataFrame([(1, question)], "question_no long, question string")
    assert {r.doc_id: r.score for r in retrieval.semantic_many(index, asked, F.lit(""), 100).collect()} == want
    shares = spark.createDataFrame([(k, x) for k, order in (("a", [0.1, 0.7, 1e3 / 3]), ("b", [1e3 / 3, 0.7, 0.1])) for x in order], "k string, x double").coalesce(1)
    assert shares.groupBy("k").agg(retrieval._total(F.col("x")).alias("t")).select("t").distinct().count() == 1


def test_blocks_are_of_one_pair_of_labels_and_postings_are_not_shuffled(spark, tmp_path, monkeypatch):
    """A block's bounds are taken where its whole chunks are; its chunks share labels, so bounds are fewer than postings."""
    monkeypatch.setattr(search_index, "BLOCK", 8)
    monkeypatch.setattr(search_index, "CHUNKS_AT_ONCE", 7)
    written = []
    append = search_index._append
    monkeypatch.setattr(search_index, "_append", lambda df, path, name, *by: (written.append((name, df._jdf.queryExecution().optimizedPlan().toString())), append(df, path, name, *by)))
    search_index.build(rows(spark, *BASE), f"file://{tmp_path}/index")
    (plan,) = [p for n, p in written if n.startswith("postings")]
    assert "Repartition" not in plan and "Aggregate" not in plan
    index = search_index.load(spark, f"file://{tmp_path}/index")
    held = index.postings.select("block", "doc_id", *search_index.LABELS).distinct().collect()
    assert len({(r.block, r.in_department, r.at_level) for r in held}) == len({r.block for r in held})
    assert len({(r.doc_id, r.in_department, r.at_level) for r in held}) == len({(r.doc_id, r.block) for r in held})
    of = ["term", "block", *search_index.LABELS]
    want = index.postings.groupBy(*of).agg(F.count("*").alias("n"), F.max("tf").alias("top_tf"), F.min("dl").alias("least_dl"))
    rows_of = lambda df: sorted(map(tuple, df.select(*of, "n", "top_tf", "least_dl").collect()))
    assert rows_of(index.bounds) == rows_of(want) and index.bounds.count() < index.postings.count()


def test_words_of_many_texts_are_counted_as_one_by_one():
    texts = ["red sea red", None, "", "sea, SEA sea", "a a a"]
    dl, terms, tfs, places = (x.to_pylist() for x in search_index._counted(texts))
    for i, t in enumerate(texts):
        words = search_index._WORD.findall(t or "")
        assert dl[i] == len(words) and sorted(terms[i]) == sorted(set(words))
        for w, n, at in zip(terms[i], tfs[i], places[i], strict=True):
            assert at == [j for j, x in enumerate(words) if x == w] and n == len(at)


def test_runs_of_the_grown_index_read_chunks_that_were_made_once(spark, sf, tmp_path, monkeypatch):
    plans = []
    see = lambda rows, *a, **k: plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(search_index, "build", see)
    monkeypatch.setattr(search_index, "update", see)
    monkeypatch.setattr(search_index, "merge", lambda *a, **k: 0)
    monkeypatch.setattr(views, "_kept", lambda spark, sf_dir, name, build: build(f"file://{tmp_path}/x"))
    views.grown_index(spark, sf)
    assert len(plans) == 4 and not any("Generate" in p for p in plans)


def test_each_piece_of_a_text_is_looked_through_once(spark):
    """Words and vectors come from the distinct pieces between white space, whatever white space, signs and slashes the texts hold."""
    import pyarrow as pa

    from quillstone.functions import text as T

    texts = ["red sea red", None, "", " a/b c\x1cd\x85é_f,g  red", "sea, SEA sea.", "/ /x", "w " * 1500 + "/y/z " * 200]
    seen = []
    ends, number, found = T.pieces_of(pa.array(texts), lambda pieces: seen.append(pieces) or search_index._found(pieces))
    assert len(seen) == 1 and len(seen[0]) == len(set(seen[0]))
    for i, t in enumerate(texts):
        assert [found[n] for n in number[ends[i] : ends[i + 1]]] == search_index._WORD.findall(t or "")
    want = [r.v for r in spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "i int, t string").select("i", T.hash_embedding(F.col("t")).alias("v")).orderBy("i").collect()]
    assert T.vectors_of(pa.array(texts)).to_pylist() == want


def test_runs_of_chunks_end_with_their_blocks(monkeypatch):
    import pyarrow as pa

    batches = [pa.record_batch({"block": pa.array([i // 5 for i in range(a, b)], pa.int32()), "_low": ["x" * 10] * (b - a), "at": list(range(a, b))}) for a, b in ((0, 13), (13, 14), (14, 60))]
    for many, text, alone in ((7, 10**6, [7] * 8 + [4]), (10**6, 95, [10] * 6)):
        monkeypatch.setattr(search_index, "RUN", many)
        monkeypatch.setattr(search_index, "RUN_BYTES", text)
        runs = list(search_index._runs(iter(batches)))
        assert [x for r in runs for x in r["at"].to_pylist()] == list(range(60))
        assert [r.num_rows for r in runs] == [10] * 6
        assert [r.num_rows for r in search_index._runs(b.drop_columns("block") for b in batches)] == alone
    assert not list(search_index._runs(iter([])))


def test_a_segment_holds_no_word_twice(spark, tmp_path, monkeypatch):
    """Chunks hold no word lists; postings and bounds are made of the texts, in order, and only frequencies are added up by a shuffle of words."""
    plans = {}
    append = search_index._append
    monkeypatch.setattr(search_index, "_append", lambda df, path, name, *by: (plans.setdefault(name.split("/")[0], df._jdf.queryExecution().optimizedPlan().toString()), append(df, path, name, *by)))
    search_index.build(rows(spark, *BASE), f"file://{tmp_path}/index")
    assert not any("array<string>" in t for _, t in search_index.load(spark, f"file://{tmp_path}/index").chunks.dtypes)
    assert "Generate" not in plans["postings"] + plans["bounds"] and "Aggregate" not in plans["bounds"]
    assert "Repartition" not in plans["terms"]


def test_words_of_deleted_chunks_are_taken_away(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    search_index.build(rows(spark, chunk(1, 0, "Red red SEA"), chunk(2, 0, "red"), chunk(3, 0, None)), path)
    search_index.update(rows(spark), path, gone=rows(spark, chunk(1, 0, ""), chunk(3, 0, "")))
    terms = {r.term: r.df for r in search_index.load(spark, path).terms.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    assert terms == {"red": 1, "sea": 0}


def test_shares_are_rounded_without_decimal_strings(spark):
    """round() of a double goes through BigDecimal and its digits, for each posting and question."""
    shares = spark.createDataFrame([(1, 0.1), (1, -2.7), (2, 1e3 / 3), (2, 0.0)], "k int, x double")
    out = shares.groupBy("k").agg(retrieval._total(F.col("x")).alias("t"))
    assert "round(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.k: r.t for r in out.collect()} == {k: sum(round(x * 2**40) for x in v) / 2**40 for k, v in ((1, (0.1, -2.7)), (2, (1e3 / 3, 0.0)))}
