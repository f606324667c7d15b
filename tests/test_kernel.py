"""Text, access and dialogue expressions against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quillstone.functions import access, dialogue, text as T

TEXTS = ["", "   ", "one", "a  b\tc\nd", "x y\x0bz\x1cw", "Émile—naïve été_1 ②", "مرحبا بالعالم", "a/b\nc", " lead and trail "]


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in sorted(rows.select("i", expr(F.col("t"))).collect())]


def test_words_and_hashes(spark):
    assert column(spark, TEXTS, T.words) == [t.split() for t in TEXTS]
    assert column(spark, TEXTS, T.content_hash) == [hashlib.sha256(" ".join(t.split()).encode()).hexdigest() for t in TEXTS]
    assert column(spark, TEXTS, T.trim) == [t.strip() for t in TEXTS]
    assert column(spark, TEXTS, T.tokens)[5] == ["émile", "naïve", "été_1", "②"]


@pytest.mark.parametrize(("n", "starts"), [(0, 1), (1, 1), (412, 1), (413, 2), (512, 2), (513, 2), (900, 3)])
def test_windows(spark, n, starts):
    words = [f"w{i}" for i in range(n)]
    want = [" ".join(words[i : i + 512]) for i in range(0, max(n, 1), 412)]
    assert column(spark, [" ".join(words)], T.windows) == [want] and len(want) == starts


def test_overlap_as_large_as_the_window_steps_by_one(spark):
    assert column(spark, ["a b c"], lambda c: T.windows(c, 2, 5)) == [["a b", "b c", "c"]]


def test_clean(spark):
    raw = "Title\nPage 3 of 9\n  draft \n-----\n\n\nBody  \n\n\n\nDocument Title: x\nCONFIDENTIAL\nEnd\r\n"
    assert column(spark, [raw, "", "Page 1"], T.clean) == ["Title\n\nBody\n\nEnd", "", ""]


def test_sections(spark):
    some = column(spark, ["pre\n# One\nbody 1\n## Two\n### Three\nbody 3", "no heads", "# Only", "# A \r\nx", "#nohead\ny"], T.sections)
    assert [[tuple(s) for s in x] for x in some] == [[("One", "body 1"), ("Three", "body 3")], [("Document", "no heads")], [("Document", "# Only")], [("A", "x")], [("Document", "#nohead\ny")]]
    kept = column(spark, ["pre\n# One\nbody"], lambda c: T.sections(c, keep_preamble=True))
    assert [tuple(s) for s in kept[0]] == [("Document", "pre"), ("One", "body")]


def test_hash_embedding_and_cosine(spark):
    def plain(t, dim):
        v = [0.0] * dim
        toks = t.replace("\n", " ").replace("/", " ").split()
        for i, w in enumerate(toks):
            v[i % dim] += int(hashlib.sha256(w.encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        return [round(x, 6) for x in v[: min(len(toks), dim)]]

    texts = ["", "a b/c\nd e", "x " * 20]
    got = column(spark, texts, lambda c: T.hash_embedding(c, 4))
    assert all(abs(a - b) < 1e-9 for g, t in zip(got, texts, strict=True) for a, b in zip(g, plain(t, 4), strict=True))
    one = spark.range(1).select(T.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("a"), T.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("b"), T.fit(F.array(F.lit(1.0)), 3).alias("c")).first()
    assert abs(one.a - 0.5**0.5) < 1e-12 and one.b == 0.0 and one.c == [1.0, 0.0, 0.0]


def test_chunk_id_is_not_cut(spark):
    assert spark.range(1).select(T.chunk_id(F.lit("doc_x"), F.lit(12345))).first()[0] == "doc_x_c12345"


LABELS = ["Public", "Internal", "Confidential", "Restricted", None, "TopSecret", ""]


@pytest.mark.parametrize(("clearance", "seen"), [("Public", 1), ("Internal", 2), ("Confidential", 3), ("Restricted", 7), ("nonsense", 1), (None, 1)])
def test_clearance_fails_closed(spark, clearance, seen):
    assert sum(column(spark, LABELS, lambda c: access.is_allowed(c, clearance))) == seen
    assert set(access.allowed_labels(clearance)) <= set(access.SENSITIVITY)


def test_departments(spark):
    values = ["HR", "General", "", None, "Legal", "Marketing"]
    assert column(spark, values, lambda c: access.department_visible(c, ["HR"])) == [True, True, True, True, False, False]
    assert all(column(spark, values, lambda c: access.department_visible(c, access.parse_departments(" all "))))
    assert access.parse_departments("HR, ,IT ") == ["HR", "IT"]
    assert access.department_tables(["HR", "General", "Nope"]) == ["rag_chunks_hr", "rag_chunks_general"] and len(access.department_tables("All")) == 5
    with pytest.raises(ValueError, match="unknown department"):
        access.department_table("Marketing")


def test_most_sensitive_label(spark):
    rows = spark.createDataFrame([(1, "Public"), (1, "Confidential"), (2, None), (3, "Public")], "g int, s string")
    assert {r.g: r.l for r in rows.groupBy("g").agg(access.max_sensitivity(F.col("s")).alias("l")).collect()} == {1: "Confidential", 2: "Restricted", 3: "Public"}
    assert rows.limit(0).agg(access.max_sensitivity(F.col("s")).alias("l")).first().l == "Public"


def test_dialogue(spark):
    said = ["Hi", " hello!?", "hi !", "helo darlin", "how is the weather", "howdy there", "bonjur", "what is the IT uptime"]
    assert column(spark, said, dialogue.is_smalltalk) == [True, True, False, False, False, False, False, False]
    assert column(spark, said, dialogue.is_near_smalltalk) == [True, True, True, True, False, True, True, False]
    assert column(spark, ['```json\n{"a": 1}\n```', 'so {"a": {"b": 2}} ok', "none"], dialogue.json_part) == ['{"a": 1}', '{"a": {"b": 2}}', ""]
    assert column(spark, ["0.5", "2", "x", None], dialogue.confidence) == [0.5, 0.85, 0.85, 0.85]
    assert column(spark, ["HTTP 429", "fine", None], lambda c: dialogue.contains_any(c, dialogue.RATE_LIMIT)) == [True, False, False]
    assert column(spark, ["short", "long enough text"], lambda c: dialogue.language_status(c, F.lit("de"))) == ["too_short", "outside_expected_languages"]
    assert column(spark, ["a" * 101, "x\ny "], dialogue.preview) == ["a" * 100 + "...", "x y"]


def test_no_boilerplate_pattern_matches_prose():
    assert not re.match(T.BOILERPLATE_RE.replace("(?i)", ""), "a page of text", re.I)


def test_functions_of_sql_are_the_expressions(spark):
    from quillstone.functions import sql

    sql.register(spark)
    raw = ["Title\nPage 3 of 9\n  draft \n-----\n\n\nBody  \n\n\n\nDocument Title: x\nCONFIDENTIAL\nEnd\r\n", "\n\n a \r\n\r\nb\rc\x0bd e", "pre\n# One\nbody 1\n## Two\n### Three\nbody 3", "# Only", "# A \r\nx", "#nohead\ny", "it's\n \n\\n 'x'", None]
    texts = [*TEXTS, *raw]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, t string")
    for name, expr in [("qs_words", T.words), ("qs_tokens", T.tokens), ("qs_collapse", T.collapse), ("qs_clean", T.clean), ("qs_sections", T.sections), ("qs_hash_embedding", T.hash_vectors), ("qs_access_rank", access.rank), ("qs_document_id", lambda c: T.document_id(F.sha2(c, 256)))]:
        both = rows.select("i", F.expr(f"{name}(t)").alias("a"), expr(F.col("t")).alias("b")).orderBy("i").collect()
        assert [r.a for r in both] == [r.b for r in both], name
    for clearance in ("Public", "Restricted", "nonsense", None):
        said = spark.createDataFrame([(x,) for x in LABELS], "s string").select(F.expr(f"qs_is_allowed(s, {'null' if clearance is None else repr(clearance)})").alias("a"), access.is_allowed(F.col("s"), clearance).alias("b")).collect()
        assert all(r.a == r.b for r in said)
    for size, overlap in ((4, 1), (2, 5), (512, 100)):
        rows.createOrReplaceTempView("qs_rows")
        got = spark.sql(f"select i, c.window_no w, c.content c from qs_rows, lateral qs_chunk_text(t, {size}, {overlap}) c where t is not null").collect()
        want = rows.filter("t is not null").select("i", F.posexplode(T.windows(F.col("t"), size, overlap)).alias("w", "c")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    plan = spark.sql("select qs_clean(t), qs_sections(t) from qs_rows")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
