"""Operator 13 against a plain program, and its matrix against plain counts."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from quillstone.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def audit(docs, labels):
    """docs (doc_id, text, source), labels (doc_id, quality, toxic) to the rows that must come out."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        rows[s or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, mine in rows.items():
        told, share = {}, Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                share[f] += len(gone)
                fails = sum(f in r[0] for r in mine)
                told["".join(order), k + 1] = (f, len(left), len(gone), fails - len(gone), sum(r[0] == {f} for r in mine), sum(r[1] for r in gone), sum(r[2] for r in gone))
        out += [(part, o, k, *v[1:], share[v[0]]) for (o, k), v in told.items()]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_odd_documents(spark, odd):
    docs = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 1, 1), (9, 0, 0), (99, 1, 1), (15, 1, 1)]
    got = result(A.filter_audit(odd, spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")))
    assert got == audit(docs, labels)


@pytest.mark.parametrize("size", [1, 3000])
def test_many_small_shards(spark, monkeypatch, size):
    """Shards of one document, and of a few, add up to the same."""
    monkeypatch.setattr(A, "SHARD_BYTES", size)
    texts = ["many " * 250, "Aa b c " * 40, " ".join(f"w{i}" for i in range(220)), "", None, "tail $ " + " ".join(f"x{i}" for i in range(300))]
    docs = [(k % 37 if k % 11 else None, texts[k % len(texts)], f"s{k % 3}" if k % 4 else None) for k in range(90)]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 37, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert result(A.filter_audit(df, spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int"))) == audit(docs, labels)


def test_one_text_in_most_rows(spark):
    docs = [(i, "same text here" if i % 3 else f"text {i}", f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(16)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(A.filter_audit(df, labels)) == audit(docs, [])


def test_empty_table(spark, none):
    assert A.filter_audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_matrix_and_dictionary(spark, monkeypatch, odd):
    """Every word has one id, without gaps; the matrix gives the words of each document back with their counts."""
    monkeypatch.setattr(A, "SHARD_BYTES", 2000)
    matrix, dictionary = A.document_term_matrix(odd.select("doc_id", F.col("source").alias("part"), "text"))
    words = {r.id: r.word for r in dictionary.collect()}
    texts = [(r.doc_id, Counter(WORD.findall(r.text or ""))) for r in odd.collect()]
    assert sorted(words) == list(range(len(words))) and set(words.values()) == {w for _, c in texts for w in c}
    got = []
    for s in matrix.collect():
        for k, i in enumerate(s.doc_id):
            span = slice(s.indptr[k], s.indptr[k + 1])
            got.append((i, Counter({words[x]: n for x, n in zip(s.indices[span], s.data[span])})))
            assert len(set(s.indices[span])) == s.indptr[k + 1] - s.indptr[k]
    assert sorted(map(repr, ((i, sorted(c.items())) for i, c in got))) == sorted(map(repr, ((i, sorted(c.items())) for i, c in texts)))
