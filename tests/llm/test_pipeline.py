import re
from pathlib import Path

import corpus_pipeline
from quillstone.llm import queries, quality, secrets
from test_groups import brute_copies
from test_packing_tokens import check_pieces
from test_scans import brute_spans

ROOT = Path(__file__).resolve().parents[2]


def test_pipeline_against_plain_steps(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    names = brute_copies(sorted(texts.items()))
    clean = sorted((i, secrets.redact(texts[i], brute_spans(texts[i]))) for i in names)
    assert not any(re.search(r"[0-9a-f]{24}", t) for _, t in clean)
    rows = corpus_pipeline.run(spark, sf)
    at = spark.createDataFrame(clean, "doc_id long, text string")
    total = at.count()
    assert rows.select("doc_id").distinct().count() == total == len(clean)
    from quillstone.llm import packing

    want = sorted((r.doc_id, r.doc_tokens) for r in packing.pack_documents(at).filter("start = 0").collect())
    assert sorted((r.doc_id, r.doc_tokens) for r in rows.filter("start = 0").collect()) == want
    check_pieces(at, clean)


def test_stages(spark, odd, none):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0
        out = stage(spark, odd, "")
        out.collect()
        assert name == "packing" or out.columns == odd.columns


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_nothing_else_imports_the_subpackage():
    for p in ROOT.joinpath("quillstone").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "quillstone.llm" not in p.read_text()
