"""What is kept between runs: streamed documents and the registry's log."""

import itertools

import pytest
from pyspark.sql import functions as F

from quillstone.operators import registry
from quillstone.streaming import ingest

DOCS = "doc_id long, text string, lang string"


def held(spark, target):
    return {(r.doc_id, r.content, r.lang) for r in ingest.current(spark, target).collect()}


def batches(spark, target, *runs):
    for n, rows in enumerate(runs):
        ingest.take(spark.createDataFrame([(*r, "en") if len(r) == 2 else r for r in rows], DOCS), n, target)
    return {(d, c) for d, c, _ in held(spark, target)}


def test_a_text_that_comes_back_counts(spark, tmp_path):
    t = str(tmp_path)
    assert batches(spark, f"{t}/a", [(1, "text a")], [(1, "text b")], [(1, "text a")]) == {(1, "text a")}
    assert ingest.current(spark, f"{t}/a").count() == 1 and spark.read.parquet(f"{t}/a/texts").count() == 2


def test_a_freed_text_passes_to_its_next_owner(spark, tmp_path):
    t = str(tmp_path)
    assert batches(spark, f"{t}/a", [(1, "text a"), (2, "text a"), (3, "text a")]) == {(1, "text a")}
    assert batches(spark, f"{t}/b", [(1, "text a"), (2, "text a")], [(1, "text b")]) == {(1, "text b"), (2, "text a")}
    assert batches(spark, f"{t}/c", [(1, "text a"), (2, "text a")], [(1, "text b")], [(1, "text a")]) == {(1, "text a")}
    assert batches(spark, f"{t}/d", [(5, "text a")], [(4, "text a"), (None, "text a")], [(4, "x"), (5, "x"), (None, None)]) == {(4, "x"), (None, "")}


def test_every_history_leaves_what_the_last_claims_say(spark, tmp_path):
    """Three documents, three batches, two texts: all 512 histories at once, a document id and texts of its own for each."""
    histories = list(itertools.product(itertools.product("ab", repeat=3), repeat=3))
    runs = [[(10 * h + d, f"{h} {texts[d]}") for h, steps in enumerate(histories) for texts in [steps[n]] for d in range(3) if (h + n + d) % 4] for n in range(3)]
    got = batches(spark, str(tmp_path), *runs)
    claims = {d: t for run in runs for d, t in run}
    want = {}
    for d, t in claims.items():
        want[t] = min(d, want.get(t, d))
    assert got == {(d, t) for t, d in want.items()}


def test_labels_and_order_inside_a_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "one", "en"), (1, "two", "fr"), (2, "two", "de")], DOCS).withColumn("at", F.when(F.col("text") == "one", 9).otherwise(1))
    ingest.take(df, 0, str(tmp_path), order="at")
    assert held(spark, str(tmp_path)) == {(1, "one", "en"), (2, "two", "de")}


def test_a_batch_that_broke_off_is_done_again(spark, tmp_path):
    target = str(tmp_path)
    df = spark.createDataFrame([(1, "old", "en"), (2, "same", "en")], DOCS)
    ingest.take(df, 0, target)
    again = spark.createDataFrame([(1, "new", "en"), (3, "same", "en")], DOCS)
    # only the texts of the second batch were written
    ingest.take(again, 1, target)
    (tmp_path / "claims" / "batch=1").rename(tmp_path / "lost")
    assert held(spark, target) == {(1, "old", "en"), (2, "same", "en")}
    for _ in range(2):
        ingest.take(again, 1, target)
        assert held(spark, target) == {(1, "new", "en"), (2, "same", "en")}
        assert spark.read.parquet(f"{target}/texts").filter("content = 'new'").count() == 1


def test_stream_of_files(spark, sf, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    docs = spark.createDataFrame(spark.read.parquet(f"{sf}/documents.parquet").limit(20).collect())
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    run = lambda: ingest.ingest(spark, str(source), schema, target, str(tmp_path / "check")).awaitTermination(120)
    docs.write.parquet(str(source))
    run()
    run()
    texts = docs.select("text").distinct().count()
    assert ingest.current(spark, target).select("doc_id").distinct().count() == texts
    one = docs.limit(1)
    docs.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(one.withColumn("text", F.lit("a new text"))).write.mode("append").parquet(str(source))
    run()
    now = ingest.current(spark, target)
    assert now.select("doc_id").distinct().count() == texts + 1
    changed = one.first()["doc_id"]
    assert [r.content for r in now.filter(F.col("doc_id") == changed).collect()] == ["a new text"]
    one.write.mode("append").parquet(str(source))
    run()
    assert ingest.current(spark, target).select("doc_id").distinct().count() == texts


EVENTS = "document_id string, stage string, at long"
LOG = [("a", "ingested", 1), ("b", "ingested", 2), ("a", "classified", 5), ("a", "chunked", 5), ("b", "classified", 9), ("b", "chunked", 7), ("c", "ingested", 3), ("a", "ingested", 20), ("c", "indexed", 4), ("b", "indexed", 9)]


def states(df):
    return sorted(tuple(r[c] for c in ("document_id", "status", "updated_at", "n_events", *(f"{s}_at" for s in registry.STATUSES))) for r in df.collect())


@pytest.mark.parametrize("cut", [(1, 2), (3, 4), (5, 9), (9, 10)])
def test_snapshot_and_tail_are_the_whole_fold(spark, tmp_path, cut):
    """Any cut, also where events come late: the log isn't in order of time."""
    path = f"file://{tmp_path}/log"
    with pytest.raises(FileNotFoundError):
        registry.load(spark, path)
    parts = [LOG[: cut[0]], LOG[cut[0] : cut[1]], LOG[cut[1] :]]
    done = []
    for n, part in enumerate(p for p in parts if p):
        registry.save(spark.createDataFrame(part, EVENTS), path)
        done += part
        assert states(registry.load(spark, path)) == states(registry.states(spark.createDataFrame(done, EVENTS)))
        if n < 2:
            assert registry.snapshot(spark, path) == n + 1
    assert states(registry.load(spark, path)) == states(registry.states(spark.createDataFrame(LOG, EVENTS)))


def test_only_later_batches_are_read(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    registry.save(spark.createDataFrame(LOG[:6], EVENTS), path)
    registry.snapshot(spark, path)
    registry.save(spark.createDataFrame(LOG[6:], EVENTS), path)
    for f in (tmp_path / "log" / "events" / "batch=1").glob("*.parquet"):
        f.write_bytes(b"broken")
    # a batch without its mark of success was never written
    (tmp_path / "log" / "events" / "batch=3").mkdir()
    assert states(registry.load(spark, path)) == states(registry.states(spark.createDataFrame(LOG, EVENTS)))


def test_unknown_documents_are_given_back(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    lost = registry.record(spark, path, spark.createDataFrame([("a", "ingested", 1), ("x", "chunked", 2), ("a", "chunked", 3)], EVENTS))
    assert [tuple(r) for r in lost.collect()] == [("x", "chunked", 2)]
    assert registry.record(spark, path, spark.createDataFrame([("a", "indexed", 4), ("y", "indexed", 5)], EVENTS)).count() == 1
    assert states(registry.load(spark, path))[0][:4] == ("a", "indexed", 4, 3)
