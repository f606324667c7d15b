"""The persisted inverted lists against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.operators import ann_index
from quillstone.plans import queries, views


def exact(vectors, asked, k):
    keys = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in keys], float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    at = {i: n for n, i in enumerate(keys)}
    out = {}
    for q in asked:
        s = np.round(m @ m[at[q]], 12)
        out[q] = [int(keys[i]) for i in np.lexsort((keys, -s)) if keys[i] != q][:k]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 16))
    return {i: (centres[i % 25] + 0.2 * rng.normal(size=16)).astype(np.float32) for i in range(3000)}


def test_recall_of_the_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    got = answers(queries.ann_topk(spark, sf))
    v = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    want = exact(v, [i for i in v if i % 100 == 0], 10)
    assert set(got) == set(want) and sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 10 * len(want)


def test_clustered_vectors_need_few_lists(spark, tmp_path, clustered):
    path = f"file://{tmp_path}/ann"
    df = frame(spark, clustered)
    ann_index.build(df, path)
    index = ann_index.load(spark, path)
    assert index.lists.count() == 3000 and index.probes < len(index.centroids) / 4
    asked = df.filter("vec_id % 100 = 0")
    want = exact(clustered, range(0, 3000, 100), 10)
    got = answers(ann_index.search(index, asked))
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 10 * len(want)
    assert answers(ann_index.search(index, asked, probes=len(index.centroids))) == want
    # lists that are not probed aren't opened
    one = df.filter("vec_id = 500")
    found = answers(ann_index.search(index, one, probes=2))
    units = np.array([clustered[500]], float) / np.linalg.norm(clustered[500])
    near = {f"list={c}" for c in ann_index._order(units, index.centroids, 2)[0]}
    for f in (tmp_path / "ann").rglob("list=*/*.parquet"):
        if f.parent.name not in near:
            f.write_bytes(b"broken")
            f.with_name(f".{f.name}.crc").unlink()
    assert answers(ann_index.search(ann_index.load(spark, path), one, probes=2)) == found
    with pytest.raises(Exception, match="(?i)parquet"):
        ann_index.search(index, one, probes=len(index.centroids)).collect()


@pytest.mark.parametrize("rows,asked", [(100, 3), (7, 1)])
def test_lists_in_parts(spark, tmp_path, clustered, monkeypatch, rows, asked):
    monkeypatch.setattr(ann_index, "PART_ROWS", rows)
    monkeypatch.setattr(ann_index, "PART_QUERIES", asked)
    some = {i: v for i, v in clustered.items() if i < 400}
    path = f"file://{tmp_path}/ann"
    ann_index.build(frame(spark, some), path, lists=3)
    index = ann_index.load(spark, path)
    got = answers(ann_index.search(index, frame(spark, some).filter("vec_id % 20 = 0"), probes=3))
    assert got == exact(some, range(0, 400, 20), 10)


def test_equal_and_unusable_vectors(spark, tmp_path):
    odd = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.5, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, [1.0]), (10, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in odd], "vec_id long, embedding array<double>, norm string, list int")
    path = f"file://{tmp_path}/ann"
    ann_index.build(df, path, lists=2)
    index = ann_index.load(spark, path)
    got = answers(ann_index.search(index, df, k=2, probes=2))
    assert got == {1: [2, 3], 2: [1, 3], 3: [1, 2], 10: [1, 2]}
    ann_index.add(index, spark.createDataFrame([(11, [0.0, 1.0]), (12, None)], "vec_id long, embedding array<double>"), path)
    later = ann_index.load(spark, path)
    assert answers(ann_index.search(later, df.filter("vec_id = 10"), k=1, probes=2)) == {10: [11]}


def test_index_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    with pytest.raises(FileNotFoundError):
        ann_index.load(spark, f"file://{tmp_path}/ann")
    ann_index.build(none, f"file://{tmp_path}/ann")
    assert ann_index.search(ann_index.load(spark, f"file://{tmp_path}/ann"), none).count() == 0


def test_every_row_is_indexed(spark, sf):
    held = views.ann(spark, sf)
    assert held.lists.select("vec_id").distinct().count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert held.lists.filter(F.col("list") >= len(held.centroids)).count() == 0
