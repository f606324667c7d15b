import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import sharding, simhash, vptree
from quillstone.llm.components import connected_components


def test_jump_hash_moves_rows_into_the_new_shard_only():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 20_000)
    for n in (1, 2, 7, 24):
        a, b = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        assert a.min() >= 0 and a.max() == n - 1 and ((a == b) | (b == n)).all()
        assert abs((a != b).mean() - 1 / (n + 1)) < 0.02


def test_jump_hash_against_the_published_loop():
    def slow(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
        return b

    keys = [0, 1, 2**63, 123456789, 2**64 - 1]
    assert sharding.jump_hash(np.array(keys, np.uint64), 24).tolist() == [slow(k, 24) for k in keys]


def test_shards(docs, odd, none):
    for rows in (docs, odd):
        out = sharding.shard_documents(rows).collect()
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows.collect())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == texts
        slots = defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
            assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) and r.law == "key"
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        place = defaultdict(set)
        for r in out:
            if r.doc_id is not None:
                place[r.doc_id].add((r.shard, r.grown_shard))
        assert all(len(p) == 1 for p in place.values())
    assert sharding.shard_documents(none).count() == 0


def test_shards_of_rows_with_clashing_columns(spark):
    rows = spark.createDataFrame([(i, f"x{i}", i, 2 * i, "k") for i in range(50)], "id long, jump_key string, part int, place int, row string")
    out = sharding.shard_rows(rows, "id", 5)
    assert out.columns == [*rows.columns, "shard", "grown_shard", "slot"] and sorted(tuple(r)[:5] for r in out.collect()) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError, match="slot"):
        sharding.shard_rows(rows.withColumnRenamed("part", "slot"), "id", 5)


def brute_print(text, shingle=3):
    import re

    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=3):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted((str(d), f"{prints[i]:016x}", str(least[find(i)])) for i, (d, _) in enumerate(rows))


def test_simhash_components(docs, odd, none):
    for rows in (docs, odd):
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.simhash_components(rows).collect())
        assert got == brute_components([(r.doc_id, r.text) for r in rows.collect()])
    assert simhash.simhash_components(none).count() == 0


def brute_copies(rows, similarity=0.8, shingle=5):
    """Smallest doc_id of each component of texts that share at least `similarity` of their word shingles. Sets are the bits of integers."""
    sets: list[int] = []
    place: dict[tuple, int] = {}
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        sets.append(sum(1 << place.setdefault(tuple(w[i : i + shingle]), len(place)) for i in {tuple(w[i : i + shingle]): i for i in range(max(1, len(w) - shingle + 1))}.values()) if w else 0)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and (sets[i] & sets[j]).bit_count() >= similarity * (sets[i] | sets[j]).bit_count():
                parent[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        g = find(k)
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    return set(least.values())


def edited(docs, spark):
    """The documents with copies of some, in which every twentieth or every third word is another."""
    texts = sorted((r.doc_id, r.text) for r in docs.filter("text is not null").collect())[:300]
    more = []
    for d, t in texts[:60]:
        w = t.split(" ")
        more += [(1_000_000 + k * 10_000 + d, " ".join("other" if i % step == step - 1 else x for i, x in enumerate(w))) for k, step in enumerate((90, 60, 20, 3))]
    return spark.createDataFrame(texts + more, "doc_id long, text string")


def test_one_document_of_each_group_of_near_copies_stays(spark, docs, odd, none):
    for rows in (docs, edited(docs, spark)):
        assert {r.doc_id for r in simhash.drop_near_copies(rows).collect()} == brute_copies([(r.doc_id, r.text) for r in rows.collect()])
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and len(kept.filter("doc_id = 1").collect()) == 1
    assert simhash.drop_near_copies(none).count() == 0


def template_family(n=300, core=140, own=30, last=16):
    """Texts on one template, alike at 0.69; every third has another ending than the one before, alike at 0.82."""
    out = []
    for i in range(n):
        mine = [f"own{i}x{k}" for k in range(own)]
        w = [f"core{k}" for k in range(core)] + mine if i % 3 < 2 else out[-1].split(" ")[:-last] + mine[-last:]
        out.append(" ".join(w))
    return [(i, out[i]) for i in np.random.default_rng(7).permutation(n).tolist()]


@pytest.mark.parametrize("lanes", [2048, 128])
def test_texts_on_one_template_lose_no_near_copy(spark, monkeypatch, lanes):
    monkeypatch.setattr(simhash, "LANES", lanes)
    rows = template_family()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_copies(rows)
    assert len(want) == 200 and {r.doc_id for r in simhash.drop_near_copies(docs).collect()} == want


def edited_family(n, seed, words=160, edits=6):
    """Texts that differ from one another by some edits, so that many pairs are just above or below 0.8."""
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w = [f"base{k}" for k in range(words)] if r.random() < 0.3 or not out else out[int(r.integers(len(out)))].split(" ")
        for k in r.integers(0, words, int(r.integers(0, edits + 1))):
            w[k] = f"new{i}x{k}"
        out.append(" ".join(w))
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("sizes", [(60, 200), (400,), (2000,)])
def test_families_of_edited_texts_lose_no_near_copy(spark, sizes):
    rows = [(1_000_000 * f + i, t.replace("base", f"f{f}b")) for f, n in enumerate(sizes) for i, t in edited_family(n, 31 + n)]
    want = brute_copies(rows)
    got = {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > len(sizes) and got == want


def test_texts_with_equal_prints_are_linked_only_if_alike(spark, monkeypatch):
    monkeypatch.setattr(simhash, "simhash", lambda hashes: 5)
    rows = template_family(60)
    assert {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_copies(rows)


def test_unrelated_texts_with_one_id_all_stay(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    rows = [(1, text(0)), (1, text(1)), (1, text(2)), (2, text(2) + " more"), (3, text(3)), (None, text(4)), (None, text(4) + " more"), (None, text(5))]
    got = [(r.doc_id, r.text) for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert {x for x in got if x[0]} == {rows[0], rows[1], rows[2], rows[4]} and len(got) == 6 and (None, text(5)) in got


def test_nearest_links_of_a_large_block_keep_it_joined():
    p = near_family(60)
    got = [(int(p[i]), int(p[j])) for i, j in zip(*simhash.links(p, None, 12), strict=True)]
    for radius in range(13):
        near = np.bitwise_count(p[:, None] ^ p[None, :]) <= radius
        place = {int(x): i for i, x in enumerate(p)}
        mine = np.eye(len(p), dtype=bool)
        for a, b in got:
            if (a ^ b).bit_count() <= radius:
                mine[place[a], place[b]] = mine[place[b], place[a]] = True
        for _ in range(10):
            near, mine = near @ near, mine @ mine
        assert (near == mine).all()


def near_family(n=300):
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 3, dtype=np.uint64)
    flips = [np.uint64(1) << r.integers(0, 64, n, dtype=np.uint64) for _ in range(4)]
    return np.unique(np.concatenate([b ^ flips[0] ^ flips[1] ^ f for b in base for f in flips[2:]]))


def test_bit_sliced_distances():
    p = near_family()
    planes, used = simhash.slice_bits(p)
    d = np.bitwise_count(p[:, None] ^ p[None, :])
    for radius in (0, 1, 3, 7):
        assert set(simhash.near_lanes(planes, p, used, radius)) == set(zip(*(x.tolist() for x in np.nonzero(d <= radius)), strict=True))
        assert simhash.near_pairs(p[1:], p[:-1], radius).tolist() == np.flatnonzero(np.bitwise_count(p[1:] ^ p[:-1]) <= radius).tolist()


def test_large_blocks_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LANES", 64)
    p = near_family()
    rows = spark.createDataFrame([(i, int(x)) for i, x in enumerate(p.view(np.int64))], "doc_id long, print long")
    got = {r.doc_id: r.component_id for r in simhash.near_components(rows, simhash.near_links(rows)).collect()}
    d = np.bitwise_count(p[:, None] ^ p[None, :]) <= 3
    label = np.arange(len(p))
    while True:
        new = np.array([label[row].min() for row in d])
        if (new == label).all():
            break
        label = new
    assert [got[i] for i in range(len(p))] == label.tolist()


def test_key_tables_lose_no_link():
    for rows in (10, 10**6, 10**10):
        tables = simhash.key_tables(rows, 3)
        r = np.random.default_rng(rows % 97)
        for _ in range(200):
            flips = set(r.integers(0, 64, 3).tolist())
            assert any(not any(s <= f < s + n for s, n in t for f in flips) for t in tables)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {out[i] for i in range(201)} == {0} and {out[1000 + i] for i in range(300)} == {1000}


def brute_nearest(rows, k=20, step=20):
    """Lists of (vec_id, score) of each query row, in order of their query ids and lists."""
    held = [(r.vec_id, np.array(r.embedding, float)) for r in rows if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    out = []
    for n, (i, x) in enumerate(held):
        if i % step == 0:
            scores = sorted((-np.cumsum(x * y)[-1], j) for m, (j, y) in enumerate(held) if m != n and len(y) == len(x))
            out.append((i, [(j, -s) for s, j in scores[:k]]))
    return sorted(out)


def found_nearest(df, k=20):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id, r["rank"]].append((r.vec_id, r.score))
    return out


def agree(df, want, k=20):
    got, need = found_nearest(df), defaultdict(list)
    for i, found in want:
        for rank, x in enumerate(found, 1):
            need[i, rank].append(x)
    assert {key: sorted(v) for key, v in got.items()} == {key: sorted(v) for key, v in need.items()}


@pytest.mark.parametrize("shard_bytes", [8 << 20, 16_384])
def test_nearest(spark, sf, shard_bytes):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    odd = spark.createDataFrame([(10_000, None, 1), (10_020, [0.0] * 64, 1), (10_040, [float("nan")] * 64, 1), (10_060, [None] * 64, 1), (None, [1.0] * 64, 1), (10_080, [1.0, 2.0], 1), (10_081, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    again = v.filter("vec_id in (7, 40, 60)")
    other = v.filter("vec_id = 7").select("vec_id", F.transform("embedding", lambda x: x * 3).alias("embedding"), "label")
    both = v.unionByName(odd).unionByName(v.limit(30).withColumn("vec_id", v.vec_id + 20_001)).unionByName(again).unionByName(again).unionByName(other)
    agree(vptree.nearest(both, both.filter("vec_id % 20 = 0"), shard_bytes=shard_bytes), brute_nearest(both.collect()))
    assert vptree.nearest(v.limit(0), v.limit(0)).count() == 0 and vptree.nearest(v.limit(0), v).count() == 0 and vptree.nearest(v, v.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1e-7, 1e7, 1e-160, 1e150])
def test_nearest_at_any_scale(spark, scale):
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(size=(300, 6)), np.repeat(r.normal(size=(3, 6)), 40, axis=0), r.integers(-2, 3, (100, 6))]) * scale
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    agree(vptree.nearest(rows, rows.filter("vec_id % 20 = 0"), shard_bytes=4096), brute_nearest(rows.collect()))


def test_queries_visit_only_shards_that_can_hold_a_neighbour(spark, monkeypatch):
    r = np.random.default_rng(5)
    middle = r.normal(size=(12, 16))
    x = np.repeat(middle / np.linalg.norm(middle, axis=1)[:, None], 60, axis=0) + 0.01 * r.normal(size=(720, 16))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    sent = []
    search = vptree._search_shards
    monkeypatch.setattr(vptree, "_search_shards", lambda asked, *rest: (sent.append(asked.count()), search(asked, *rest))[1])
    agree(vptree.nearest(rows, rows.filter("vec_id % 20 = 0"), shard_bytes=8192), brute_nearest(rows.collect()))
    shards = vptree.build_index(rows, 8192)[0].count()
    assert shards > 8 and sent[0] == 36 and sent[1] < 0.7 * 36 * (shards - 1)


def test_relaxed_pruning_keeps_recall_and_factor_one_is_exact():
    r = np.random.default_rng(2)
    x = (r.normal(size=(40, 8))[r.integers(0, 40, 4000)] + 0.1 * r.normal(size=(4000, 8))).astype(float)
    norm = float(np.sqrt((x * x).sum(1).max()))
    tree, ids = vptree.build(vptree.lift(x, norm), leaf=32), np.arange(4000)
    want = np.argsort(-(x[:200] @ x.T), axis=1, kind="stable")[:, :20]
    recall = {}
    for factor in (1.0, 0.8):
        best = vptree.Best(x[:200], 20)
        vptree.search(tree, x, ids, norm, ids[:200], best, factor)
        recall[factor] = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best.id.tolist(), want.tolist(), strict=True)])
    assert recall[1.0] == 1.0 and recall[0.8] >= 0.9


@pytest.mark.parametrize("pivot_bytes", [4 << 20, 8 * 16 * 8])
def test_large_cells_have_balls_of_their_own(spark, monkeypatch, pivot_bytes):
    """Eight pivots for some 60 shards of tight clusters, met flat and in two levels; rows of one vector fill several parts."""
    r = np.random.default_rng(6)
    middle = r.normal(size=(40, 16))
    x = np.repeat(middle / np.linalg.norm(middle, axis=1)[:, None], 60, axis=0) + 0.001 * r.normal(size=(2400, 16))
    x = np.concatenate([x, np.repeat(x[:1], 200, axis=0)])
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vptree, "PIVOTS", 8)
    monkeypatch.setattr(vptree, "PIVOT_BYTES", pivot_bytes)
    sent = []
    search = vptree._search_shards
    monkeypatch.setattr(vptree, "_search_shards", lambda asked, *rest: (sent.append(asked.count()), search(asked, *rest))[1])
    agree(vptree.nearest(rows, rows.filter("vec_id % 20 = 0"), k=5, shard_bytes=8192), brute_nearest(rows.collect(), k=5))
    trees = vptree.build_index(rows, 8192)[0]
    shards = trees.count()
    assert shards > 40 and trees.select("cell").distinct().count() <= 8 and sent[0] == 130
    assert sent[1] < 0.1 * 130 * (shards - 1)
