import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quillstone.llm import packing, token_store, words_bpe
from quillstone.llm.tokens import ByteEncoder


def brute_cost(places, is_doc, capacity):
    """Least cost over all cut places, one id apart."""
    n = places[-1]
    cost_of = {p: 0.0 if d else packing.SENTENCE_CUT for p, d in zip(places, is_doc, strict=True)}
    best = [0.0] + [float("inf")] * n
    for p in range(1, n + 1):
        best[p] = min(best[i] + packing.SEQUENCE + capacity - (p - i) for i in range(max(0, p - capacity), p)) + cost_of.get(p, packing.WORD_CUT)
    return best[n]


def test_cuts_are_the_best_and_legal():
    for seed in range(400):
        r = random.Random(seed)
        n, capacity = r.randint(1, 400), r.choice([32, 64, 100])
        places = sorted({r.randint(1, n) for _ in range(r.randint(0, 60))} | {n})
        is_doc = np.array([r.random() < 0.3 for _ in places])
        is_doc[-1] = True
        cuts = packing.choose_cuts(np.array(places), is_doc, capacity).tolist()
        assert cuts[-1] == n and all(0 < b - a <= capacity for a, b in zip([0, *cuts], cuts, strict=False))
        cost_of = {p: 0.0 if d else packing.SENTENCE_CUT for p, d in zip(places, is_doc, strict=True)}
        total = sum(packing.SEQUENCE + capacity - (b - a) + cost_of.get(b, packing.WORD_CUT) for a, b in zip([0, *cuts], cuts, strict=False))
        assert abs(total - brute_cost(places, is_doc, capacity)) < 1e-6


def test_padding():
    assert [packing.padding(n) for n in (1, 2, 3, 512, 1000, 1024)] == [0, 0, 1021, 0, 24, 0]


def ids_of(texts):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encoded(enc, texts):
    ids, counts = enc.encode_batch(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else ids.tolist()


def test_encoder_gives_the_tokenizers_ids(docs, odd):
    enc = ByteEncoder(P.path("byte_bpe_50k.tiktoken"))
    texts = [r.text for r in docs.collect()] + [r.text for r in odd.collect()] + ["a  b", "\n", " x\n\ny", "it's\n I'm", "x\r\ny", " a b"]
    assert encoded(enc, texts) == ids_of(texts)
    assert encoded(enc, [None, "<|endoftext|> a", "x<|endoftext|>", "a b"] * 3) == ids_of([None, "<|endoftext|> a", "x<|endoftext|>", "a b"] * 3) and encoded(enc, []) == []


def test_encoder_on_random_white_space():
    enc = ByteEncoder(P.path("byte_bpe_50k.tiktoken"))
    r = random.Random(11)
    texts = ["a  b\tc", "a b\tc ", "a  b c", "\na", "a\n"] + ["".join(r.choice("ab1.' \n\t\r\x1c\x85\u2003\u3000é's") for _ in range(r.randint(0, 12))) for _ in range(20_000)]
    assert encoded(enc, texts) == ids_of(texts)


def check_pieces(rows, texts):
    pieces = packing.pack_documents(rows).collect()
    want = sorted((i if i is not None else -1, tuple([*ids, 0])) for (i, _), ids in zip(texts, ids_of([t for _, t in texts]), strict=True))
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    ordered = []
    for s in sorted(by_sequence):
        parts = sorted(by_sequence[s], key=lambda p: p.offset)
        assert parts[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(parts, parts[1:], strict=False))
        assert sum(p.length for p in parts) <= 1024
        ordered += parts
    remaining = defaultdict(list)
    for i, ids in want:
        remaining[i, len(ids)].append(ids)
    k = 0
    while k < len(ordered):
        first, run = ordered[k], []
        done = 0
        while done < first.doc_tokens:
            assert ordered[k].start == done and ordered[k].doc_tokens == first.doc_tokens
            run.append(ordered[k])
            done += ordered[k].length
            k += 1
        options = remaining[first.doc_id if first.doc_id is not None else -1, first.doc_tokens]
        fits = [o for o in options if all(zlib.crc32(np.array(o[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in run)]
        options.remove(fits[0])
    assert not any(remaining.values())
    used = sum(p.length for p in pieces)
    return sum(packing.padding(sum(p.length for p in s)) for s in by_sequence.values()) / max(1, used)


def test_pieces_of_documents(docs, odd, none):
    assert check_pieces(docs, [(r.doc_id, r.text) for r in docs.collect()]) < 0.02
    check_pieces(odd, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack_documents(none).count() == 0


def test_permutation():
    for n in (1, 2, 3, 7, 100, 1000, 4097):
        assert sorted(token_store.permute(np.arange(n), n).tolist()) == list(range(n))
    assert (token_store.permute(np.arange(1000), 1000, key=1) != token_store.permute(np.arange(1000), 1000, key=2)).any()


def test_token_shards(spark, docs, odd, none, tmp_path):
    path = f"file://{tmp_path}/shards"
    n = token_store.write_shards(docs, path, length=64, shard_rows=100)
    rows = token_store.read_slots(spark, path, length=64, shard_rows=100).collect()
    assert sorted(r.slot for r in rows) == list(range(n)) and all(r.shard == r.slot // 100 and len(r.payload) == 128 for r in rows)
    want = sum(len(i) + 1 for i in ids_of([r.text for r in docs.collect()]))
    assert sum(r.n_ids for r in rows) == want
    # read back in input order, the sequences are the documents' ids end to end
    order = {int(s): r for s, r in zip(token_store.permute(np.arange(n), n), range(n), strict=True)}
    ordered = sorted(rows, key=lambda r: order[r.slot])
    stream = [x for r in ordered for x in np.frombuffer(r.payload, "<u2")[: r.n_ids].tolist()]
    assert stream == [x for i in ids_of([r.text for r in docs.collect()]) for x in [*i, 50256]]
    owner = [(k, r.doc_id) for k, (r, i) in enumerate(zip(docs.collect(), ids_of([r.text for r in docs.collect()]), strict=True)) for _ in range(len(i) + 1)]
    at = 0
    for r in ordered:
        mine = owner[at : at + r.n_ids]
        assert r.first_doc_id == mine[0][1] and r.n_docs == len(set(mine)) and r.ids_crc32 == zlib.crc32(r.payload)
        at += r.n_ids
    assert sorted(r.slot for r in token_store.read_slots(spark, path, 150, 260, 64, 100).collect()) == list(range(150, min(260, n)))
    # one file a shard, and any slot at its byte offset
    for shard in range(-(-n // 100)):
        (file,) = (tmp_path / "shards" / f"shard={shard}").glob("part-*")
        data = file.read_bytes()
        size = token_store.stride(64)
        assert len(data) == size * min(100, n - 100 * shard)
        for r in rows:
            if r.shard == shard:
                assert data[(r.slot % 100) * size :][:size][56:-6] == r.payload


def test_token_shards_of_odd_rows(spark, odd, none, tmp_path):
    path = f"file://{tmp_path}/odd"
    token_store.write_shards(odd, path, length=8, shard_rows=16)
    rows = token_store.read_slots(spark, path, length=8, shard_rows=16).collect()
    want = [x for i in ids_of([r.text for r in odd.collect()]) for x in [*i, 50256]]
    assert sorted(x for r in rows for x in np.frombuffer(r.payload, "<u2")[: r.n_ids].tolist()) == sorted(want)
    assert {r.first_doc_id for r in rows} <= {r.doc_id for r in odd.collect()} and any(r.first_doc_id is None for r in rows)
    (file,) = (tmp_path / "odd" / "shard=0").glob("part-*")
    file.write_bytes(file.read_bytes()[:-9] + b"xyz" + token_store.END.encode())
    (tmp_path / "odd" / "shard=0" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="damaged"):
        token_store.read_slots(spark, path, 0, 16, 8, 16).collect()
    assert token_store.store_documents(odd).count() > 0 and token_store.store_documents(none).count() == 0


def test_token_shards_go_on(spark, docs, none, tmp_path):
    import shutil

    path, folder = f"file://{tmp_path}/broken", tmp_path / "broken"
    how = {"length": 64, "shard_rows": 100}
    n = token_store.write_shards(docs, path, **how)
    files = lambda: {p.parent.name: (p.name, p.read_bytes()) for p in folder.glob("shard=*/part-*")}
    whole = files()
    assert len(whole) == -(-n // 100) > 3
    # as a job leaves it that broke off: some shards are missing, others are whole, one task had begun
    for shard in (0, 2, max(int(x.split("=")[1]) for x in whole)):
        shutil.rmtree(folder / f"shard={shard}")
    (folder / "_SUCCESS").unlink()
    (folder / "_temporary" / "0").mkdir(parents=True)
    kept = files()
    assert token_store.write_shards(docs, path, **how) == n
    again = files()
    assert {k: v[1] for k, v in again.items()} == {k: v[1] for k, v in whole.items()} and all(again[k] == v for k, v in kept.items())
    # a finished path stays as it is
    assert token_store.write_shards(docs, path, **how) == n and files() == again
    with pytest.raises(ValueError, match="another"):
        token_store.write_shards(docs, path, **how, key=5)
    # broken off before any shard, and while counting
    for shard in again:
        shutil.rmtree(folder / shard)
    assert token_store.write_shards(docs, path, **how) == n and {k: v[1] for k, v in files().items()} == {k: v[1] for k, v in whole.items()}
    (folder / "_counts" / "_SUCCESS").unlink()
    with pytest.raises(FileExistsError):
        token_store.write_shards(docs, path, **how)
    for shard in again:
        shutil.rmtree(folder / shard)
    assert token_store.write_shards(docs, path, **how) == n and {k: v[1] for k, v in files().items()} == {k: v[1] for k, v in whole.items()}
    assert token_store.write_shards(none, f"file://{tmp_path}/none") == 0 == token_store.write_shards(none, f"file://{tmp_path}/none")


def test_words(docs, odd, none):
    import hashlib

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for rows in (docs, odd):
        texts = [(r.doc_id, r.text) for r in rows.collect()]
        want = []
        for (i, _), e in zip(texts, tok.encode_batch([t or "" for _, t in texts], add_special_tokens=False), strict=True):
            want.append((str(i), len(e.ids), sha(" ".join(map(str, e.ids))), sha(tok.decode(e.ids, skip_special_tokens=False))))
        got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in words_bpe.encode_documents(rows).collect()]
        assert sorted(got) == sorted(want)
    assert words_bpe.encode_documents(none).count() == 0


def test_counts_are_those_of_the_ids():
    enc = ByteEncoder(P.path("byte_bpe_50k.tiktoken"), "<u2")
    r = random.Random(5)
    texts = ["", None, "a", "\n", " \n a\tb", "a  b", "x<|endoftext|>y z", "  q", "\n\n", "a\nb c\n", "é ñ \r\n k", *("".join(r.choice(["ab", "c", " ", " ", "\n", "\t", "\u00a0", "é", "."]) for _ in range(r.randint(0, 40))) for _ in range(3000))]
    assert enc.count_batch(pa.array(texts)).tolist() == enc.encode_batch(pa.array(texts))[1].tolist()
    assert not enc.count_batch(pa.array([], pa.string())).size
