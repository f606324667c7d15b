"""Operator 10: BPE by a distinct-word table. Words are split in Spark, each distinct word is encoded once, and its ids are joined back by position; an id-to-piece table decodes."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import input_bytes, ship, shuffle_partitions
from quillstone.llm.tokens import tokenizer_path

#: Distinct words, and words in all, that close a block of documents: its dictionary and its documents stay within some 40 MB of a worker each. A document is never cut.
BLOCK_WORDS, BLOCK_PLACES = 250_000, 8_000_000
#: Words of a bucket that a worker remembers; when full it starts anew, so a bucket of any size takes bounded memory.
KNOWN_WORDS = 500_000
#: White space of the tokenizer's pattern; unlike Python's it lacks \x1c to \x1f.
SPACE = re.compile("[\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
CODEC = "zstd"


def normal(text: str) -> str:
    """As the tokenizer's normalizer: NFC, then each character's own lower case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def split_words(text: str, special: re.Pattern) -> list[str]:
    """Normalised words between white space, with special tokens (marked by a space before them) as words of their own."""
    if "<|" in text and special.search(text):
        out = []
        for k, part in enumerate(special.split(text)):
            out += [" " + part] if k % 2 else split_words(part, special)
        return out
    text = normal(text)
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    words = text.split()
    if sum(map(len, words)) + sum(map(text.count, " \n")) == len(text):
        return words
    return [w for w in SPACE.split(text) if w]


def bucket_count(size: int) -> int:
    """Hash buckets of the distinct-word table: one for 64 MB of input, within bounds that keep both a bucket's table and a block's share of it small."""
    return max(256, min(16_384, size >> 26))


def _press(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=CODEC, asbytes=True)


def _open(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=CODEC, asbytes=True)


def _pair(a: bytes, b: bytes) -> bytes:
    """Two compressed parts in one value."""
    return len(a).to_bytes(8, "little") + a + b


def _unpair(data: bytes) -> tuple[bytes, bytes]:
    cut = 8 + int.from_bytes(data[:8], "little")
    return data[8:cut], data[cut:]


_TOKENIZERS: dict[str, tuple] = {}


def _special(path: str):
    """The tokenizer and the pattern of its special tokens, loaded once a process. Words come normalised and with special tokens apart, so it does neither."""
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.normalizer = None
        tok.encode_special_tokens = True
        _TOKENIZERS[path] = tok, re.compile("(" + "|".join(re.escape(t.content) for t in tok.get_added_tokens_decoder().values()) + ")")
    return _TOKENIZERS[path]


def _numbers(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte: all lowest bytes first."""
    return _press(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _read_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(_open(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _bucket(word: str, buckets: int) -> int:
    import zlib

    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % buckets


SPLIT = "kind int, k long, block long, doc_id long, words long, data binary"


def _split(path: str, buckets: int):
    """Rows of two kinds: 0, a document's word numbers in its block, with the block as key k; 1, the block's distinct words of a bucket, with the bucket (as -1 - bucket) as key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, special = _special(path)
        block = TaskContext.get().partitionId() << 30
        number: dict[str, int] = {}
        docs: list[tuple[int | None, np.ndarray]] = []
        places_held = 0

        def rows(kind, keys, ids, words, data):
            n = len(data)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(keys, pa.int64()), pa.array(np.full(n, block)), pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(data, pa.binary())], names=[x.split()[0] for x in SPLIT.split(", ")]
            )

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, number, docs, places_held
            for i in range(0, len(docs), 256):
                part = docs[i : i + 256]
                yield rows(0, [block] * len(part), [d for d, _ in part], [len(p) for _, p in part], [_numbers(p) for _, p in part])
            held: list[list[str]] = [[] for _ in range(buckets)]
            places: list[list[int]] = [[] for _ in range(buckets)]
            for w, i in number.items():
                b = _bucket(w, buckets)
                held[b].append(w)
                places[b].append(i)
            full = [b for b in range(buckets) if held[b]]
            for i in range(0, len(full), 64):
                part = full[i : i + 64]
                data = [_pair(_press("\n".join(held[b]).encode("utf-8", "surrogatepass")), _numbers(np.diff(np.array(places[b]), prepend=0))) for b in part]
                yield rows(1, [-1 - b for b in part], [None] * len(part), [len(held[b]) for b in part], data)
            block, number, docs, places_held = block + 1, {}, [], 0

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = split_words(text.as_py() or "", special)
                add = number.setdefault
                docs.append((key, np.fromiter([add(w, len(number)) for w in words], np.uint32, len(words))))
                places_held += len(words)
                if len(number) >= BLOCK_WORDS or places_held >= BLOCK_PLACES:
                    yield from flush()
        if docs:
            yield from flush()

    return run


CODES = "k long, words long, data binary"


def _encode(path: str):
    """Rows come sorted by key. A bucket's words are encoded when first seen; each row goes back to its block with word numbers and ids. Documents' rows are not its business."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, _ = _special(path)
        ids_of_special = {" " + t.content: [i] for i, t in tok.get_added_tokens_decoder().items()}
        known: dict[str, list[int]] = {}
        now = None
        for batch in batches:
            out = []
            for row, kind in enumerate(batch.column(0).to_pylist()):
                if kind != 1:
                    continue
                bucket, block, data = (batch.column(i)[row].as_py() for i in (1, 2, 5))
                if bucket != now or len(known) > KNOWN_WORDS:
                    now, known = bucket, {}
                packed, numbers = _unpair(data)
                words = _open(packed).decode("utf-8", "surrogatepass").split("\n")
                fresh = [w for w in words if w not in known]
                plain = [w for w in fresh if w[0] != " "]
                for i in range(0, len(plain), 1024):
                    part = plain[i : i + 1024]
                    known.update(zip(part, (e.ids for e in tok.encode_batch(part, add_special_tokens=False)), strict=True))
                known.update((w, ids_of_special[w]) for w in fresh if w[0] == " ")
                ids = [known[w] for w in words]
                flat = [x for i in ids for x in i]
                out.append((block, len(words), _pair(_numbers(np.array([*map(len, ids), *flat])), numbers)))
            if out:
                k, n, d = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(d, pa.binary())], names=["k", "words", "data"])

    return run


def codes_of(rows: list[tuple[int, bytes]]) -> list[list[int]]:
    """Ids of each word number of a block, from its buckets' rows."""
    out: list[list[int]] = [[]] * sum(n for n, _ in rows)
    for n, data in rows:
        codes, numbers = map(_read_numbers, _unpair(data))
        flat, end = codes[n:].tolist(), np.cumsum(codes[:n]).tolist()
        for number, a, b in zip(np.cumsum(numbers).tolist(), [0, *end[:-1]], end, strict=True):
            out[number] = flat[a:b]
    return out


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(pieces: list[str]):
    """The documents of one block: their ids and decoded texts, as hashes. Keys of buckets have no documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and left.column("kind")[0].as_py() == 0:
            codes = codes_of(list(zip(right.column("words").to_pylist(), right.column("data").to_pylist(), strict=True)))
            ids = [" ".join(map(str, c)) for c in codes]
            said = [" ".join([pieces[i] for i in c]) for c in codes]
            count = np.fromiter(map(len, codes), np.int64, len(codes))
            sha = lambda parts, at: hashlib.sha256(" ".join([parts[i] for i in at]).encode()).hexdigest()
            for doc, n, data in zip(*(left.column(c).to_pylist() for c in ("doc_id", "words", "data")), strict=True):
                p = _read_numbers(data) if n else np.empty(0, np.uint32)
                at = p.tolist()
                rows.append((doc, int(count[p].sum()) if n else 0, sha(ids, at), sha(said, at)))
        d, c, i, s = zip(*rows, strict=True) if rows else ((),) * 4
        return pa.table({"doc_id": pa.array(d, pa.int64()), "n_tokens": pa.array(c, pa.int64()), "ids_sha256": pa.array(i, pa.string()), "decoded_sha256": pa.array(s, pa.string())})

    return run


def piece_table(path: str) -> list[str]:
    """Piece of each id, for the id-to-piece join. Its size is the vocabulary's, a few MB at most."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size(with_added_tokens=True))]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and hashes of ids and of the decoded text, of every document.

    Null and empty texts, and texts of white space, have no ids. Ids, nulls and repeated rows stay as they are; further columns are not read; an empty table gives no rows. A text of any length is whole in the task that splits it; blocks are bounded by their words.
    Each distinct word meets the tokenizer once: blocks send their words to hash buckets, packed, and get ids back, to be joined with the word numbers of their documents.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # One shuffle carries both kinds of rows, by block and by bucket; both readers below share it.
    split = rows.mapInArrow(_split(path, bucket_count(input_bytes(docs))), SPLIT).repartition(shuffle_partitions(spark), "k")
    codes = split.sortWithinPartitions("k").mapInArrow(_encode(path), CODES)
    return split.groupBy("k").cogroup(codes.groupBy("k")).applyInArrow(_digest(piece_table(path)), DIGEST)
