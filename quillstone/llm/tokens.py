"""Token ids of the byte-level BPE vocabulary, a batch of texts at once; each distinct word is encoded once a worker."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a Python worker remembers; when full it starts anew, so memory is bounded at about 100 MB.
CACHE_WORDS = 500_000
#: Fresh words that are encoded in one call.
FRESH = 16_384
#: The id that ends a document in training sequences.
END_OF_TEXT = "<|endoftext|>"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch of (key, text) in runs of rows whose texts have about `size` bytes, so that what encoding them takes is bounded."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _plain(word: str) -> bool:
    """Whether the word holds no white space but a line feed at its start."""
    rest = word[1:] if word[:1] == "\n" else word
    return rest.split() == [rest]


class ByteEncoder:
    """The ids that the tokenizers library gives for byte_bpe_50k.json with add_special_tokens=False.

    `ranks` is the path of the same vocabulary as ranks. Byte-level BPE never joins what stands on both sides of a single space or line feed between two other
    characters, so a text whose white space is all of that kind is cut there and each distinct word is encoded once; all other texts are encoded whole.
    """

    def __init__(self, ranks: str, dtype: str = "<u4"):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.size = len(table) + 1
        self.dtype = np.dtype(dtype)
        self.all = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={END_OF_TEXT: len(table)})
        self.known: dict[str, bytes | None] = {}  # ids of a word after its space or with its line feed; none where a text with it is encoded whole
        self.sizes: dict[str, int] = {}  # as known, how many ids a word has; -1 for none
        self.ends = np.zeros(self.size, bool)  # ids that end a sentence or a line
        self.blank = np.zeros(self.size, bool)  # ids of white space alone
        self.first = np.zeros(self.size, bool)  # ids that begin with a space or a line feed
        for piece, i in table.items():
            self.ends[i] = piece[-1:] in (b".", b"!", b"?") or b"\n" in piece
            self.blank[i] = not piece.strip()
            self.first[i] = piece[:1] in (b" ", b"\n")

    def whole(self, text: str) -> bytes:
        """The text's ids, packed."""
        ids = self.all.encode(text, allowed_special="all") if END_OF_TEXT in text else self.all._core_bpe.encode_ordinary(text)
        return np.array(ids, self.dtype).tobytes()

    def _fresh(self, words: list[str], odd: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Fresh words encoded together, with their ids and where each word's begin; those that are not plain go to `odd`. Each begins with its space or line feed, which no other place of it holds, so ids that begin with one tell where words begin."""
        for i in range(0, len(words), FRESH):
            part = words[i : i + FRESH]
            rests = [w[1:] if w[:1] == "\n" else w for w in part]
            if " ".join(rests).split() != rests:
                odd += [w for w in part if not _plain(w)]
                part = [w for w in part if _plain(w)]
            if part:
                ids = np.array(self.all._core_bpe.encode_ordinary("".join([w if w[0] == "\n" else " " + w for w in part])), self.dtype)
                yield part, ids, np.flatnonzero(self.first[ids])

    def _learn(self, words: list[str]) -> None:
        known, odd = self.known, []
        for part, ids, at in self._fresh(words, odd):
            cuts, packed = (at * self.dtype.itemsize).tolist(), ids.tobytes()
            known.update(zip(part, (packed[a:b] for a, b in zip(cuts, [*cuts[1:], len(packed)], strict=True)), strict=True))
        known.update(dict.fromkeys(odd))

    def count_batch(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has. Of a word only their number is kept."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.empty(0, np.int64)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        edges = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        number = words.indices.to_numpy()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.sizes) > CACHE_WORDS:
            self.sizes.clear()
        known, odd = self.sizes, []
        for part, ids, at in self._fresh([w for w in distinct if w not in known], odd):
            known.update(zip(part, np.diff(at, append=len(ids)).tolist(), strict=True))
        known.update(dict.fromkeys(odd, -1))
        size = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        edges = edges - edges[0]
        count = size[number]
        odd_text = np.logical_or.reduceat(count < 0, edges[:-1]) | pc.match_substring(texts, END_OF_TEXT).to_numpy(zero_copy_only=False)
        count[edges[:-1]] = 0  # the first word has no space before it
        heads = [len(self.whole(t if o else t.split(" ", 1)[0].split("\n", 1)[0])) // self.dtype.itemsize for t, o in zip(texts.to_pylist(), odd_text.tolist(), strict=True)]
        return np.where(odd_text, 0, np.add.reduceat(count, edges[:-1])) + np.array(heads, np.int64)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts end to end, and how many each has. Null texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if not n:
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        edges = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        number = words.indices.to_numpy().astype(np.int64)
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self._learn([w for w in distinct if w not in self.known])
        ids_of = list(map(self.known.__getitem__, distinct))
        edges = edges - edges[0]
        # the first word has no space before it; other places of the texts that are encoded whole give nothing
        odd = np.fromiter((x is None for x in ids_of), bool, len(ids_of))
        odd_text = np.logical_or.reduceat(odd[number], edges[:-1]) | pc.match_substring(texts, END_OF_TEXT).to_numpy(zero_copy_only=False)
        heads = [self.whole(t if o else t.split(" ", 1)[0].split("\n", 1)[0]) for t, o in zip(texts.to_pylist(), odd_text.tolist(), strict=True)]
        number[np.repeat(odd_text, np.diff(edges))] = len(distinct)
        number[edges[:-1]] = len(distinct) + 1 + np.arange(n)
        table = [x or b"" for x in chain(ids_of, [b""], heads)]
        size = np.fromiter(map(len, table), np.int64, len(table)) // self.dtype.itemsize
        count = size[number]
        done = np.cumsum(count)
        counts = np.diff(np.concatenate([[0], done[edges[1:] - 1]]))
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(table), self.dtype)
        ids = flat[np.arange(done[-1]) + np.repeat(start[number] - (done - count), count)]
        return ids, counts

    def encode_documents(self, texts: pa.Array, close: int) -> tuple[np.ndarray, np.ndarray]:
        """As encode_batch, with the id `close` after each text."""
        ids, counts = self.encode_batch(texts)
        return np.insert(ids, np.cumsum(counts), close), counts + 1


_ENCODERS: dict[tuple, ByteEncoder] = {}


def encoder(ranks: str, dtype: str = "<u4") -> ByteEncoder:
    """One encoder a worker process and file."""
    if (ranks, dtype) not in _ENCODERS:
        _ENCODERS[ranks, dtype] = ByteEncoder(ranks, dtype)
    return _ENCODERS[ranks, dtype]
