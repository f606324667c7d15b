"""Operator 1: order-preserving packing of documents into sequences by dynamic programming over cut places."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import ship
from quillstone.llm.tokens import encoder, slices, tokenizer_path

CAPACITY = 1024
#: Costs in units of one padding id: cutting a document after a sentence, cutting it elsewhere, beginning a sequence.
SENTENCE_CUT, WORD_CUT, SEQUENCE = 6.0, 24.0, 16.0
#: Ids that a task packs at once; the last sequence of each such block is padded.
BLOCK_IDS = 2_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def padding(length: int, capacity: int = CAPACITY) -> int:
    """Ids that pad a sequence: none at a power of two, else up to the capacity."""
    return 0 if length & (length - 1) == 0 else capacity - length


def choose_cuts(places: np.ndarray, is_doc: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Ends of the cheapest sequences over ids 0 to places[-1].

    places: ascending allowed cuts; is_doc: those at document ends, which are free. Best cost of a sequence ending at p: min over cuts i with p - i <= capacity of
    cost(i) + i, plus SEQUENCE + capacity - p + the cut's own cost. A monotone queue holds that sliding minimum of cost + place. While its front stays, all places that the front
    reaches have the same minimum, so they are settled as one run, and only the last document end and the last sentence end of a run can be of use later.
    A front that falls behind offers one more cut, at its place + capacity: a full sequence cut inside a sentence. A cut elsewhere in a sentence is never cheaper, as each id
    that it moves towards that place is padding saved. (Unpadded lengths below the capacity count here as padded.)
    """
    where = places.tolist()
    ends = is_doc.tolist()
    last_doc = np.maximum.accumulate(np.where(is_doc, np.arange(len(places)), -1)).tolist()
    n, done = len(where), 0
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # cost + place, place, node
    at, back = [0], [-1]  # nodes that may be cut at
    final = 0

    def push(value: float, place: int, origin: int) -> None:
        while queue and queue[-1][0] >= value:
            queue.pop()
        at.append(place)
        back.append(origin)
        queue.append((value, place, len(at) - 1))

    while done < n:
        value, i, k = queue[0]
        reach = bisect_right(where, i + capacity, done)
        if reach > done:
            doc = last_doc[reach - 1]
            if doc >= done:
                push(value + SEQUENCE + capacity, where[doc], k)
            if not ends[reach - 1]:
                push(value + SEQUENCE + capacity + SENTENCE_CUT, where[reach - 1], k)
            done = reach
            final = len(at) - 1
        if done < n and queue[0][2] == k:
            queue.popleft()
            push(value + SEQUENCE + capacity + WORD_CUT, i + capacity, k)
    out = []
    while final > 0:
        out.append(at[final])
        final = back[final]
    return np.array(out[::-1], np.int64)


def pack_block(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray, blank: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Pieces of documents in order: `ids` are theirs end to end (little-endian 32-bit, each document with its closing id), `sizes` how many each has."""
    stop = np.cumsum(sizes)
    sentence = ends[ids[:-1]] & ~blank[ids[1:]]
    cuts = np.flatnonzero(sentence) + 1
    is_doc = np.zeros(len(ids) + 1, bool)
    is_doc[stop] = True
    cuts = cuts[~is_doc[cuts]]
    places = np.concatenate([cuts, stop])
    order = np.argsort(places, kind="stable")
    sequences = choose_cuts(places[order], (np.arange(len(places)) >= len(cuts))[order], capacity)
    edges = np.union1d(sequences, stop)
    start = np.concatenate([[0], edges[:-1]])
    doc = np.searchsorted(stop, start, "right")
    seq = np.searchsorted(sequences, start, "right")
    view = memoryview(ids.tobytes())
    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(start.tolist(), edges.tolist(), strict=True)]
    return {"doc": doc, "start": start - (stop - sizes)[doc], "length": edges - start, "crc": np.array(crc, np.int64), "doc_tokens": sizes[doc], "seq": seq, "offset": start - np.concatenate([[0], sequences])[seq], "n": len(sequences)}


def _packer(ranks: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        first = TaskContext.get().partitionId() << 36
        parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal parts, held, first
            ids, sizes = (np.concatenate([p[i] for p in parts]) for i in range(2))
            p = pack_block(ids, sizes, enc.ends, enc.blank, capacity)
            long = lambda x: pa.array(x, pa.int64())
            keys = pa.concat_arrays([p[2] for p in parts])
            out = [keys.take(pa.array(p["doc"])), long(p["start"]), long(p["length"]), long(p["crc"]), long(p["doc_tokens"]), long(p["seq"] + first), long(p["offset"])]
            first += p["n"]
            parts, held = [], 0
            return pa.RecordBatch.from_arrays(out, names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            for some in slices(batch):
                parts.append((*enc.encode_documents(some.column(1), 0), some.column(0)))
                held += len(parts[-1][0])
                if held >= BLOCK_IDS:
                    yield flush()
        if parts:
            yield flush()

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, ranks: str | None = None) -> DataFrame:
    """Pack all documents, in stored order, into sequences of at most `capacity` ids: a row for each piece of a document.

    Each task packs the rows of its own input split, so no text is shuffled; a sequence never spans two splits. A sequence id holds the split in its upper bits.
    Sequences are cut at document ends (free), after sentences, or else, when that pads less than it costs, at full length anywhere. Null and empty texts give the closing id 0 alone;
    a null doc_id stays null; repeated rows are packed once each; a document of any length is cut into as many pieces as needed. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    ranks = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_packer(ranks, capacity), PIECES)
