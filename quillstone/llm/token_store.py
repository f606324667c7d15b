"""Operator 7: training-order token shards. A keyed Feistel permutation gives every sequence a global slot; slot ranges are written as fixed-stride shards."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import shared_dir, ship
from quillstone.llm.tokens import encoder, slices, tokenizer_path

#: Ids of a sequence, sequences of a shard (17 MB), and the permutation's key and rounds.
LENGTH, SHARD_ROWS, KEY, ROUNDS = 1024, 8192, 20240607, 6


def permute(index: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A bijection of 0 to size - 1: a balanced Feistel network over the least even number of bits that holds them; results outside walk on until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.array([(key * (2 * r + 1) + 0x9E3779B97F4A7C15 * (r + 1)) % 2**64 for r in range(rounds)], np.uint64)
    out = np.asarray(index, np.uint64).copy()
    live = np.arange(len(out))
    while len(live):
        left, right = out[live] >> np.uint64(half), out[live] & mask
        for k in keys:
            x = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask)
        out[live] = left << np.uint64(half) | right
        live = live[out[live] >= size]
    return out.astype(np.int64)


#: Bytes of text whose ids are counted at once.
COUNTED = 8_000_000


#: A record's fields before its ids, as hexadecimal digits (name, digits): slot, first_doc_id (0 if null), documents that have ids in it, ids that are no padding (plus NULL_DOC if first_doc_id is null), CRC-32 of the ids.
HEAD = [("slot", 16), ("first_doc_id", 16), ("n_docs", 8), ("n_ids", 8), ("crc", 8)]
HEAD_BYTES = 56
#: What ends a record, in UTF-8. It has a byte over 0xC4 at odd and at even places, and no 16-bit id below 50,258 has one as its upper byte, so it stands in no record; Spark's text reader splits files by it.
END = "\ufffd\ufffd"
NULL_DOC = 1 << 31
SEQUENCES = "shard int, slot long, record binary"
ROWS = "slot long, shard int, first_doc_id long, n_docs long, n_ids long, ids_crc32 long, payload binary"


def stride(length: int = LENGTH) -> int:
    """Bytes of a record with its end: row r of a shard file begins at byte r * stride."""
    return HEAD_BYTES + 2 * length + len(END.encode())


def _counts(ranks: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ids = encoder(ranks, "<u2"), 0
        for batch in batches:
            for some in slices(batch, COUNTED):
                ids += int(enc.count_batch(some.column(1)).sum()) + some.num_rows
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([-(-ids // length)], pa.int64())], names=["part", "n"])

    return run


def _records(slot: np.ndarray, ids: np.ndarray, first: np.ndarray, null: np.ndarray, docs: np.ndarray, used: np.ndarray) -> pa.Array:
    """Records of sequences (rows of ids), without their ends."""
    out = np.zeros(len(ids), np.dtype([("head", "u1", HEAD_BYTES), ("ids", "<u2", ids.shape[1])]))
    fields = np.zeros(len(ids), np.dtype([(name, f">i{digits // 2}") for name, digits in HEAD]).newbyteorder(">"))
    fields["slot"], fields["first_doc_id"], fields["n_docs"] = slot, first, docs
    fields["n_ids"] = (used + NULL_DOC * null).astype(np.uint32).view(np.int32)
    fields["crc"] = np.array([zlib.crc32(x) for x in ids], np.uint32).view(np.int32)
    out["head"] = np.frombuffer(fields.tobytes().hex().encode(), np.uint8).reshape(len(ids), HEAD_BYTES)
    out["ids"] = ids
    ends = np.arange(len(out) + 1, dtype=np.int32) * out.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _sequences(ranks: str, length: int, shard_rows: int, key: int, total: int, by_split: Broadcast):
    """by_split: splits in order, how many sequences each has, and by shard whether it is still to be written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The split's documents, each with a closing id, end to end, cut at every `length` ids. The last sequence is padded with the closing id."""
        enc = encoder(ranks, "<u2")
        parts, numbers, wanted = by_split.value
        at = np.searchsorted(parts, TaskContext.get().partitionId())
        mine = int(numbers[at]) if at < len(parts) and parts[at] == TaskContext.get().partitionId() else 0
        place, offset = 0, int(numbers[:at].sum())
        ids, sizes = np.empty(0, np.uint16), np.empty(0, np.int64)
        keys: list[int | None] = []

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, sizes, keys, place
            n = -(-len(ids) // length) if last else len(ids) // length
            stop = np.cumsum(sizes)
            for a in range(0, n, 1024):
                at = np.arange(a, min(a + 1024, n)) * length
                rows = ids[at[0] : at[-1] + length]
                used = np.minimum(len(ids) - at, length)
                rows = np.concatenate([rows, np.full(len(at) * length - len(rows), enc.size - 1, np.uint16)]).reshape(-1, length)
                doc = np.searchsorted(stop, at, "right")
                first = [keys[d] for d in doc.tolist()]
                null = np.array([k is None for k in first])
                docs = np.searchsorted(stop, at + used - 1, "right") - doc + 1
                if place + len(at) > mine:
                    raise ValueError("docs changed between counting and writing")
                slot = permute(offset + place + np.arange(len(at)), total, key)
                place += len(at)
                doc_id, shard = np.array([k or 0 for k in first]), (slot // shard_rows).astype(np.int32)
                if not (live := wanted[shard]).all():
                    slot, rows, doc_id, null, docs, used, shard = (x[live] for x in (slot, rows, doc_id, null, docs, used, shard))
                if len(slot):
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(slot), _records(slot, rows, doc_id, null, docs, used)], names=["shard", "slot", "record"])
            rest = n * length
            whole = int(np.searchsorted(stop, rest, "right"))  # documents without ids left
            if rest < len(ids):
                keys, sizes = keys[whole:], np.diff(stop[whole:], prepend=rest)
            else:
                keys, sizes = [], sizes[:0]
            ids = ids[rest:]

        for batch in batches:
            for some in slices(batch):
                more, counts = enc.encode_documents(some.column(1), enc.size - 1)
                ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, counts])
                keys += some.column(0).to_pylist()
                yield from cut(False)
        yield from cut(True)
        if place != mine:
            raise ValueError("docs changed between counting and writing")

    return run


def _split_counts(rows: DataFrame, path: str, ranks: str, length: int, shard_rows: int, key: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Splits and how many sequences each has, and whether a job before has counted them: they are kept beside the shards with what else fixes the slots."""
    spark, counted = rows.sparkSession, f"{path}/_counts"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, there = at.getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: spark._jvm.org.apache.hadoop.fs.Path(at, name)
    begun = fs.exists(there("_counts/_SUCCESS"))
    how = {"length": length, "shard_rows": shard_rows, "key": key}
    if not begun:
        if fs.exists(at) and fs.globStatus(there("shard=*")):
            raise FileExistsError(f"{path} holds shards of unknown order")
        counts = rows.mapInArrow(_counts(ranks, length), "part int, n long")
        counts.select("*", *[F.lit(v).cast("long").alias(k) for k, v in how.items()]).write.mode("overwrite").parquet(counted)
    held = spark.read.schema("part int, n long, length long, shard_rows long, key long").parquet(counted).orderBy("part").collect()  # a row for each split
    if any(r[k] != v for r in held for k, v in how.items()):
        raise ValueError(f"{path} was begun with another length, shard size or key")
    return np.array([r["part"] for r in held], np.int64), np.array([r["n"] for r in held], np.int64), begun


def _unwritten(spark: SparkSession, path: str, total: int, length: int, shard_rows: int) -> np.ndarray:
    """By shard whether its file is missing. Only lengths are read."""
    wanted = np.ones(-(-total // shard_rows), bool)
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"/shard=(\d+)/[^/]*$", 1).try_cast("int").alias("shard"), "length")
    for r in files.groupBy("shard").agg(F.sum("length").alias("bytes")).filter(F.col("shard").isNotNull()).collect():  # a number for each shard
        if r["bytes"] != min(shard_rows, total - r["shard"] * shard_rows) * stride(length):
            raise ValueError(f"shard {r['shard']} below {path} has another size than this order gives it")
        wanted[r["shard"]] = False
    return wanted


def write_shards(docs: DataFrame, path: str, length: int = LENGTH, shard_rows: int = SHARD_ROWS, key: int = KEY, ranks: str | None = None) -> int:
    """Write all documents as sequences in training order below `path` and return how many sequences there are. Shard s is the one file below shard=s, of fixed-stride records: slot s * shard_rows + r
    begins at byte r * stride(length), so any slot is found without an index, and reading goes on from any slot.

    Documents stand end to end, each with a closing id, and null and empty texts give that id alone; repeated rows are kept; a null doc_id stays null; an empty table gives no files. Columns but doc_id and text are not read.
    The number of sequences fixes the permutation, so documents are encoded twice: once to count, once to write; the sequences themselves are written once. docs must give the same rows in the
    same splits both times, as tables on files do; else the slots don't fit and an error is raised. Each sequence goes to the task of its shard, whose size is fixed whatever the data. A shard whose
    task is lost is written anew. A shard's file is put in place once its task has ended, so a job that broke off goes on when it is started again with the same docs and path: what it counted is
    taken over, and only missing shards are shuffled and written. A finished path is left as it is; one begun with another length, shard size or key is an error.
    """
    spark = docs.sparkSession
    ship(spark)
    ranks = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts, numbers, begun = _split_counts(rows, path, ranks, length, shard_rows, key)
    total = int(numbers.sum())
    shards = -(-total // shard_rows)
    wanted = _unwritten(spark, path, total, length, shard_rows) if begun and total else np.ones(shards, bool)
    if not wanted.any():
        return total
    placed = rows.mapInArrow(_sequences(ranks, length, shard_rows, key, total, spark.sparkContext.broadcast((parts, numbers, wanted))), SEQUENCES)
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
    # Spark's text writer puts out a string's bytes as they are, with END after each; a task has one file, which this committer moves to its place when the task ends
    writer = ordered.select(F.col("record").cast("string"), "shard").write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("lineSep", END).partitionBy("shard").text(path)
    return total


def read_slots(spark: SparkSession, path: str, start: int = 0, stop: int = 2**62, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Sequences of slots start to stop - 1 (slot, shard, first_doc_id, n_docs, n_ids, ids_crc32, payload of little-endian 16-bit ids), in order inside each shard. Only the shards that hold them are read. A damaged record is an error.

    Spark's text reader splits large files at the records' ends and reads them record by record.
    """
    lines = spark.read.option("lineSep", END).text(path).filter(F.col("shard").between(start // shard_rows, max(start, stop - 1) // shard_rows))
    rows = lines.select("shard", F.col("value").cast("binary").alias("record"))
    head, payload = F.substring("record", 1, HEAD_BYTES).cast("string"), F.substring("record", HEAD_BYTES + 1, 2 * length)
    places = dict(zip([n for n, _ in HEAD], np.cumsum([1, *(d for _, d in HEAD)]).tolist(), strict=False))
    number = {name: F.conv(F.substring(head, places[name], digits), 16, -10).cast("long") for name, digits in HEAD}
    n_ids, slot = number["n_ids"], number["slot"]
    whole = (F.length("record") == HEAD_BYTES + 2 * length) & (F.crc32(payload) == number["crc"]) & (F.floor(slot / shard_rows) == F.col("shard"))
    crc = F.when(F.coalesce(whole, F.lit(False)), number["crc"]).otherwise(F.raise_error(F.concat(F.lit("damaged record in shard "), F.col("shard").cast("string"))).cast("long"))
    first = F.when(n_ids < NULL_DOC, number["first_doc_id"])
    out = rows.select(slot.alias("slot"), "shard", first.alias("first_doc_id"), number["n_docs"].alias("n_docs"), (n_ids % NULL_DOC).alias("n_ids"), crc.alias("ids_crc32"), payload.alias("payload"))
    return out.filter((F.col("slot") >= start) & (F.col("slot") < stop))


def store_documents(docs: DataFrame) -> DataFrame:
    """Write the shards into the shared folder and read them back; per sequence: slot, shard, first_doc_id, n_docs, n_ids and the ids' ids_crc32."""
    path = f"{shared_dir(docs.sparkSession)}/token-shards/{uuid.uuid4().hex}"
    if not write_shards(docs, path):
        return docs.sparkSession.createDataFrame([], ROWS).drop("payload")
    return read_slots(docs.sparkSession, path).drop("payload")
