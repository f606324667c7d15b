"""Operator 8: SimHash fingerprints, linked by bit-sliced comparison inside exact candidate blocks, and their components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialize, ship, small
from quillstone.llm.components import connected_components

SEED = 42
#: Fingerprints that a candidate block holds on average, at most; with more rows, longer keys in more tables are taken.
OCCUPANCY = 8
#: Lanes of one bit-sliced comparison. Larger blocks are cut into pairs of chunks.
LANES = 2048
#: Nodes of a block up to which all its near pairs are links, and shingles that a chunk holds where whole sets are compared.
WHOLE, CHUNK_SHINGLES = 32, 4_000_000
#: Near copies: bands and minima of a band's key (texts at similarity 0.8 share a band in 99.98 of 100 cases), and the bits by which prints may differ before their shingles are compared (5-word prints at 0.8 differ by 10 on average, 2.9 standard deviation: 24 are passed by one pair in a million).
BANDS, BAND_ROWS, COPY_RADIUS = 16, 4, 24


def shingle_hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """Hashes of the text's word shingles in order, repeats included; of fewer words, one of all; none without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z alone, cuts at \\x20 and \\x09-\\x0D
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(line[a:b], SEED) for a, b in zip(start, end[-n:].tolist(), strict=True)], np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[i : i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    return simhash(shingle_hashes(text, shingle))


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> list[int]:
    """A key for each band: the hash of `rows` minima of the shingles' hashes under odd multipliers. None without shingles."""
    import xxhash

    if not len(hashes):
        return []
    odd = np.random.default_rng(SEED).integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    least = np.min([np.multiply.outer(hashes[i : i + 4096], odd).min(0) for i in range(0, len(hashes), 4096)], axis=0)
    return [xxhash.xxh64_intdigest(least[i : i + rows].tobytes(), SEED) for i in range(0, bands * rows, rows)]


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, print) of every row; print holds the 64 bits as a signed long."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints(shingle), "doc_id long, print long")


def _add(counters: np.ndarray, carry: np.ndarray, radius: int) -> np.ndarray:
    """Add one bit to every lane's vertical counter by carry-save adders; the lanes whose count now exceeds the radius."""
    high = len(counters) - 1
    for j in range(high + 1):
        counters[j], carry = counters[j] ^ carry, counters[j] & carry
    above, same = np.zeros_like(carry), ~np.zeros_like(carry)
    for j in range(high, -1, -1):  # compared with the radius from the highest bit down
        if radius >> j & 1:
            same &= counters[j]
        else:
            above |= same & counters[j]
            same &= ~counters[j]
    return above


def near_lanes(planes: np.ndarray, prints: np.ndarray, valid: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs (row of prints, lane) at most `radius` bits apart.

    planes: 64 rows of bits, packed 64 lanes a word: plane b holds bit b of every lane. A print's differences from all lanes in bit b are plane b, negated if its bit is set.
    Counter j holds bit j of every lane's count. Lanes whose count passed the radius stay marked as over, and a print's comparison is abandoned once all lanes are over.
    """
    counters = np.zeros((int(radius).bit_length() + 1, len(prints), planes.shape[1]), np.uint64)
    over = np.broadcast_to(~valid, counters.shape[1:]).copy()
    live = np.arange(len(prints))
    for b in range(64):
        flip = np.where((prints[live] >> np.uint64(b)) & np.uint64(1), ~np.uint64(0), np.uint64(0))[:, None]
        over[live] |= _add(counters, planes[b][None, :] ^ flip, radius)
        if b % 8 == 7:
            keep = ~np.all(over[live] == ~np.uint64(0), axis=1)
            if not keep.all():
                live = live[keep]
                counters = counters[:, keep]
                if not len(live):
                    return []
    bits = np.unpackbits((~over[live]).view(np.uint8).reshape(len(live), -1), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return list(zip(live[row].tolist(), lane.tolist(), strict=True))


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Places i with left[i] and right[i] at most `radius` bits apart: lane i of both sides' bit planes. Words of 64 lanes are abandoned once all are over."""
    (planes, used), (others, _) = slice_bits(left), slice_bits(right)
    words = np.arange(planes.shape[1])
    over = ~used
    counters = np.zeros((int(radius).bit_length() + 1, len(words)), np.uint64)
    for b in range(64):
        over[words] |= _add(counters, planes[b][words] ^ others[b][words], radius)
        if b % 8 == 7:
            keep = over[words] != ~np.uint64(0)
            words, counters = words[keep], counters[:, keep]
            if not len(words):
                break
    return np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))


def slice_bits(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the prints, 64 lanes a word, and the lanes in use."""
    lanes = -(-len(prints) // 64) * 64
    bits = np.zeros((lanes, 64), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T, axis=1, bitorder="little").copy().view("<u8")
    used = np.zeros(lanes, np.uint8)
    used[: len(prints)] = 1
    return planes, np.packbits(used, bitorder="little").view("<u8").copy()


def _forest(a: np.ndarray, b: np.ndarray, bits: np.ndarray, nodes: int) -> np.ndarray:
    """Places of the edges that form a least spanning forest: whatever edges of up to some number of bits join, those of the forest with no more bits join too."""
    label = np.arange(nodes)
    out = []
    for value in np.unique(bits):
        now = np.flatnonzero(bits == value)
        now = now[label[a[now]] != label[b[now]]]
        if not len(now):
            continue
        parent = label.tolist()
        for i, x, y in zip(now.tolist(), a[now].tolist(), b[now].tolist(), strict=True):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[x] = y
                out.append(i)
        label = np.array(parent)
        while (label != (up := label[label])).any():
            label = up
    return np.array(out, np.int64)


def links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in left, places in right, or in left again) that join what is at most `radius` bits apart: all prints of left, or each of left with each of right. Of several ways to link the same prints, the nearest are returned that keep them joined."""
    other = left if right is None else right
    planes, used = slice_bits(other)
    shift = 0 if right is None else len(left)
    everyone = left if right is None else np.concatenate([left, right])
    a = b = np.empty(0, np.int64)
    for i in range(0, len(left), 256):
        found = np.array(near_lanes(planes, left[i : i + 256], used, radius), np.int64).reshape(-1, 2)
        a, b = np.concatenate([a, found[:, 0] + i]), np.concatenate([b, found[:, 1] + shift])
        kept = _forest(a, b, np.bitwise_count(everyone[a] ^ everyone[b]), len(everyone))
        a, b = a[kept], b[kept]
    # one end of a link between two sides may be either
    return (a, b) if right is None else (np.minimum(a, b), np.maximum(a, b) - shift)


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[list]]:
    """Runs of rows with the same first four columns, which may go on in the next batch; each as lists of the parts of the further columns. Lists come as lists of arrays."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
        edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [batch.num_rows]])
        values = []
        for i in range(4, 4 + columns):
            x = batch.column(i)
            values.append(np.split(x.flatten().to_numpy(), np.cumsum(x.value_lengths().to_numpy())[:-1]) if pa.types.is_list(x.type) else x.to_numpy())
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if (now := tuple(keys[:, a])) != key:
                if parts:
                    yield parts
                key, parts = now, [[] for _ in range(columns)]
            for held, x in zip(parts, values, strict=True):
                held.append([y.copy() for y in x[a:b]] if isinstance(x, list) else x[a:b].copy())
    if parts:
        yield parts


def _compare(radius: int, tell: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block. Small blocks share one comparison: their links are kept if the block is the same."""
        seen: set[tuple[int, int, bool]] = set()
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def small_blocks() -> Iterator[pa.RecordBatch]:
            """Blocks of few nodes, many at once: each lane compares a print with the one `shift` places before it in its block."""
            nonlocal pending, held
            if pending:
                block = np.concatenate([np.full(len(p), k) for k, (p, _) in enumerate(pending)])
                flat, node = (np.concatenate([p[i] for p in pending]) for i in range(2))
                for shift in range(1, max(len(p) for p, _ in pending)):
                    same = np.flatnonzero(block[shift:] == block[:-shift])
                    near = same[near_pairs(flat[same + shift], flat[same], radius)]
                    yield from emit(node[near + shift], node[near], False)
            pending, held = [], 0

        def emit(a: np.ndarray, b: np.ndarray, part: bool) -> Iterator[pa.RecordBatch]:
            pairs = {(x, y, part) for x, y in zip(np.maximum(a, b).tolist(), np.minimum(a, b).tolist(), strict=True) if x != y}
            fresh = [p for p in pairs if p not in seen]
            if len(seen) < 1_000_000:
                seen.update(fresh)
            if fresh:
                ends = np.array([p[:2] for p in fresh], np.int64)
                out = [pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array([part] * len(fresh))]
                yield pa.RecordBatch.from_arrays(out if tell else out[:2], names=["src", "dst", "part"] if tell else ["src", "dst"])

        for parts in _blocks(batches, 3):
            prints, node, side = (np.concatenate(p) for p in parts)
            prints = prints.view(np.uint64)
            if side.any():
                left, right = side == 1, side == 2
                a, b = links(prints[left], prints[right], radius)
                yield from emit(node[left][a], node[right][b], True)
            elif len(prints) > WHOLE:
                a, b = links(prints, None, radius)
                yield from emit(node[a], node[b], True)
            elif len(prints) > 1:
                pending.append((prints, node))
                held += len(prints)
                if held > 100_000:
                    yield from small_blocks()
        yield from small_blocks()

    return run


def key_tables(rows: int, radius: int, occupancy: int = OCCUPANCY) -> list[list[tuple[int, int]]]:
    """For each table the bit ranges (start, size) that form its keys.

    With the 64 bits cut into b ranges, prints at most `radius` bits apart agree in b - radius of them at least, so one table for each choice of b - radius ranges loses no link.
    b is the least that leaves `occupancy` prints a key on average.
    """
    for b in range(radius + 1, 65):
        cuts = [64 * i // b for i in range(b + 1)]
        if rows / 2 ** min(sum(cuts[i + 1] - cuts[i] for i in range(b - radius)), 62) <= occupancy or b == radius + 4:
            return [[(cuts[i], cuts[i + 1] - cuts[i]) for i in pick] for pick in combinations(range(b), b - radius)]
    raise AssertionError


def near_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links (src, dst) among the distinct values of prints.print that join all values at most `radius` bits apart. A block is the prints with the same key in a table."""
    parts = []
    for t, ranges in enumerate(key_tables(prints.count(), radius)):
        key = F.lit(0).cast("long")
        for start, size in ranges:
            key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned("print", start).bitwiseAND(F.lit((1 << size) - 1)), sum(s for a, s in ranges if a < start)))
        parts.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    return compare_blocks(prints.select("print", F.col("print").alias("node"), F.inline(F.array(*parts))), radius)


def _deal(keyed: DataFrame, full: DataFrame) -> DataFrame:
    """The rows of keyed for each pair of chunks (c, d) that they meet in; full has the number of chunks of each block (t, key)."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    placed = keyed.join(full, ["t", "key"]).withColumn("chunk", chunk)
    # chunk c meets the chunks d >= c as side 1 and the chunks d <= c as side 2; alone it is side 0
    meets = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda d: F.struct(F.least("chunk", d).alias("c"), F.greatest("chunk", d).alias("d"), F.when(d == F.col("chunk"), 0).when(F.col("chunk") < d, 1).otherwise(2).cast("tinyint").alias("side")),
    )
    dealt = placed.select(*keyed.columns, F.inline(meets))
    return dealt.select("t", "key", "c", "d", "print", "node", "side", *[c for c in keyed.columns if c not in ("t", "key", "print", "node")])


def _by_block(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(F.col("t"), F.col("key"), F.col("c"), F.col("d")).sortWithinPartitions("t", "key", "c", "d", "print", "node")


def compare_blocks(keyed: DataFrame, radius: int, tell: bool = False) -> DataFrame:
    """Links (src, dst) that join the nodes of each block (t, key) of keyed (print, node, t, key) with prints at most `radius` bits apart. tell adds part: whether a block gave the link in place of other near pairs.

    Blocks over LANES nodes are cut into chunks by a hash, and each pair of chunks is compared in a task of its own. Prints come in order, so that ties fall alike in every run.
    """
    full = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("chunks", F.ceil(F.col("n") / LANES).cast("int")).drop("n")
    ready = _by_block(_deal(keyed.select("t", "key", "print", "node"), full))
    ship(keyed.sparkSession)
    if tell:
        return ready.mapInArrow(_compare(radius, True), "src long, dst long, part boolean").groupBy("src", "dst").agg(F.max("part").alias("part"))
    return ready.mapInArrow(_compare(radius), "src long, dst long").distinct()


def similar_links(prints: np.ndarray, nodes: np.ndarray, sides: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> list[tuple[int, int]]:
    """Links that join all nodes whose sets share `similarity` of their members, among pairs at most `radius` bits apart: all of side 0, or each of side 1 with each of side 2.

    Pairs already joined, by their classes or by links before, are passed over; every other pair is measured, the nearest first.
    """
    right = np.flatnonzero(sides == 2) if sides.any() else np.arange(len(prints))
    left = np.flatnonzero(sides == 1) if sides.any() else right
    if not len(left) or not len(right):
        return []
    size = np.array([len(x) for x in sets])
    ends = np.cumsum(size)
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(places, ends[:-1])
    label = np.unique(classes, return_inverse=True)[1]
    has = np.zeros(len(values), bool)
    planes, used = slice_bits(prints[right])
    out = []
    for at in range(0, len(left), 256):
        found = np.array(near_lanes(planes, prints[left[at : at + 256]], used, radius), np.int64).reshape(-1, 2)
        row, lane = left[found[:, 0] + at], right[found[:, 1]]
        fits = (np.minimum(size[row], size[lane]) >= similarity * np.maximum(size[row], size[lane])) & (label[row] != label[lane])
        if not sides.any():
            fits &= lane < row
        row, lane = row[fits], lane[fits]
        order = np.lexsort((lane, np.bitwise_count(prints[row] ^ prints[lane]), row))
        row, lane = row[order], lane[order]
        cuts = np.flatnonzero(np.diff(row)) + 1
        for some, others in zip(np.split(row, cuts), np.split(lane, cuts), strict=True):
            if not len(some):
                continue
            i = some[0]
            has[ids[i]] = True
            for j in others.tolist():
                if label[i] != label[j]:
                    common = int(np.count_nonzero(has[ids[j]]))
                    if common >= similarity * int(size[i] + size[j] - common):
                        out.append((int(nodes[i]), int(nodes[j])))
                        label[label == label[j]] = label[i]
            has[ids[i]] = False
    return out


def _similar(radius: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, 5):
            prints, nodes, sides, classes = (np.concatenate(p) for p in parts[:4])
            found = similar_links(prints.view(np.uint64), nodes, sides, classes, [x for p in parts[4] for x in p], radius, similarity)
            if found:
                two = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], names=["src", "dst"])

    return run


def whole_links(pairs: DataFrame, links: DataFrame, sets: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Links (src, dst) with the same components as if every candidate pair had been measured, where pairs (src, dst, part) holds some in place of others and links those found similar.

    What links join is one class. Where a pair that stood for others failed, all prints that failed pairs reach from there are one block, in which every pair between classes is measured on the sets of shingles.
    """
    nodes = materialize(connected_components(links))
    done = nodes.select(F.col("node").alias("src"), F.col("root").alias("dst")).filter("src <> dst")
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("root").alias(f"{end}_class"))
    classed = pairs.join(of("src"), "src", "left").join(of("dst"), "dst", "left").select(F.coalesce("src_class", "src").alias("src"), F.coalesce("dst_class", "dst").alias("dst"), "part")
    failed = materialize(classed.filter("src <> dst").groupBy("src", "dst").agg(F.max("part").alias("part")))
    if failed.filter("part").isEmpty():
        return done
    groups = materialize(connected_components(failed.select("src", "dst")))
    group = groups.select(F.col("node").alias("class"), F.col("root").alias("key"))
    open_ = failed.filter("part").select(F.col("src").alias("class")).join(group, "class").select("key").distinct()
    held = sets.select("node", "print", F.size("shingles").alias("size")).join(nodes, "node", "left").select("node", "print", "size", F.coalesce("root", "node").alias("class"))
    placed = materialize(held.join(group, "class").join(open_, "key", "left_semi").select(F.lit(0).alias("t"), "key", "print", "node", "class", "size"))
    chunks = F.ceil(F.greatest(F.count("*") / LANES, F.sum("size") / CHUNK_SHINGLES)).cast("int")
    full = placed.groupBy("t", "key").agg(chunks.alias("chunks"))
    dealt = _deal(placed.drop("size"), full).join(sets.drop("print"), "node").select("t", "key", "c", "d", "print", "node", "side", "class", "shingles")
    more = _by_block(dealt).mapInArrow(_similar(radius, similarity), "src long, dst long")
    return materialize(done.unionByName(more))


def near_components(rows: DataFrame, links: DataFrame, by: str = "print") -> DataFrame:
    """Every row of rows (doc_id and the column `by`) with component_id, the smallest doc_id that links (src, dst) between values of `by` reach, and root, the component's smallest value. Rows with equal values are linked. Null doc_ids count in no minimum; a component of them alone has null."""
    classes = materialize(rows.groupBy(by).agg(F.min("doc_id").alias("first_id")))
    nodes = materialize(connected_components(links))
    named = nodes.join(classes, nodes["node"] == classes[by]).select(nodes["node"], "root", "first_id")
    lowest = named.groupBy("root").agg(F.min("first_id").alias("low"))
    labels = nodes.join(lowest, "root").select(F.col("node").alias(by), "low", "root")
    label = materialize(classes.join(labels, by, "left").select(by, F.coalesce("low", "first_id").alias("component_id"), F.coalesce("root", by).alias("root")))
    return rows.join(label, by)


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Null and empty texts have fingerprint zero and are linked like any other; texts shorter than a shingle are one shingle; repeated rows keep one row each; an empty table gives none.
    """
    prints = materialize(fingerprints(docs, shingle))
    out = near_components(prints, near_links(materialize(prints.select("print").distinct()), radius))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)]
            node = np.fromiter((xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets), np.uint64, len(sets)).view(np.int64)
            prints = np.fromiter(map(simhash, sets), np.uint64, len(sets)).view(np.int64)
            bands = [np.array(band_keys(x, BANDS, BAND_ROWS), np.uint64).view(np.int64) for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node), pa.array(prints), pa.array(bands, pa.list_(pa.int64()))], names=["key", "node", "print", "bands"])

    return run


def _shingle_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)).view(np.int64) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["node", "print", "shingles"])

    return run


def drop_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = COPY_RADIUS) -> DataFrame:
    """The rows of docs without near copies: texts that share at least `similarity` of their shingles (intersection by union) are linked, and of each component the row with the smallest doc_id stays, of rows with that same id the one with the smallest hash of its text.

    Texts with the same set of shingles are one node. Candidates are nodes with prints at most `radius` bits apart, compared bit-sliced in blocks of equal band keys; every candidate link is then held against the whole sets. Fingerprints are those of the distinct shingles.
    In a block of over 32 nodes the nearest links that join them are candidates, so links grow with the rows and not with their square. Where one of these fails, every pair of what it should have joined is measured (whole_links), so no pair of a block is left out.
    Rows that are equal in id and text leave one row; where an id occurs on texts of several components, each of these keeps its own row. Null ids come after all others. Null and empty texts are one group; texts shorter than a shingle are one shingle; texts of any length are compared whole; an empty table gives no rows. docs may have any further columns; they stay.
    Texts are shuffled by row keys alone, so no group of copies meets in one task.
    """
    ship(docs.sparkSession)
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_key"))
    keyed = keyed.withColumns({"known_id": F.coalesce("id", F.lit(0)), "no_id": F.col("id").isNull()})
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    # plain equalities, so that dropping repeated rows needs no shuffle after the join's
    same_row = (F.col("known_id") == F.coalesce("kept_id", F.lit(0))) & (F.col("no_id") == F.col("kept_id").isNull()) & (F.col("row_key") == F.col("kept_key"))

    texts = keyed.select(F.struct("id", "row_key").alias("key"), F.col("row.text").cast("string").alias("text"))
    sketches = texts.mapInArrow(_sketches(shingle), "key struct<id:long,row_key:long>, node long, print long, bands array<long>")
    base = materialize(sketches.select(F.col("key.id").alias("doc_id"), "key.row_key", "node", "print", "bands"))
    # print and bands follow from the node
    firsts = base.groupBy("node").agg(F.min(F.struct(order.alias("o"), "print", "bands")).alias("f"))
    classes = materialize(firsts.select("node", "f.print", F.col("f.o.doc_id").alias("kept_id"), F.col("f.o.row_key").alias("kept_key"), "f.bands"))
    pairs = materialize(compare_blocks(classes.select("node", "print", F.posexplode("bands").alias("t", "key")), radius, tell=True))

    asked = materialize(classes.join(pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), "node").select("node", "print", "kept_id", "kept_key"))
    held = keyed.join(small(asked), same_row).dropDuplicates(["node"]).select("node", "print", F.col("row.text").cast("string").alias("text"))
    sets = materialize(held.mapInArrow(_shingle_sets(shingle), "node long, print long, shingles array<long>"))
    one, two = sets.select(F.col("node").alias("src"), F.col("shingles").alias("a")), sets.select(F.col("node").alias("dst"), F.col("shingles").alias("b"))
    measured = pairs.join(one, "src").join(two, "dst").select("src", "dst", F.size("a").alias("n_a"), F.size("b").alias("n_b"), F.size(F.array_intersect("a", "b")).alias("common"))
    alike = measured.filter(F.col("common") >= F.lit(similarity) * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("src", "dst")
    joined = near_components(base.drop("bands", "print"), whole_links(pairs, alike, sets, radius, similarity), "node")

    best = joined.groupBy("root").agg(F.min(order).alias("o"))
    kept = materialize(best.select(F.col("o.doc_id").alias("kept_id"), F.col("o.row_key").alias("kept_key")).distinct())
    return keyed.join(kept, same_row, "left_semi").dropDuplicates(["known_id", "no_id", "row_key"]).select("row.*")
