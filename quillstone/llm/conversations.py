"""Operator 11: conversation structure repair. A conversation is a string of role and fault symbols; strings that end alike share the nodes of one automaton, built from the end, and each node has its cost to go and best edits once for each state of the grammar."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialize, ship, shuffle_partitions

#: Costs of the edits: Keep, Rerole, Delete, Insert, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the grammar s?(ua)+ or nothing: start, after system, after user, after assistant. By state: where the one turn of user or assistant that may follow leads, and that turn's role.
TURN, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEVER = 1 << 50
#: A conversation is cut into blocks of rows that lie in one run of so many places (a power of two); most are one block.
BLOCK_BITS = 10
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that are left after damage by crc32(`conv_id:turn`) % 20; nulls in the key, role and text count as one space."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    held = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(one("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return held.drop("copy")


def _keyed(rows: DataFrame, *more: str) -> DataFrame:
    """rows with `print`, which tells role and text together and is what the order goes by last, and `end`, the last character that isn't blank."""
    text_key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return rows.select("conv_id", "turn", "role", text_key.alias("print"), F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).alias("end"), *more)


def symbols(rows: DataFrame) -> DataFrame:
    """A row for each of rows (conv_id, turn, role, text), without text: place (rows of a conversation in order), initial, turn, fault and symbol.

    Order: by turn, nulls first, then role, then print. Rows are dealt by ranges of that order, so a long conversation is spread over tasks. A symbol is d where the row must go, else the role's initial (x if not s, u or a), upper case if the text is truncated.
    """
    order = ["conv_id", "turn", "role", "print"]
    n = shuffle_partitions(rows.sparkSession)
    placed = materialize(_keyed(rows).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    # the first row of each text by its place, which is unique, so no key of this join is hot
    first = placed.filter("end <> ''").groupBy("conv_id", "print").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    told = placed.join(first, "place", "left")
    fault = F.when(F.col("end") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated")
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    out = told.select("conv_id", "turn", "place", initial.alias("initial"), fault.alias("fault"), known.alias("known"))
    return out.withColumn("symbol", F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper("known")).otherwise(F.col("known"))).drop("known")


def _let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _illegal(before: Column, after: Column) -> Column:
    return ~F.coalesce(F.concat(before, after).isin("su", "ua", "au"), F.lit(False))


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of symbols(): conv_id, block, signature (the symbols in order) and the counts and borders that add up to the conversation's. A block has at most 2 ** BLOCK_BITS rows."""
    row = F.struct("place", "symbol", "initial", "turn")
    held = rows.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("r"), *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    wrong = _let(F.transform("r", lambda x: x["initial"]), lambda i: F.size(F.filter(F.transform(i, lambda x, k: (k > 0) & _illegal(F.get(i, k - 1), x)), lambda x: x)))
    turns = F.filter(F.transform("r", lambda x: x["turn"]), lambda x: x.isNotNull())
    return held.select(
        "conv_id", "block", F.array_join(F.transform("r", lambda x: x["symbol"]), "").alias("signature"), "blank", "duplicate", "truncated", wrong.cast("long").alias("illegal"),
        F.get("r.initial", F.lit(0)).alias("first"), F.element_at("r.initial", -1).alias("last"), F.array_min(turns).alias("low"), F.array_max(turns).alias("high"), F.size(F.array_distinct(turns)).alias("turns"),
    )


def summaries(held: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, n_blocks, and the first block and its signature. A conversation's blocks come together as borders only: a thousandth of its rows."""
    border = F.struct("block", "first", "last", "low", "high", "turns")
    out = held.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(border)).alias("b"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.count("*").alias("n_blocks"), F.min("block").alias("block"), F.min_by("signature", "block").alias("signature"),
    )
    before = lambda k: F.get(F.col("b"), k - 1)
    cuts = F.size(F.filter("b", lambda x, k: (k > 0) & _illegal(before(k)["last"], x["first"])))
    # rows are in order of turns, so neighbouring blocks share one turn at most
    shared = F.size(F.filter("b", lambda x, k: (k > 0) & F.coalesce(before(k)["high"] == x["low"], F.lit(False))))
    distinct = F.aggregate("b", F.lit(0).cast("long"), lambda s, x: s + x["turns"]) - shared
    wide = F.array_max("b.high").cast("decimal(20,0)") - F.array_min("b.low").cast("decimal(20,0)") + 1 - distinct
    return out.select("conv_id", F.coalesce(wide.try_cast("long"), F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + cuts).alias("illegal"), "n_blocks", "block", "signature")


# The automaton

#: What a node knows for a state: cost to go, best edits to the end, state in which they end.
Node = list[tuple[int, str, int]]
END: Node = [(0, "", 0), (2 * INSERT, "II", 3), (INSERT, "I", 3), (0, "", 3)]


def border(costs: list[int] | None) -> Node:
    """The node before the first symbol from the end: the conversation's end, or a cut after which each state costs so much."""
    return END if costs is None else [(c, "", g) for g, c in enumerate(costs)]


def node(symbol: str, after: Node) -> Node:
    """The node of symbol and what follows it. Edits of equal cost differ in their first letter, so the least letter gives the ASCII-least edits."""
    role, late = symbol.lower(), TRUNCATED * symbol.isupper()
    best = []
    for g in range(4):
        options = [(DELETE + after[g][0], "D", after[g])]
        if symbol != "d":
            kept = NEXT.get((g, role))
            if kept is not None:
                options.append((KEEP + late + after[kept][0], "K", after[kept]))
            options.append((REROLE + late + after[TURN[g]][0], "R", after[TURN[g]]))
        best.append(min(options, key=lambda o: o[:2]))
    costs = [o[0] for o in best]
    for _ in range(3):  # an insertion leads on along start, user, assistant, user
        costs = [min(c, INSERT + costs[TURN[g]]) for g, c in enumerate(costs)]
    out: Node = [(0, "", 0)] * 4
    for g in sorted(range(4), key=costs.__getitem__):  # an insertion's target is cheaper, so it is there
        c, letter, to = best[g]
        if INSERT + costs[TURN[g]] == costs[g] and (c > costs[g] or letter > "I"):
            letter, to = "I", out[TURN[g]]
        out[g] = (min(costs[g], NEVER), letter + to[1] if costs[g] < NEVER else "", to[2])
    return out


class Suffixes:
    """The automaton's nodes on the path to the last signature. Signatures in order of their reverses meet each node once: those that end alike follow one another."""

    def __init__(self) -> None:
        self.costs: object = count()
        self.path: str = ""
        self.nodes: list[Node] = []
        self.made = 0

    def look_up(self, backwards: str, costs: list[int] | None) -> Node:
        if not self.nodes or costs != self.costs:
            self.costs, self.path, self.nodes = costs, "", [border(costs)]
        shared = 0
        for a, b in zip(self.path, backwards):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            self.nodes.append(node(symbol, self.nodes[-1]))
            self.made += 1
        self.path = backwards
        return self.nodes[-1]


_WALKED = "costs array<long>, audits array<string>, ends array<int>"


def walk(rows: DataFrame) -> DataFrame:
    """rows (signature, after: costs by state of what follows the signature, null at a conversation's end, and any more columns) with costs to go, best edits and last state by the state in front.

    Rows are dealt by ranges of the reversed signatures, ties by conv_id and block, so that a task meets signatures that end alike together, makes each node once, and no signature is a hot one.
    """
    ship(rows.sparkSession)
    order = ["after", "_back", "conv_id", "block"]
    dealt = rows.withColumn("_back", F.reverse("signature")).repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Suffixes()
        for b in batches:
            found = [automaton.look_up(s, c) for s, c in zip(b.column("_back").to_pylist(), b.column("after").to_pylist())]
            made = [pa.array([[s[k] for s in n] for n in found], t) for k, t in enumerate((pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())))]
            out = b.drop_columns("_back")
            yield pa.RecordBatch.from_arrays([*out.columns, *made], names=[*out.schema.names, "costs", "audits", "ends"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), _WALKED])
    return dealt.mapInArrow(run, schema)


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's blocks (block, state after it, costs by state before it), last to first: for each block the costs by state of what follows it, less `base`, so that they stay small; and the whole cost."""
    for b in batches:
        out = []
        for conv, parts in zip(b.column("conv_id").to_pylist(), b.column("parts").to_pylist()):
            by: dict[int, dict[int, list[int]]] = {}
            for p in parts:
                by.setdefault(p["block"], {})[p["state"]] = p["costs"]
            after, base = None, 0
            for block in sorted(by, reverse=True):
                out.append((conv, block, after))
                options = by[block]
                costs = options[-1] if after is None else [min(options[e][g] + after[e] for e in range(4)) for g in range(4)]
                base += min(costs) if block != min(by) else costs[0]
                after = [min(c - min(costs), NEVER) for c in costs]
            # the last one written is the first block: it alone has the whole cost
            out[-1] = (*out[-1], base)
        rows = [r if len(r) == 4 else (*r, None) for r in out]
        yield pa.RecordBatch.from_pylist([{"conv_id": c, "block": k, "after": a, "total": t} for c, k, a, t in rows], schema=pa.schema([("conv_id", b.schema.field("conv_id").type), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("total", pa.int64())]))


def _joined_audits(parts: list[dict]) -> str:
    state, out = 0, []
    for p in sorted(parts, key=lambda p: p["block"]):
        out.append(p["audits"][state])
        state = p["ends"][state]
    return "".join(out)


def _long_conversations(held: DataFrame) -> DataFrame:
    """conv_id, cost, audit of conversations of several blocks (conv_id, block, signature, last).

    A block is walked for each state after it; the costs are then carried from the last block to the first, and each block is walked again with what follows it. No task gets more of a conversation than its blocks' costs and edits.
    """
    id_type = held.schema["conv_id"].dataType.simpleString()
    unit = F.transform(F.array(*map(F.lit, range(4))), lambda g: F.when(g == F.col("state"), F.lit(0).cast("long")).otherwise(F.lit(NEVER)))
    asked = held.withColumn("state", F.explode(F.when(F.col("last"), F.array(F.lit(-1))).otherwise(F.array(*map(F.lit, range(4)))))).withColumn("after", F.when(F.col("state") >= 0, unit))
    costs = walk(asked).groupBy("conv_id").agg(F.collect_list(F.struct("block", "state", "costs")).alias("parts"))
    carried = materialize(costs.mapInArrow(_carry, f"conv_id {id_type}, block long, after array<long>, total long"))
    same = F.col("h.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("h.block") == F.col("c.block"))
    edits = walk(held.alias("h").join(carried.alias("c"), same).select("h.conv_id", "h.block", "h.signature", "c.after", "c.total"))
    whole = edits.groupBy("conv_id").agg(F.max("total").alias("cost"), F.collect_list(F.struct("block", "audits", "ends")).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            audits = pa.array([_joined_audits(p) for p in b.column("parts").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("cost"), audits], names=["conv_id", "cost", "audit"])

    return whole.mapInArrow(join, f"conv_id {id_type}, cost long, audit string")


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of rows (conv_id, turn, role, text)."""
    held = materialize(blocks(symbols(rows)))
    whole = materialize(summaries(held))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    nothing = F.lit(None).cast("array<long>").alias("after")
    # the state in front is the start
    at_start = lambda df: df.select("conv_id", *counts, F.get("costs", F.lit(0)).alias("cost"), F.get("audits", F.lit(0)).alias("audit"))
    out = at_start(walk(whole.filter("n_blocks = 1").select("conv_id", *counts, "block", "signature", nothing)))
    long = whole.filter("n_blocks > 1")
    if long.isEmpty():
        return out
    ends = materialize(held.join(long.select(F.col("conv_id").alias("_c")), F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").select("conv_id", "block", "signature"))
    tail = ends.groupBy("conv_id").agg(F.max("block").alias("tail")).select(F.col("conv_id").alias("_c"), "tail")
    parts = ends.join(tail, F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", "block", "signature", (F.col("block") == F.col("tail")).alias("last"))
    found = _long_conversations(parts).select(F.col("conv_id").alias("_c"), "cost", "audit")
    return out.unionByName(long.join(found, F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", *counts, "cost", "audit"))


class _Hash:
    """The repaired text's SHA-256, fed row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.sha, self.lines = audit, 0, 0, hashlib.sha256(), 0

    def _line(self, role: str, text: bytes) -> None:
        self.sha.update((b"\n" if self.lines else b"") + role.encode() + b":")
        self.sha.update(text)
        self.lines += 1

    def insertions(self) -> None:
        while self.audit.startswith("I", self.at):
            self._line(ROLE[self.state], b"")
            self.state, self.at = TURN[self.state], self.at + 1

    def row(self, role: str, text: bytes) -> None:
        self.insertions()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "R":
            self._line(ROLE[self.state], text)
            self.state = TURN[self.state]
        elif letter == "K":
            self._line(role, text)
            self.state = NEXT[self.state, role[:1]]

    def digest(self) -> str:
        self.insertions()
        return self.sha.hexdigest()


_OUT = ["gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string"]


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conv_id of rows (conv_id, turn, role, text), after damage() of its rows.

    Null conv_ids are one conversation, null turns come first, null roles and texts are one space. Rows of one turn are in order of role, then of a hash of role and text; repeated rows are duplicates. A conversation without rows after damage has zeros, an empty audit and the hash of the empty string. Texts of any length are read whole; further columns don't matter; an empty table gives no rows.
    A conversation of any length is ranked, checked and repaired in blocks; only the hash of its repaired text, which can't be made in parts, is made by one task, which holds a batch of its rows at a time and its edits.
    """
    ship(rows.sparkSession)
    left = damage(rows.select("conv_id", "turn", "role", "text"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    found = repairs(left).select(F.col("conv_id").alias("_c"), *[x.split()[0] for x in _OUT])
    zero = [F.coalesce(x.split()[0], F.lit("") if x.endswith("string") else F.lit(0).cast("long")).alias(x.split()[0]) for x in _OUT]
    heads = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select("conv_id", *zero)
    # blank texts are never kept
    texts = _keyed(left, F.col("text")).select("conv_id", "turn", "role", "print", F.when(F.col("end") != "", F.col("text")).alias("text"))
    empty = lambda t: F.lit(None).cast(t)
    both = heads.select("conv_id", F.lit(0).alias("kind"), empty("long").alias("turn"), empty("string").alias("role"), empty("string").alias("print"), empty("string").alias("text"), F.struct(*[x.split()[0] for x in _OUT]).alias("head")).unionByName(
        texts.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "print", "text", empty(f"struct<{','.join(x.replace(' ', ':') for x in _OUT)}>").alias("head"))
    )
    dealt = both.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "print").select("conv_id", "kind", "role", "text", "head")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: tuple | None = None
        for b in batches:
            done = []
            heads = b.column("head")
            for i, (conv, kind, role, text) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("kind").to_pylist(), b.column("role").to_pylist(), b.column("text").cast(pa.binary()))):
                if not kind:
                    if open_:
                        done.append((*open_[:2], open_[2].digest()))
                    head = heads[i].as_py()
                    open_ = conv, head, _Hash(head["audit"])
                else:
                    open_[2].row(role, text.as_py() or b"")
            yield from pack(done, b.schema)
            schema = b.schema
        if open_:
            yield from pack([(*open_[:2], open_[2].digest())], schema)

    def pack(done: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if done:
            names = [x.split()[0] for x in _OUT]
            kinds = [pa.string() if x.endswith("string") else pa.int64() for x in _OUT]
            cols = [pa.array([h[n] for _, h, _ in done], k) for n, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in done], schema.field("conv_id").type), *cols, pa.array([d for _, _, d in done], pa.string())], names=["conv_id", *names, "repaired_sha256"])

    return dealt.mapInArrow(run, f"conv_id {id_type}, {', '.join(_OUT)}, repaired_sha256 string")
