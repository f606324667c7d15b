"""Operator 11 against a plain program that tries every edit."""

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from quillstone.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def fault(role, text, seen):
    if not text.strip(BLANK):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return None if text.strip(BLANK)[-1] in ".!?" else "truncated"


def best(initials, faults):
    """Cost and least edits by trying all of them, row by row, with the whole grammar checked at each step."""
    @lru_cache(None)
    def go(i, made):
        options = []
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", made):
            options.append((0, ""))
        if len(made) < 2 * len(initials) + 3:
            for x in "ua":
                if re.fullmatch("s?(ua)*u?", made + x):
                    c, e = go(i, made + x)
                    options.append((c + 2, "I" + e))
        if i < len(initials):
            c, e = go(i + 1, made)
            options.append((c + 3, "D" + e))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                for x, price, letter in [(initials[i], 0, "K"), ("u", 2, "R"), ("a", 2, "R")]:
                    if re.fullmatch("s?(ua)*u?", made + x) and len(x) == 1:
                        c, e = go(i + 1, made + x)
                        options.append((c + price + late, letter + e))
        return min(options, default=(10**6, "~"))

    return go(0, "")


def repaired(rows, audit):
    out, state = [], ""
    rows = iter(rows)
    for letter in audit:
        want = "assistant" if state.endswith("u") else "user"
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        role = role if letter == "K" else want
        state += role[:1]
        out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", state)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows, edits=best):
    """Rows (conv, turn, role, text) to the query's rows by conv."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in damaged([r for r in rows if r[0] == conv])]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in mine:
            faults.append(fault(role, text, seen))
            seen.add((role, text))
        initials = [r[1][:1] for r in mine]
        turns = [t for t, *_ in mine if t is not None]
        cost, audit = edits(tuple(initials), tuple(faults))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, repaired([r[1:] for r in mine], audit))
    return out


def found(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert df.columns == ["conv_id", *names]
    out = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def quick(initials, faults):
    """Cost and edits by the operator's nodes, for long conversations; `best` holds the nodes themselves."""
    at = C.END
    for i, f in reversed(list(zip(initials, faults))):
        at = C.node(symbol(i, f), at)
    return at[0][:2]


def symbol(initial, fault):
    if fault in ("blank", "duplicate"):
        return "d"
    known = initial if initial in tuple("sua") else "x"
    return known.upper() if fault == "truncated" else known


def test_every_short_conversation_gets_the_cheapest_edits():
    for n in range(5):
        for initials in product("suax", repeat=n):
            for faults in product([None, "truncated", "blank"], repeat=n) if n < 4 else [(None,) * 4, ("truncated", None, "blank", None)]:
                assert quick(initials, faults) == best(initials, faults), (initials, faults)


def test_signatures_that_end_alike_share_nodes():
    automaton = C.Suffixes()
    words = sorted(s[::-1] for s in ("suaua", "uaua", "Uaua", "xaua", "ua", "suaua", "dua"))
    for w in words:
        at = C.END
        for symbol in w:
            at = C.node(symbol, at)
        assert automaton.look_up(w, None) == at
    assert automaton.made == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert found(C.repair_conversations(df)) == expected(rows)


ODD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Yes"), (1, 2, "assistant", "Yes"), (1, 2, "assistant", "Another."), (1, 5, None, "x"), (1, None, "user", None), (1, None, None, " \t"),
    (None, 1, "user", "Who?"), (None, None, "assistant", "I."), (2, None, "tool", "Ran."), (2, None, "", "No role."), (3, 7, "user", "long words. " * 50_000), (3, 8, "assistant", "long words " * 50_000),
    (4, -5, "user", "A."), (4, 9, "User", "B."), (4, 9, "admin", "é."), (5, 3, "user", ""),
] + [(k, 0, "user", "Only one.") for k in range(100, 160)]


def test_odd_rows(spark):
    rows = [(*r, "k", "b", 1) for r in ODD]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, block string, place int")
    got = found(C.repair_conversations(df))
    assert got == expected(ODD)
    gone = [c for c in range(100, 160) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_empty_table(spark):
    assert C.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("bits", [1, 3])
def test_long_conversations_in_blocks(spark, monkeypatch, bits):
    """Blocks of two and eight rows, so that most conversations are cut, equal whole ones."""
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = [(c, t // (1 + c % 2), ["system", "user", "assistant", "user", "assistant", "tool"][(t * t + c * t) % 6], ["Fine.", "cut", "", f"Text {t}.", f"text {t}"][(t + c) % 5]) for c in range(12) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(C.repair_conversations(df)) == expected(rows, quick)
