"""Operator 9: secret scans. One byte pass of a combined minimal automaton finds where matches of all rules end; anchored automata then walk from there to their starts and ends."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.automaton import Automaton
from quillstone.llm.common import ship


class Rule(NamedTuple):
    """A kind of secret. Every match of `pattern` holds one place, at the end of a match of `head`, from which `lead`, read backwards, reaches the match's start.

    `least` is the least size of the match, or, with group, of its last part, whose first character is the last one of the head. In a head, classes are open to the byte before the text.
    """

    kind: str
    pattern: str
    least: int
    group: bool
    fold: bool
    head: str
    lead: str


#: The three base kinds come first, in this order.
RULES = [
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+", 6, True, True, *[r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]"] * 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20, False, False, *["AKIA[A-Z0-9]"] * 2),
    Rule("hex", r"[0-9a-f]+", 24, False, False, r"[^0-9a-f][0-9a-f]{24}", r"[0-9a-f]+"),
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", 0, False, False, r"PRIVATE KEY-----", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 40, False, False, *[r"gh[opsur]_[A-Za-z0-9]"] * 2),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15, False, False, *[r"xox[abprs]-[A-Za-z0-9-]"] * 2),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39, False, False, *[r"AIza[A-Za-z0-9_-]"] * 2),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]+", 24, False, False, *[r"[rs]k_(?:live|test)_[A-Za-z0-9]"] * 2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, False, False, r"\.eyJ[A-Za-z0-9_-]", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]+", 20, True, True, *[r"bearer\x20+[A-Za-z0-9+/_.=-]"] * 2),
    Rule("url", r"[a-z][a-z0-9+.-]*://[^\x09-\x0d\x20/:@]+:[^\x09-\x0d\x20/:@]+@", 0, False, True, r"://[^\x00-\x20/@]+@", r"[a-z][a-z0-9+.-]*://[^\x09-\x0d\x20/:@]+:[^\x09-\x0d\x20/:@]+@"),
]
KINDS = [r.kind for r in RULES]
#: Bytes and texts that one call of the automaton scans at once.
SCAN_BYTES, SCAN_TEXTS = 16_000_000, 8_000


class _Compiled(NamedTuple):
    heads: Automaton
    leads: list[Automaton]
    wholes: list[Automaton]


_COMPILED: list[_Compiled] = []


def compiled() -> _Compiled:
    """The automata, compiled once a process: one that searches the heads of all rules, and for each rule one back from there and one onwards."""
    if not _COMPILED:
        leads = [Automaton([(r.lead, r.fold)], search=False, reverse=True) for r in RULES]
        wholes = [Automaton([(r.pattern, r.fold)], search=False) for r in RULES]
        _COMPILED.append(_Compiled(Automaton([(r.head, r.fold) for r in RULES]), leads, wholes))
    return _COMPILED[0]


def spans_of(text: bytes, hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes of all matches: leftmost, longest and non-overlapping in each rule; those that are too short go, but keep what they cover.

    A rule's bytes are walked from its hits alone, and none that an earlier match of it covers, so the work is in proportion to the text.
    """
    out = []
    free = [0] * len(RULES)
    _, leads, wholes = compiled()
    for at, rules in hits:
        while rules:
            k = (rules & -rules).bit_length() - 1
            rules &= rules - 1
            if at <= free[k]:
                continue
            start = leads[k].longest(text, at, free[k], -1)
            end = wholes[k].longest(text, start, len(text)) if start >= 0 else -1
            if end < 0:
                continue
            free[k] = end
            if end - (at - 1 if RULES[k].group else start) >= RULES[k].least:
                out.append((start, k, end))
    return sorted(out)


def scan_texts(texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """The spans of each text, (start, rule, end) in code points."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    out = []
    for t, b, hits in zip(texts, data, compiled().heads.scan(data), strict=True):
        spans = spans_of(b, hits) if hits else []
        if spans and len(b) != len(t):
            points = np.concatenate([[0], np.cumsum((np.frombuffer(b, np.uint8) & 0xC0) != 0x80)])
            spans = [(int(points[s]), k, int(points[e])) for s, k, e in spans]
        out.append(spans)
    return out


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each union of overlapping spans replaced by the name of its first kind in brackets."""
    out, at = [], 0
    for start, rule, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[rule]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and (size + len(t) > SCAN_BYTES or b - a >= SCAN_TEXTS):
            yield a, b
            a, size = b, 0
        size += len(t)
    if texts:
        yield a, len(texts)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        rows: list[tuple] = []
        for a, b in _parts(texts):
            for spans in scan_texts(texts[a:b]):
                count = [0] * 3
                for _, k, _ in spans:
                    if k < 3:
                        count[k] += 1
                say = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
                base = ",".join(x for x, (_, k, _) in zip(say, spans, strict=True) if k < 3)
                rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), ",".join(say)))
        n, c, h, d, s = zip(*rows, strict=True) if rows else ((), (), (), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, c, h)), pa.array(d, pa.string()), pa.array(s, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans) and spans (all).

    Null and empty texts have none. Ids, nulls and repeated rows stay as they are; further columns are not read; an empty table gives no rows. Texts of any length are read whole, in time
    that grows in proportion. Of matches of one kind that overlap the leftmost counts; spans of different kinds may overlap. No shuffle.
    """
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _redactor(place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            clean: list[str | None] = []
            for a, b in _parts([t or "" for t in texts]):
                clean += [None if t is None else redact(t, s) for t, s in zip(texts[a:b], scan_texts([t or "" for t in texts[a:b]]), strict=True)]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with every secret in `text` replaced by its kind in brackets; all rows and columns stay.

    Null texts stay null and empty ones empty; spans that overlap become one, named by the first; repeated rows stay; an empty table gives none; other columns may have any names.
    """
    ship(docs.sparkSession)
    return docs.mapInArrow(_redactor(docs.columns.index("text")), docs.schema)
