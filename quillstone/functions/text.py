"""Text expressions: white space, words, cleaning, sections, windows, hashes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

#: Unicode white space, told the same way to Java and to RE2 regexes.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
WORD = r"[\p{L}\p{N}_]+"
#: A character that is neither white space nor a slash, so that a text with one has a word to embed.
NO_SPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}/]"
#: Lines of these forms are boilerplate.
BOILERPLATE = [
    r"\s*page\s+\d+(?:\s+of\s+\d+)?\s*",
    r"\s*confidential\s*",
    r"\s*draft\s*",
    r"\s*[-=]{3,}\s*",
    r"\s*document\s+title:\s*.*",
    r"\s*company\s+name:\s*.*",
]
NOT_BLANK = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
BOILERPLATE_RE = "(?i)^(?:" + "|".join(BOILERPLATE) + ")$"
HEADING = r"^#{1,6}[^\S\n]+[^\n]+$"
#: Embedding width, window size and overlap in words.
DIM, SIZE, OVERLAP = 768, 512, 100


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    """The text's words, as between white space."""
    return F.array_remove(F.split(text, WS), "")


def collapse(text: Column) -> Column:
    """All white space runs as one space, trimmed."""
    return F.array_join(words(text), " ")


def trim(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}|{WS}$", "")


def tokens(text: Column) -> Column:
    """Lower-case words of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def content_hash(text: Column) -> Column:
    return F.sha2(collapse(text), 256)


def document_id(file_hash: Column) -> Column:
    return F.concat(F.lit("doc_"), F.substring(file_hash, 1, 16))


def chunk_id(document: Column, number: Column) -> Column:
    return F.format_string("%s_c%04d", document, number)


def clean(text: Column) -> Column:
    """The text without boilerplate lines, with one blank line of each run, lines trimmed at the right, and the whole trimmed. Works inside the row."""
    lines = F.split(F.regexp_replace(text, "\r\n?|[\x0b\x0c\x1c-\x1e\u0085  ]", "\n"), "\n")
    kept = F.filter(lines, lambda x: ~x.rlike(BOILERPLATE_RE))
    blank = lambda x: ~x.rlike(NOT_BLANK)
    runs = let(kept, lambda k: F.filter(k, lambda x, i: ~(blank(x) & F.coalesce(blank(F.get(k, i - 1)), F.lit(False)))))
    return trim(F.array_join(F.transform(runs, lambda x: F.regexp_replace(x, f"{WS}$", "")), "\n"))


def sections(text: Column, keep_preamble: bool = False) -> Column:
    """array<struct<title, body>> of the Markdown sections, empty ones dropped; without any the whole text, titled Document. What stands before the first heading is dropped unless asked for."""
    parts = F.split(text, f"(?m)(?={HEADING})")
    titled = F.transform(
        parts,
        lambda p: F.struct(
            F.when(p.rlike(f"(?m)\\A{HEADING}"), trim(F.regexp_extract(p, r"\A#{1,6}[^\S\n]+([^\n]+)", 1))).otherwise(F.lit("Document") if keep_preamble else F.lit(None)).alias("title"),
            trim(F.when(p.rlike(f"(?m)\\A{HEADING}"), F.regexp_replace(p, r"\A[^\n]*\n?", "")).otherwise(p)).alias("body"),
        ),
    )
    some = F.filter(titled, lambda s: s["title"].isNotNull() & (s["body"] != ""))
    whole = F.array(F.struct(F.lit("Document").alias("title"), text.alias("body")))
    return let(some, lambda s: F.when(F.size(s) > 0, s).otherwise(whole))


def windows(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Overlapping windows of words, joined by spaces; an empty text is one empty window."""
    step = max(1, size - overlap)
    return let(words(text), lambda w: F.when(F.size(w) == 0, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)), lambda i: F.array_join(F.slice(w, i + 1, size), " "))))


def hash_values(text: Column) -> Column:
    """Each word's value in the hash embedding: the first 32 bits of its SHA-256, over the greatest such number."""
    parts = words(F.translate(text, "\n/", "  "))
    return F.transform(parts, lambda t: F.conv(F.substring(F.sha2(t, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0))


def hash_embedding(text: Column, dim: int = DIM) -> Column:
    """The leading min(words, dim) values of the hash embedding; all further ones are zero. The i-th word adds to value i mod dim."""
    return let(
        hash_values(text),
        lambda v: F.when(F.size(v) == 0, F.array().cast("array<double>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.least(F.size(v), F.lit(dim)) - 1), lambda d: F.round(F.aggregate(F.sequence(d, F.size(v) - 1, F.lit(dim)), F.lit(0.0), lambda a, i: a + F.get(v, i)), 6))
        ),
    )


#: Words whose values a Python worker remembers.
CACHE_WORDS = 500_000


class _Values(dict):
    """A word's value, hashed when first asked for."""

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = int(hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) / 4294967295.0
        return found


_VALUES = _Values()


def pieces_of(texts: pa.Array, words: Callable[[list[str]], list[list[str]]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """What the texts hold between white space, cut further by `words`, which sees each piece once however often it stands there: where each text ends (from 0) in the next array, the number of each word, and the words by number, of which some may be equal."""
    pieces = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = pieces.flatten().dictionary_encode()
    found = words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    has = np.fromiter(map(len, found), np.int64, len(found))
    piece = coded.indices.to_numpy()
    many = has[piece]
    ends = np.append(0, np.cumsum(many))
    number = np.repeat((np.cumsum(has) - has)[piece] - ends[:-1], many) + np.arange(ends[-1])
    return ends[np.append(0, np.cumsum(pc.list_value_length(pieces).to_numpy()))], number, list(chain.from_iterable(found))


def vectors_of(texts: pa.Array) -> pa.Array:
    """hash_embedding of each text."""
    edges, number, found = pieces_of(texts, lambda pieces: [x.replace("/", " ").split() if "/" in x or not x else (x,) for x in pieces])
    words = np.fromiter(map(_VALUES.__getitem__, found), float, len(found))[number]
    rounded = lambda v: np.floor(np.abs(v) * 1e6 + 0.5) / 1e6  # noqa: E731  half up, as Spark and SQL round
    sizes = np.diff(edges)
    if len(sizes) and sizes.max() > DIM:
        parts = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            total = words[a : a + DIM].copy()
            for i in range(a + DIM, b, DIM):  # in order, as the expression adds them up
                total[: b - i] += words[i : min(i + DIM, b)]
            parts.append(total[: b - a])
        words, edges = np.concatenate(parts), np.append(0, np.cumsum(np.minimum(sizes, DIM)))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(rounded(words), pa.float64()))


@F.pandas_udf(ArrayType(DoubleType()))
def hash_vectors(text: pd.Series) -> pd.Series:
    """hash_embedding for whole tables, a batch of texts at once; a worker hashes each word once. Nested expressions take some 60 times as long there, as Spark interprets them."""
    found = vectors_of(pa.array(text, pa.string(), from_pandas=True))
    values, edges = found.values.to_numpy(), found.offsets.to_numpy()
    return pd.Series([values[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], text.index, dtype=object)


def fused_dot(a: Iterable[float], b: Iterable[float]) -> float:
    """The inner product of what both have, added up in order by fused multiply-adds. DuckDB's list_inner_product rounds so too; rounding otherwise parts scores that are equal there, or joins others, as among texts of one repeated word."""
    out = 0.0
    for x, y in zip(a, b):  # noqa: B905
        out = math.fma(x, y, out)
    return out


def norm(values: list[float]) -> float:
    return math.sqrt(fused_dot(values, values))


def fit(vector: Column, dim: int = DIM) -> Column:
    """The vector cut or padded with zeros to dim."""
    return F.slice(F.concat(F.coalesce(vector, F.array().cast("array<double>")), F.array_repeat(F.lit(0.0), dim)), 1, dim)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, the shorter padded with zeros; 0 if either is zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))))
    norm = lambda x: F.sqrt(total(F.transform(x, lambda v: v * v)))
    length = norm(a) * norm(b)
    return F.when(length > 0, dot / length).otherwise(F.lit(0.0))
