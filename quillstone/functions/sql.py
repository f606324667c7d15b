"""The text kernel and access rules as functions of Spark SQL. They are SQL expressions that Spark puts into the plan of the caller, so nothing leaves the JVM but the hash embedding."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillstone.functions import access, text as T
from quillstone.session import ship


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"


_WS = _literal(T.WS)
_TRIM = f"regexp_replace(%s, {_literal(f'^{T.WS}|{T.WS}$')}, '')"
_BLANK = "not x rlike " + _literal(T.NOT_BLANK)
_LINES = f"filter(split(regexp_replace(t, {_literal(chr(13) + chr(10) + '?|[' + chr(11) + chr(12) + chr(28) + '-' + chr(30) + chr(0x85) + chr(0x2028) + chr(0x2029) + ']')}, '\\n'), '\\n'), x -> not x rlike {_literal(T.BOILERPLATE_RE)})"
_HEADED = f"x rlike {_literal(f'(?m){chr(92)}A{T.HEADING}')}"
_TITLE = _TRIM % ("regexp_extract(x, " + _literal(r"\A#{1,6}[^\S\n]+([^\n]+)") + ", 1)")
_BODY = _TRIM % ("regexp_replace(x, " + _literal(r"\A[^\n]*\n?") + ", '')")

#: Name, parameters, result and body of each function, those that others use first.
FUNCTIONS: list[tuple[str, str, str, str]] = [
    ("qs_words", "t string", "array<string>", f"array_remove(split(t, {_WS}), '')"),
    ("qs_tokens", "t string", "array<string>", f"regexp_extract_all(lower(t), {_literal(f'({T.WORD})')}, 1)"),
    ("qs_collapse", "t string", "string", "array_join(qs_words(t), ' ')"),
    ("qs_document_id", "t string", "string", "concat('doc_', substring(sha2(t, 256), 1, 16))"),
    ("qs_chunk_id", "document string, number int", "string", "format_string('%s_c%04d', document, number)"),
    ("qs_access_rank", "label string", "int", f"case label {' '.join(f'when {_literal(s)} then {i}' for i, s in enumerate(access.SENSITIVITY))} else 3 end"),
    ("qs_is_allowed", "label string, clearance string", "boolean", f"qs_access_rank(label) <= case when clearance in ({', '.join(map(_literal, access.SENSITIVITY))}) then qs_access_rank(clearance) else 0 end"),
    ("qs_clean", "t string", "string", _TRIM % f"array_join(transform(aggregate({_LINES}, cast(array() as array<string>), (a, x) -> if({_BLANK} and size(a) > 0 and coalesce(not element_at(a, -1) rlike {_literal(T.NOT_BLANK)}, false), a, array_append(a, x))), x -> regexp_replace(x, {_literal(T.WS + '$')}, '')), '\\n')"),
    ("qs_sections", "t string", "array<struct<title: string, body: string>>", f"case when size(filter(transform(split(t, {_literal(f'(?m)(?={T.HEADING})')}), x -> named_struct('title', if({_HEADED}, {_TITLE}, null), 'body', if({_HEADED}, {_BODY}, x))), s -> s.title is not null and s.body <> '')) > 0 "
     f"then filter(transform(split(t, {_literal(f'(?m)(?={T.HEADING})')}), x -> named_struct('title', if({_HEADED}, {_TITLE}, null), 'body', if({_HEADED}, {_BODY}, x))), s -> s.title is not null and s.body <> '') else array(named_struct('title', 'Document', 'body', t)) end"),
]

#: Table functions, for LATERAL.
TABLES: list[tuple[str, str, str, str]] = [
    ("qs_chunk_text", "t string, size int, overlap int", "window_no int, content string",
     "select pos, array_join(slice(w, cast(pos * greatest(1, size - overlap) as int) + 1, size), ' ') from (select qs_words(t) w) lateral view posexplode(sequence(0, greatest(size(w) - 1, 0), greatest(1, size - overlap))) as pos, start"),
]


def register(spark: SparkSession) -> None:
    """Make the functions known to this session, and qs_hash_embedding, which works on Arrow batches."""
    for name, given, result, body in FUNCTIONS:
        spark.sql(f"create or replace temporary function {name}({given}) returns {result} return {body}")
    for name, given, result, body in TABLES:
        spark.sql(f"create or replace temporary function {name}({given}) returns table ({result}) return {body}")
    ship(spark)
    spark.udf.register("qs_hash_embedding", T.hash_vectors)
