"""Folders of documents in any state, and places for models."""

import json
import re
from html.parser import HTMLParser

import pytest

from pyspark.sql import functions as F

from quillstone import plugins
from quillstone.functions import text as T
from quillstone.sources import files
from quillstone.sources.markdown import to_markdown

SCHEMA = "id long, name string, score double, tags array<string>"


def test_json_folder_lists_what_it_cannot_read(spark, tmp_path):
    whole = {"id": 1, "name": "é", "score": 0.5, "tags": ["a", None]}
    bodies = {
        "whole.json": json.dumps(whole), "sub/more.json": json.dumps(whole | {"new": {"deep": [1]}, "id": "12"}), "less.json": '{"id": 3}', "nulls.json": '{"id": 4, "name": null, "score": null}', "pretty.json": json.dumps(whole, indent=2),
        "cut.json": json.dumps(whole)[:-9], "empty.json": "", "blank.json": " \n\t", "list.json": "[]", "number.json": "7", "word.json": "nonsense", "two.json": '{"id": 1}{"id": 2}',
        "no_id.json": '{"name": "x"}', "null_id.json": '{"id": null}', "text_id.json": '{"id": "many"}', "score.json": '{"id": 5, "score": [1]}', "tags.json": '{"id": 5, "tags": "none"}', "other.txt": "not asked for",
    }
    (tmp_path / "sub").mkdir()
    for name, body in bodies.items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    (tmp_path / "bytes.json").write_bytes(b'{"id": "\xff\xfe"}')
    good, bad = files.read_json_folder(spark, f"file://{tmp_path}", SCHEMA, ["id"])
    read = {r.file: (r.id, r.name, r.score, r.tags) for r in good.collect()}
    assert read == {"whole.json": (1, "é", 0.5, ["a", None]), "pretty.json": (1, "é", 0.5, ["a", None]), "more.json": (12, "é", 0.5, ["a", None]), "less.json": (3, None, None, None), "nulls.json": (4, None, None, None)}
    told = {r.file: r.reason for r in bad.collect()}
    assert told == {
        "cut.json": "malformed", "empty.json": "empty", "blank.json": "empty", "list.json": "not an object", "number.json": "not an object", "word.json": "malformed", "two.json": "malformed", "no_id.json": "missing: id", "null_id.json": "missing: id",
        "text_id.json": "wrong type: id", "score.json": "wrong type: score", "tags.json": "wrong type: tags", "bytes.json": "malformed",
    }


def test_empty_json_folder(spark, tmp_path):
    good, bad = files.read_json_folder(spark, f"file://{tmp_path}", SCHEMA)
    assert good.count() == bad.count() == 0


def test_embedding_place(spark):
    rows = spark.createDataFrame([(1, "one two"), (2, ""), (3, None), (4, "fail here")], "id long, content string")
    plain = {r.id: r for r in plugins.embed(rows).collect()}
    assert {r.embedding_source for r in plain.values()} == {"hash_fallback"} and {r.embedding_status for r in plain.values()} == {"unavailable"}
    told = {r.id: r for r in plugins.embed(rows, lambda t: [1, 2] if "one" in t else 1 / 0).collect()}
    assert {i: (r.embedding_source, r.embedding_status) for i, r in told.items()} == {1: ("llm", "ok"), 2: ("hash_fallback", "empty"), 3: ("hash_fallback", "empty"), 4: ("hash_fallback", "error: division by zero")}
    assert told[1].embedding == [1.0, 2.0] and told[4].embedding == plain[4].embedding and len(told[4].embedding) == 2 and told[2].embedding == []
    assert rows.select(T.fit(T.hash_vectors(F.col("content"))).alias("v")).filter(F.size("v") != T.DIM).count() == 0


def test_judging_place(spark):
    rows = spark.createDataFrame([(1, "0.5"), (2, "7"), (3, "x"), (4, ""), (5, None), (6, "nan")], "id long, prompt string")
    assert {(r.judge_score, r.judge_status) for r in plugins.judge(rows).collect()} == {(None, "unavailable")}
    told = {r.id: (r.judge_score, r.judge_status) for r in plugins.judge(rows, float).collect()}
    assert told == {1: (0.5, "ok"), 2: (None, "out of range"), 3: (None, "error: could not convert string to float: 'x'"), 4: (None, "empty"), 5: (None, "empty"), 6: (None, "out of range")}


PAGES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("plain", "plain"),
    ("a<br>b <b>bold </b>and <i>x</i>, <em></em>.", "a b **bold** and *x*, ."),
    ("<h1>A <a href='/x'>link</a></h1><h3></h3><h6>six</h6>", "# A [link](/x)\n\n###### six"),
    ("<a>no target</a> <a href=''>none</a> <a href='u'> padded </a>end", "no target none [padded](u) end"),
    ("<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
    ("<ol start=7><li>a</li><li></li><li>b</li></ol>", "7. a\n8. b"),
    ("<ul><li>a<ul><li>b<ol><li>c</li><li>d</li></ol></li></ul></li><li>e</li></ul>", "- a\n  - b\n    1. c\n    2. d\n- e"),
    ("<ul><li><p>one</p><p>two</p></li><li>three</li></ul>", "- one\n\n  two\n- three"),
    ("<ul>loose<li>item</li></ul>", "- loose\n- item"),
    ("<ol><li>a<ul><li>b</li></ul>tail</li></ol>", "1. a\n   - b\n   tail"),
    ("<table><tr><th>h<th>i<tr><td>1<td>2</table>", "| h | i |\n| --- | --- |\n| 1 | 2 |"),
    ("<table><tr><td>1</td><td>a|b</td></tr><tr><td>2</td></tr></table>", "|  |  |\n| --- | --- |\n| 1 | a\\|b |\n| 2 |  |"),
    ("<table><caption>Cap</caption><thead><tr><th>h</th></tr></thead><tbody><tr><td><p>x</p><p>y</p></td></tr></tbody></table>", "Cap\n\n| h |\n| --- |\n| x y |"),
    ("<table><tr><td>a <table><tr><td>inner</td></tr></table></td></tr></table>", "|  |\n| --- |\n| a inner |"),
    ("<table>lost?<tr>here<td>cell</td></tr></table><table></table>", "lost? here\n\n|  |\n| --- |\n| cell |"),
    ("<pre>  x = 1\n    y\n</pre>", "```\n  x = 1\n    y\n```"),
    ("<pre><code>a ``` b</code></pre>", "````\na ``` b\n````"),
    ("run <code>ls  -l</code> now", "run `ls -l` now"),
    ("<blockquote><p>a</p><ul><li>b</li></ul></blockquote>c", "> a\n>\n> - b\n\nc"),
    ("<blockquote>a<blockquote>b</blockquote></blockquote>", "> a\n>\n> > b"),
    ("a<hr>b", "a\n\n---\n\nb"),
    ("<img src=i.png alt='A cat'><img src=j.png>", "![A cat](i.png)"),
    ("<dl><dt>term<dd>meaning</dl>", "term\n\nmeaning"),
    ("<script>x()</script><style>p{}</style><p>t<script>y</script>u</p><template>z</template>", "tu"),
    ("<div>a<div>b</div>c</div>", "a\n\nb\n\nc"),
    ("<b><p>bold around a block</p></b>", "bold around a block"),
    ("&lt;b&gt; &amp; &#233;", "<b> & é"),
    ("<p>open <b>never <i>closed <p>next", "open **never *closed***\n\nnext"),
    ("<a href=x><h2>Head</h2><p>text</p></a>", "## Head\n\ntext"),
    ("", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_markdown(page, text):
    assert to_markdown(page)[1] == text


class Walk(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hidden, self.said = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title", "template")

    def handle_data(self, data):
        if not self.hidden:
            self.said.append(data)


def words(text):
    return re.findall(r"[^\W_]+", text)


def test_no_text_is_lost(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    for html in [r.html for r in rows] + [p for p, _ in PAGES if "alt=" not in p and "<ol" not in p]:
        walk = Walk()
        walk.feed(html)
        walk.close()
        said = re.sub(r"\]\([^)]*\)", "] ", to_markdown(html)[1])
        assert "".join(words(said)) == "".join(words(" ".join(walk.said)))


def test_deep_pages():
    deep = "<div>" * 5000 + "".join(f"<ul><li>{i}" for i in range(2000)) + " end"
    said = to_markdown(deep)[1]
    assert words(said) == [str(i) for i in range(2000)] + ["end"]
