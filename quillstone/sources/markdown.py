"""HTML to Markdown: a tree of the elements that are open, and a writer for each kind of block."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSEEN = {"script", "style", "template", "title", "head"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "img", "input", "wbr", "button"}
#: An element that opens ends those of these kinds that are open inside the nearest of the holders.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}
HOLDERS = {"table", "td", "th", "li", "blockquote", "div", "section", "article", "main", "body", "dd"}
#: Elements deeper than this belong to the one at this depth, so that writers may call each other.
DEPTH = 120


@dataclass
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("body")
        self.open = [self.root]
        self.title: str | None = None

    def end(self, tags: set[str], holders: set[str]) -> None:
        """Close the innermost open element of the given kinds, unless a holder is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in holders:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "body" and self.open[-1].tag == "head":
            self.open.pop()
        if tag not in INLINE and tag not in UNSEEN:
            self.end({"p"}, HOLDERS)
        if tag in ENDS:
            self.end(*ENDS[tag])
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < DEPTH:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "title":
            self.title = (self.title or "") + data
        else:
            self.open[-1].children.append(data)


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def _around(text: str, mark: str) -> str:
    """text in marks, with the spaces at its ends outside."""
    inner = text.strip()
    return text.replace(inner, f"{mark}{_squeeze(inner)}{mark}", 1) if inner else text


def _raw(node: Node) -> str:
    return "".join(c if isinstance(c, str) else "" if c.tag in UNSEEN else "\n" if c.tag == "br" else _raw(c) for c in node.children)


def _inline(node: Node | str) -> str:
    """A run of text; blocks inside are set off by spaces."""
    if isinstance(node, str):
        return node
    if node.tag in UNSEEN:
        return ""
    if node.tag == "br":
        return " "
    if node.tag == "img":
        alt = _squeeze(node.attrs.get("alt") or "")
        return f"![{alt}]({node.attrs.get('src') or ''})" if alt else ""
    if node.tag in ("code", "kbd", "samp", "tt"):
        return _around(_raw(node), "`")
    text = "".join(map(_inline, node.children))
    if node.tag == "a":
        return _around(text, "\0").replace("\0", "[", 1).replace("\0", f"]({node.attrs['href']})", 1) if node.attrs.get("href") else text
    if node.tag in ("b", "strong", "em", "i"):
        return _around(text, "**" if node.tag in ("b", "strong") else "*")
    return text if node.tag in INLINE else f" {text} "


def _list(node: Node) -> str:
    """A line for each item; what else an item holds is set in under it."""
    number = int(node.attrs["start"]) if (node.attrs.get("start") or "").isdigit() else 1
    out = []
    for item in node.children:
        parts = _blocks(item) if isinstance(item, Node) and item.tag == "li" else _blocks(Node("li", {}, [item]))
        if not parts:
            continue
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        nested = all(isinstance(c, Node) and c.tag in ("ul", "ol") for c in item.children if not isinstance(c, str) and c.tag not in INLINE) if isinstance(item, Node) else True
        text = ("\n" if nested else "\n\n").join(parts)
        first, *rest = text.split("\n")
        out.append("\n".join([mark + first, *((" " * len(mark) + x) if x else x for x in rest)]))
    return "\n".join(out)


def _rows(node: Node) -> list[Node]:
    """The rows of a table, without those of tables in its cells."""
    out = []
    for c in node.children:
        if isinstance(c, Node) and c.tag == "tr":
            out.append(c)
        elif isinstance(c, Node) and c.tag in ("thead", "tbody", "tfoot"):
            out += _rows(c)
    return out


def _table(node: Node) -> list[str]:
    """The table, with what stands in it outside cells before it."""
    rows = _rows(node)
    inside = {id(r) for r in rows}

    def loose(n: Node) -> list[str]:
        out = []
        for c in n.children:
            if isinstance(c, str):
                out.append(c)
            elif id(c) in inside:
                out += [x for x in c.children if isinstance(x, str)]
            else:
                out += loose(c) if c.tag in ("thead", "tbody", "tfoot") else [_inline(c)]
        return out

    cells = [[_squeeze(_inline(c)).replace("|", "\\|") for c in r.children if isinstance(c, Node)] for r in rows]
    cells = [r for r in cells if any(r)]
    before = _squeeze(" ".join(loose(node)))
    if not cells:
        return [before] if before else []
    named = any(isinstance(c, Node) and c.tag == "th" for c in rows[0].children)
    width = max(map(len, cells))
    lines = [r + [""] * (width - len(r)) for r in (cells if named else [[""] * width, *cells])]
    said = ["| " + " | ".join(r) + " |" for r in lines]
    return ([before] if before else []) + ["\n".join([said[0], "|" + " --- |" * width, *said[1:]])]


def _blocks(node: Node) -> list[str]:
    """The blocks of node's children; runs of text between them are paragraphs."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _squeeze("".join(run))
        if text:
            out.append(text)
        run.clear()

    for c in node.children:
        if isinstance(c, str) or c.tag in INLINE and not _holds_block(c):
            run.append(_inline(c))
            continue
        if c.tag in UNSEEN:
            # a head that was never closed holds what follows
            out += _blocks(Node("body", {}, [x for x in c.children if isinstance(x, Node) and x.tag not in UNSEEN | VOID])) if c.tag == "head" else []
            continue
        flush()
        if c.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            text = _squeeze(_inline(c))
            out += [f"{'#' * int(c.tag[1])} {text}"] if text else []
        elif c.tag in ("ul", "ol"):
            text = _list(c)
            out += [text] if text else []
        elif c.tag == "table":
            out += _table(c)
        elif c.tag == "pre":
            text = _raw(c).strip("\n")
            fence = "```" if "```" not in text else "````"
            out += [f"{fence}\n{text}\n{fence}"] if text.strip() else []
        elif c.tag == "blockquote":
            text = "\n\n".join(_blocks(c))
            out += ["\n".join(f"> {x}".rstrip() for x in text.split("\n"))] if text else []
        elif c.tag == "hr":
            out.append("---")
        else:
            out += _blocks(c)
    flush()
    return out


def _holds_block(node: Node) -> bool:
    return any(isinstance(c, Node) and (c.tag not in INLINE | UNSEEN or _holds_block(c)) for c in node.children)


def to_markdown(html: str) -> tuple[str | None, str]:
    """Title and Markdown of a page: headings, paragraphs, nested and numbered lists, tables, quotes, code, rules, links, emphasis and images with a text of their own. Scripts and styles are left out; no other text is."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.title, "\n\n".join(_blocks(tree.root))
