"""Operator 3: main text of HTML pages. Parser events become lines with text-to-tag ratios; smoothed ratios are clustered, and the clusters choose the content region."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import ship

#: Elements whose text is no page text, elements that hold no main text, elements that begin a line, elements that can be a content region.
UNSEEN = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "datalist", "select", "option", "textarea", "button"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
REGIONS = {"body", "main", "article", "section", "div", "td", "center"}
#: Elements that group lines of a page's body but can be no content region, and elements of running text, whose names mark nothing but adverts, notices of cookies and comments.
LISTS = {"ul", "ol", "dl", "table"}
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "pre", "blockquote", "figure", "figcaption", "caption", "summary", "address", "hgroup"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that leave an open head open.
HEAD = {"head", "html", "title", "meta", "link", "script", "style", "noscript", "base", "template"}
#: Words in class, id or role that mark menus, notices, adverts, comments and the like.
MARKED = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|newsletter|subscri\w+|signup|login|share|sharing|social|comment\w*|disqus|respond|repl(?:y|ies)|nav\w*|menu\w*|breadcrumb\w*|crumbs|sidebar\w*|side|aside|widget\w*|related|recommend\w*|foot(?:er)?\w*|head(?:er)?|masthead|pagination|pager|toolbar|copyright|legal|skip|hidden|search|complementary|navigation|contentinfo)",
    re.IGNORECASE,
)
MARKED_TEXT = re.compile(r"ads?|advert\w*|sponsored|promo|cookies?|comments?", re.IGNORECASE)
#: Words that make a marker tell of a page's layout or state when they stand before or after it in the same name: has-sidebar, comments-open.
BEFORE, AFTER = {"has", "have", "no", "not", "with", "without", "is", "hide", "show", "enable", "disable"}, {"open", "opened", "closed", "enabled", "disabled", "on", "off", "active", "inactive", "visible", "collapsed", "expanded", "none"}
#: Share of the page's dense text that a part to leave out must exceed to be kept for it, by whether its name only contains a marker.
KEPT = {False: 0.9, True: 0.5}
#: Width of the smoothing, in lines, and share of a region's dense text that a smaller region inside must hold to be chosen in its place.
SIGMA, SHARE = 1.0, 0.7
#: A ratio is sparse only if it is below this share of the dense cluster's mean, so that pages whose lines are all alike lose none; a cluster of a lower mean than this many characters a tag is no running text.
SPARSE, RUNNING_MEAN = 0.25, 8.0


@dataclass
class Line:
    """A block's text, the tags met in it, the characters of it inside links, the region it stands in, whether it is a heading or stands in no element of running text, and the part to leave out, 0 for none."""

    text: str = ""
    tags: int = 0
    linked: int = 0
    region: int = 0
    heading: bool = False
    bare: bool = False
    cut: int = 0


@dataclass
class _Open:
    tag: str
    region: int
    cut: int
    hide: bool


@dataclass
class Page:
    lines: list[Line] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [-1])
    kinds: list[str] = field(default_factory=lambda: ["body"])
    cuts: list[tuple[int, bool]] = field(default_factory=lambda: [(-1, False)])


def marked(names: str) -> tuple[bool, bool]:
    """Whether one of the names marks a part to leave out, and whether each that does has other words beside the marker."""
    found, loose = False, True
    for name in names.split():
        words = [w for w in re.split(r"[_-]", name.lower()) if w]
        is_mark = [MARKED.fullmatch(w) is not None for w in words]
        told = [m and not (i and words[i - 1] in BEFORE) and not (i + 1 < len(words) and words[i + 1] in AFTER) for i, m in enumerate(is_mark)]
        found |= any(told)
        loose &= not any(told) or not all(is_mark)
    return found, found and loose


class _Lines(HTMLParser):
    """Events in one pass. Of the elements only those that open a line, a region or a part to leave out are kept on the stack, so unclosed inline tags do no harm."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.stack: list[_Open] = [_Open("", 0, 0, False)]
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.heading = False

    def flush(self) -> None:
        top = self.stack[-1]
        text = " ".join("".join(self.parts).split())
        if text and not top.hide:
            self.page.lines.append(Line(text, self.tags, min(self.linked, len(text)), top.region, self.heading, top.tag in REGIONS or not top.tag, top.cut))
        self.parts, self.tags, self.linked, self.heading = [], 0, 0, False

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        self.close_head(tag)
        top = self.stack[-1]
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID and tag != "hr":
            return
        if tag not in BLOCKS and tag not in UNSEEN and tag not in ASIDE:
            return
        if tag in UNSEEN and tag not in BLOCKS:  # inside a line, e.g. a script in a paragraph
            self.stack.append(_Open(tag, top.region, top.cut, True))
            self.parts.append(" ")
            return
        self.flush()
        self.links = 0
        if tag == "hr":
            return
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "option"):
            self.heading = tag[0] == "h" and tag[1:].isdigit()
            self.pop_open({"p"} | ({tag} if tag != "p" else set()) | ({"td", "th"} if tag in ("tr", "td", "th") else set()) | ({"dt", "dd"} if tag in ("dt", "dd") else set()), {"table", "ul", "ol", "dl", "div", "section", "article", "main", "body", "blockquote"})
            top = self.stack[-1]
            if tag in ("p", "li") and not attrs:
                self.stack.append(_Open(tag, top.region, top.cut, top.hide))
                return
        marks = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and "display:none" in v.replace(" ", "").lower() for k, v in attrs)
        if tag in RUNNING:
            mark, loose = any(MARKED_TEXT.fullmatch(x) for x in marks.split()), False
        else:
            mark, loose = marked(marks) if tag not in ("html", "body", "article", "main") else (False, False)
        cut = top.cut
        if tag in ASIDE or mark:
            self.page.cuts.append((cut, loose and tag not in ASIDE))
            cut = len(self.page.cuts) - 1
        region = top.region
        if tag in REGIONS or tag in LISTS:
            self.page.parents.append(region)
            self.page.kinds.append(tag)
            region = len(self.page.parents) - 1
        self.stack.append(_Open(tag, region, cut, top.hide or hidden or tag in UNSEEN))

    def close_head(self, tag: str) -> None:
        """A head without its end tag ends where content begins."""
        if tag == "body":
            at = next((i for i, x in enumerate(self.stack) if x.tag == "head"), None)
            if at:
                del self.stack[at:]
        elif tag not in HEAD and self.stack[-1].tag == "head":
            self.stack.pop()

    def pop_open(self, tags: set[str], stop: set[str]) -> None:
        """Pop open elements of the given kinds at the top of the stack, through what else is open there, up to an element that stops the search."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in stop:
                return

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCKS and tag not in UNSEEN and tag not in ASIDE:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                if tag in BLOCKS or tag in ASIDE:
                    self.flush()
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.close_head("")
        if not self.stack[-1].hide:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """Marked sections are no text."""


def parse(html: str) -> Page:
    p = _Lines()
    p.feed(html)
    p.close()
    p.flush()
    return p.page


def ratios(lines: list[Line]) -> list[float]:
    """Characters outside links for each tag of the line."""
    return [(len(x.text) - x.linked) / max(1, x.tags) for x in lines]


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing over neighbouring lines; weights are normalised at the ends."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low = max(0, i - reach)
        near = values[low : i + reach + 1]
        weights = kernel[low - i + reach : low - i + reach + len(near)]
        out.append(sum(v * w for v, w in zip(near, weights, strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Two clusters on the line: the cut moves to the middle of both means until it stays. It is lowered to SPARSE of the upper mean, if that is less; without running text it is 0."""
    if not values:
        return 0.0
    at = sum(values) / len(values)
    for _ in range(50):
        low, high = [v for v in values if v < at], [v for v in values if v >= at]
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2 if low and high else at
        if abs(new - at) < 1e-9:
            break
        at = new
    high = [v for v in values if v >= at] or values
    mean = sum(high) / len(high)
    return min(at, SPARSE * mean) if mean >= RUNNING_MEAN else 0.0


def dense(values: list[float]) -> list[bool]:
    """Values of the upper cluster."""
    at = threshold(values)
    return [v >= at for v in values]


def uncut(page: Page) -> list[Line]:
    """Lines that stand in no part to leave out. A part that holds most of the page's dense text, more than half of all its text outside links, and no less in article and main elements than the rest, is left in."""
    if len(page.cuts) == 1:
        return page.lines
    weight, every, named = ([0] * len(page.cuts) for _ in range(3))
    inside: list[bool] = []
    for kind, parent in zip(page.kinds, page.parents, strict=True):
        inside.append(kind in ("article", "main") or parent >= 0 and inside[parent])
    for x, m in zip(page.lines, dense(smooth(ratios(page.lines))), strict=True):
        n = len(x.text) - x.linked
        weight[x.cut] += n * m
        every[x.cut] += n
        named[x.cut] += n * inside[x.region]
    for c in range(len(page.cuts) - 1, 0, -1):  # a part comes after the one around it
        for sums in (weight, every, named):
            sums[page.cuts[c][0]] += sums[c]
    out = [False] * len(page.cuts)
    for c, (parent, loose) in enumerate(page.cuts):
        out[c] = c > 0 and (out[parent] or weight[c] <= KEPT[loose] * weight[0] or 2 * every[c] <= every[0] or 2 * named[c] < named[0])
    return [x for x in page.lines if not out[x.cut]]


def region_of(page: Page, lines: list[Line], marks: list[bool]) -> int:
    """The content region: the innermost region that holds SHARE of the dense text of the region around it, beginning with the whole page."""
    weight = [0] * len(page.parents)
    for x, m in zip(lines, marks, strict=True):
        weight[x.region] += m * (len(x.text) - x.linked)
    for r in range(len(weight) - 1, 0, -1):  # a region comes after the one around it
        weight[page.parents[r]] += weight[r]
    articles = [r for r, k in enumerate(page.kinds) if k == "article" and weight[r] > 0]
    chosen = 0
    inner: dict[int, list[int]] = {}
    for r, parent in enumerate(page.parents):
        inner.setdefault(parent, []).append(r)
    while True:
        best = max((r for r in inner.get(chosen, []) if page.kinds[r] not in LISTS), key=lambda r: weight[r], default=None)
        if best is None or page.kinds[chosen] == "article" or weight[best] < SHARE * weight[chosen] or not weight[best]:
            break
        chosen = best
    if page.kinds[chosen] != "article" and len(articles) == 1 and weight[articles[0]] >= 0.5 * weight[0]:
        chosen = articles[0]
    return chosen


def content(page: Page) -> list[str]:
    """Blocks of the content region.

    An article or main element keeps all its lines, and so does any region whose lines stand in it itself. Of the containers in other regions (in a body, of lists and tables too) those go that
    hold nothing dense: no line whose smoothed ratio is in the upper cluster, or, where smoothing only lends them their neighbours' ratio, text of their own that is sparse and most of it linked or, if the region's
    running text isn't so itself, in no element of running text. A list between lines of running text stays. A container of headings goes with what follows it.
    """
    lines = uncut(page)
    if not lines:
        return []
    own = ratios(lines)
    at = threshold(smooth(own))
    marks = [v >= at for v in smooth(own)]
    chosen = region_of(page, lines, marks)
    groups: list[tuple[int, list[int]]] = []  # lines of a container that stands in the chosen region; -1: of the region itself
    around: list[int | None] = [None] * len(page.parents)  # the container of each region in the chosen one
    around[chosen] = -1
    for r in range(chosen + 1, len(page.parents)):
        up = page.parents[r]
        around[r] = r if up == chosen else around[up]
    for i, x in enumerate(lines):
        group = around[x.region]
        if group is None:
            continue
        if group >= 0 and page.kinds[group] in LISTS and page.kinds[chosen] != "body":
            group = -1
        if groups and groups[-1][0] == group:
            groups[-1][1].append(i)
        else:
            groups.append((group, [i]))
    named = chosen
    while named >= 0 and page.kinds[named] not in ("article", "main"):
        named = page.parents[named]
    solid = [any(own[i] >= at and marks[i] for i in places) for _, places in groups]
    # where the running text itself stands in bare containers, bareness tells nothing
    running = [x for i, x in enumerate(lines) if own[i] >= at and marks[i] and around[x.region] is not None]
    told = 2 * sum(len(x.text) for x in running if x.bare) < sum(len(x.text) for x in running)
    out: list[str] = []
    follows = False  # whether what follows is kept
    for g in range(len(groups) - 1, -1, -1):
        group, places = groups[g]
        held = [lines[i] for i in places]
        beside = [k for k in (g - 1, g + 1) if 0 <= k < len(groups) and groups[k][0] < 0 and solid[k]]
        if named >= 0 or group < 0 or solid[g]:
            keep = True
        elif page.kinds[group] in LISTS and len(beside) == 2:  # a list between running text
            keep = True
        elif all(x.heading for x in held):
            keep = follows
        else:
            linked = 2 * sum(x.linked for x in held) >= sum(len(x.text) for x in held)
            keep = any(marks[i] for i in places) and not linked and not (told and all(x.bare for x in held))
        if keep:
            out += [x.text for x in reversed(held)]
        follows = keep
    return out[::-1]


def main_text(html: str | None) -> str:
    """The page's main text: its blocks in page order, joined by empty lines."""
    return "\n\n".join(content(parse(html or "")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A header is left out wherever it stands, in an article too, with the headings in it. Where lines of running text are short (below RUNNING_MEAN characters a tag), clusters tell nothing, and elements and names decide alone.
    Null and empty html, and pages without main text, give an empty text; ids, nulls and repeated rows stay as they are; further columns are not read; an empty table gives no rows. A page of any
    length is parsed whole in the task that reads it. Of regions that hold equal shares the first is taken. No shuffle.
    """
    ship(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
