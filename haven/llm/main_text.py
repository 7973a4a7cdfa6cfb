"""Main text of web pages by tree scoring.

A page is read into a tree with HTML's rules for void elements, raw text and
implied end tags.  Parts that are never the article (by element, role, or class
and id words) are taken out.  Each paragraph passes points for its length and
commas to its ancestors, less with distance; a container's points are discounted
by its link density.  The best container is widened to the article element that
holds it, and siblings that score like it or read like running text are kept.

Every step is linear in the page and keeps its own stack, so deep nesting and
unclosed markup cost no more than other pages.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
#: Start tags that end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote body center details dialog dir div dl dt dd fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody thead tfoot tr td "
    "th caption ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_CONTENT = frozenset("head title meta link script style base noscript template".split())
#: An end tag outside these does not reach what they are in.
SCOPES = frozenset("td th caption table button object template html".split())
#: A start tag of the key ends the open elements named, unless one of the others lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

# What is no part of an article.
NEVER_TEXT = frozenset(
    "head script style template noscript noembed noframes iframe object embed applet svg canvas audio video nav footer "
    "aside form button select textarea input option label dialog menu title".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status "
    "tablist tooltip".split())
#: Words of class and id names.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertising adverts adsense adbox adslot alert banner billboard breadcrumb breadcrumbs "
    "consent cookie cookies copyright disclaimer dropdown footer form gdpr header hidden login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion related "
    "recommended recommendations share sharing sidebar signin signup skip skyscraper social sponsor sponsored sponsors "
    "subscribe subscription taboola toolbar topbar widget widgets".split())
#: A name with one of these tells of a part elsewhere (``has-sidebar``).
ABOUT_OTHERS = frozenset("has with no without not".split())
REMARKS = frozenset(
    "comment comments commentlist disqus discussion reply replies respond responses reactions trackback trackbacks".split())
#: Words that speak for a container, and points for one.
GOOD = frozenset("article blog body content entry main page post story text".split())
CLASS_POINTS = 25.0
TAG_POINTS = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "address": -3.0,
              "ol": -3.0, "ul": -3.0, "dl": -3.0, "dd": -3.0, "dt": -3.0, "li": -3.0, **dict.fromkeys(HEADINGS, -5.0), "th": -5.0}
#: Elements whose own text is a paragraph that scores.
PARAGRAPHS = frozenset("p pre td blockquote div section article main dd li body html".split())
#: Containers that may be the best one.
CONTAINERS = frozenset("article main div section td body html blockquote center".split())
#: A list or box is a menu if links hold more than this share of its text.
MENU_DENSITY, MENU_LINKS = 0.5, 2
MENUS = frozenset("ul ol dl div section table".split())
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0

_TAG = re.compile(
    r"<(/?)([A-Za-z][^\t\n\f\r />]*+)"
    r"((?:[\t\n\f\r /]*+(?:[^\t\n\f\r />=]|(?<=[\t\n\f\r /])=)[^\t\n\f\r />=]*+"
    r"(?:[\t\n\f\r ]*+=[\t\n\f\r ]*+(?:\"[^\"]*+\"|'[^']*+'|[^\t\n\f\r >\"'][^\t\n\f\r >]*+)?)?)*+)[\t\n\f\r /]*+=?[\t\n\f\r /]*+>")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\t\n\f\r />]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"(?i)[\s/\"'](class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"']++)|(?=[\s/>]|$))")
_COMMENT_END = re.compile(r"--!?>")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE, _COMMAS = re.compile(r"\s+"), re.compile("[,،、，]")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("tag", "parent", "box", "children", "attrs", "chars", "commas", "links", "link_chars", "score", "gone", "holds")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str]):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        #: the nearest block around it
        self.box = parent if parent is None or parent.tag in BLOCKS else parent.box
        self.children: list[Node | str] = []
        self.chars = self.commas = self.links = self.link_chars = 0
        self.score = 0.0
        self.gone = False
        self.holds: set[str] = set()


# ---- reading --------------------------------------------------------------------

def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) with kind one of text, start, end; comments and declarations are skipped."""
    at, n, lower = 0, len(page), None
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", html.unescape(page[at:]), ""
            return
        if lt > at:
            yield "text", html.unescape(page[at:lt]), ""
        after = page[lt + 1: lt + 2]
        if after == "!" and page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):
                at = page.index(">", lt + 4) + 1
                continue
            end = _COMMENT_END.search(page, lt + 4)
            at = end.end() if end else n
        elif after in ("!", "?") or (after == "/" and not page[lt + 2: lt + 3].isalpha()):
            if after == "/" and lt + 2 >= n:
                yield "text", page[lt:], ""
                return
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        elif after.isascii() and after.isalpha() or after == "/":
            m = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
            if m is None:  # cut off inside a tag
                return
            name, at = m[2].lower(), m.end()
            yield ("end" if m[1] else "start"), name, m[3]
            if name in RAW_TEXT and not m[1]:
                lower = lower if lower is not None else ascii_lower(page)
                end = re.compile(rf"</{name}(?=[\s/>])").search(lower, at)
                yield "text", html.unescape(page[at: end.start() if end else n]), ""
                at = end.start() if end else n
        else:
            yield "text", "<", ""
            at = lt + 1


def ascii_lower(text: str) -> str:
    """Same length as the text, which ``str.lower`` does not promise."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def attributes(raw: str) -> dict[str, str]:
    if not raw.strip():
        return {}
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


class Reader:
    """The open elements, and by name where they are on the stack."""

    def __init__(self) -> None:
        self.root = Node("html", None, {})
        self.stack = [self.root]
        self.where: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]
        self.scopes = [0]

    def _pop_to(self, depth: int) -> None:
        """Close the elements from ``depth`` on."""
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            self.where[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            if tag in SCOPES:
                self.scopes.pop()

    def _last(self, tags: set[str]) -> int:
        return max((self.where[t][-1] for t in tags if self.where[t]), default=-1)

    def start(self, tag: str, raw: str) -> None:
        if tag in ("html", "body") and self.where[tag] or tag == "html":
            return
        if self.where["head"] and tag not in HEAD_CONTENT:
            self._pop_to(self.where["head"][0])
        if tag in BLOCKS and self.where["p"] and self.where["p"][-1] > self.scopes[-1]:
            self._pop_to(self.where["p"][-1])
        if tag in IMPLIED:
            ends, between = IMPLIED[tag]
            border = max(self._last(between), 0)
            inner = [self.where[t][bisect_right(self.where[t], border)] for t in ends if self.where[t] and self.where[t][-1] > border]
            if inner:
                self._pop_to(min(inner))
        elif tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._pop_to(len(self.stack) - 1)
        elif tag == "a" and self.where["a"] and self.where["a"][-1] > self.blocks[-1]:
            self._pop_to(self.where["a"][-1])
        node = Node(tag, self.stack[-1], attributes(raw))
        self.stack[-1].children.append(node)
        if tag in VOID:
            return
        at = len(self.stack)
        self.stack.append(node)
        self.where[tag].append(at)
        if tag in BLOCKS:
            self.blocks.append(at)
        if tag in SCOPES:
            self.scopes.append(at)

    def end(self, tag: str) -> None:
        open_ = self.where[tag]
        if not open_ or tag in VOID:
            return
        if tag in ("td", "th", "caption"):
            border = self._last({"table"})
        elif tag in SCOPES or tag == "body":
            border = -1
        elif tag in BLOCKS:
            border = max(self.scopes[-1], self._last({"ul", "ol"}) if tag == "li" else -1)
        else:
            border = self.blocks[-1]
        if open_[-1] > border:
            self._pop_to(open_[-1])

    def text(self, text: str) -> None:
        if self.stack[-1].tag == "head" and text.strip():
            self._pop_to(len(self.stack) - 1)
        self.stack[-1].children.append(text)


def read_page(page: str) -> Node:
    reader = Reader()
    for kind, name, raw in tokens(page):
        if kind == "text":
            reader.text(name)
        elif kind == "start":
            reader.start(name, raw)
        else:
            reader.end(name)
    return reader.root


# ---- boilerplate ----------------------------------------------------------------

def name_words(node: Node) -> set[str]:
    """Words of class and id names."""
    out: set[str] = set()
    for name in f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".split():
        words = {w.lower() for w in _NAME_WORD.findall(name)}
        if not words & ABOUT_OTHERS:
            out |= words
    return out


def is_boilerplate(node: Node, whole_page: int, inside_article: bool) -> bool:
    tag, attrs = node.tag, node.attrs
    if tag in NEVER_TEXT or (tag == "header" and not inside_article):
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if attrs.get("role", "").lower() in NEVER_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" \
            or _HIDDEN.search(attrs.get("style", "")):
        return True
    words = name_words(node)
    if words & REMARKS:
        return True
    # names of layouts (``sidebar-left``) may be on what holds the article itself
    layout = node.holds & {"article", "main"} or (node.holds & {"h1", "h2"} and 2 * node.chars > whole_page)
    return bool(words & BOILERPLATE) and tag != "article" and not layout


def in_order(root: Node) -> Iterator[tuple[Node, bool]]:
    """(node, whether it is left) of a depth-first walk without recursion; nodes marked gone on entry are not entered."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        yield node, leaving
        if not leaving and not node.gone:
            stack.append((node, True))
            stack += [(c, False) for c in reversed(node.children) if not isinstance(c, str)]


def strip_boilerplate(root: Node) -> None:
    """Mark what is no part of an article as gone."""
    for node, leaving in in_order(root):
        if not leaving:
            node.chars = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if node.tag not in NEVER_TEXT else 0
        elif node.parent is not None and node.tag not in NEVER_TEXT:
            node.parent.chars += node.chars
            node.parent.holds |= node.holds | ({node.tag} & {"article", "main", "h1", "h2"})
    whole_page, inside = root.chars, 0
    for node, leaving in in_order(root):
        article = node.tag in ("article", "main")
        if not leaving:
            node.gone = node is not root and is_boilerplate(node, whole_page, inside > 0)
        if not node.gone:
            inside += -article if leaving else article


# ---- scoring --------------------------------------------------------------------

def measure(root: Node) -> None:
    """Characters, commas and links of every node, and what its paragraphs pass to their ancestors."""
    linked = 0
    for node, leaving in in_order(root):
        if node.gone:
            continue
        is_link = node.tag == "a"
        if not leaving:
            linked += is_link
            own = " ".join(c for c in node.children if isinstance(c, str))
            node.chars = len(_SPACE.sub(" ", own).strip())
            node.commas = len(_COMMAS.findall(own))
            node.link_chars = node.chars if linked else 0
            node.links = int(is_link)
            continue
        linked -= is_link
        if node.tag in PARAGRAPHS:
            pass_points(node)
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.commas += node.commas
            up.links += node.links
            up.link_chars += node.link_chars


def pass_points(node: Node) -> None:
    """A paragraph's points: 1, one a comma and one per 100 characters (three at most) of its inline text, less
    its share of links.  The first container gets all, the second half, then a third of a distance."""
    chars, commas, links = node.chars, node.commas, node.link_chars
    for c in node.children:  # blocks inside it are paragraphs of their own
        if not isinstance(c, str) and not c.gone and c.tag in BLOCKS:
            chars, commas, links = chars - c.chars, commas - c.commas, links - c.link_chars
    if chars <= 0:
        return
    points = (1.0 + commas + min(chars / 100.0, 3.0)) * max(0.0, 1.0 - links / chars)
    up = node if node.tag in CONTAINERS else node.box  # text straight in a container is the container's
    for share in (1, 2, 6, 9, 12):
        if up is None:
            break
        up.score += points / share
        up = up.box


def density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def prior(node: Node) -> float:
    words = name_words(node) if node.attrs else set()
    good = bool(words & GOOD) or node.attrs.get("itemprop") == "articleBody" or node.attrs.get("role") in ("main", "article")
    return TAG_POINTS.get(node.tag, 0.0) + CLASS_POINTS * good


def best_container(root: Node) -> tuple[Node, float]:
    best, most = root, 0.0
    for node, leaving in in_order(root):
        if leaving or node.gone or node.tag not in CONTAINERS or not node.score:
            continue
        total = (node.score + prior(node)) * (1.0 - density(node))
        if total > most:
            best, most = node, total
    return best, most


def widened(node: Node) -> Node:
    """The article element around the best container, else the main one, else the container."""
    at, found = node, None
    while at is not None:
        if at.tag == "article" or at.attrs.get("role") == "article" or at.attrs.get("itemprop") == "articleBody":
            return at
        if found is None and (at.tag == "main" or at.attrs.get("role") == "main"):
            found = at
        at = at.parent
    return found or node


def joins(c: Node, top: Node, score: float) -> bool:
    """Whether a sibling of the best container goes with it."""
    least = max(SIBLING_LEAST, score * SIBLING_SHARE)
    worth = (c.score + prior(c)) * (1.0 - density(c))
    alike = c.attrs.get("class") is not None and c.attrs.get("class") == top.attrs.get("class")
    if top.tag in ("article", "main"):  # stands for itself: only an article of its kind and rank may join
        return c.tag == top.tag and c.attrs.get("class") == top.attrs.get("class") and worth >= max(least, score / 2)
    if c.tag == "p":
        text = next((t for t in reversed(c.children) if isinstance(t, str) and t.strip()), "").strip()
        return density(c) < 0.25 and (c.chars > 80 or text.endswith((".", "!", "?", "…")))
    return c.score > 0 and worth + score * SIBLING_SHARE * alike >= least


def kept_siblings(top: Node, score: float) -> list[Node]:
    """The best container, siblings that score or read like it, and the headings before them, in page order."""
    out, titles = [], []
    for c in top.parent.children if top.parent is not None else [top]:
        if isinstance(c, str) or c.gone:
            continue
        if c.tag in HEADINGS:
            titles.append(c)
        elif c is top or joins(c, top, score):
            out += [*titles, c]
            titles = []
        else:
            titles = [t for t in titles if t.tag == "h1"]
    return out


# ---- text -----------------------------------------------------------------------

def blocks_of(node: Node) -> Iterator[str]:
    """Text of each block, white space made one space; boxes of links inside are menus and left out."""
    buffer: list[str] = []

    def flush() -> str:
        text = _SPACE.sub(" ", "".join(buffer)).strip()
        buffer.clear()
        return text

    stack: list[Node | str | None] = [node]
    while stack:
        at = stack.pop()
        if at is None or isinstance(at, str):
            if at is None:
                text = flush()
                if text:
                    yield text
            else:
                buffer.append(at)
            continue
        if at.gone:
            continue
        if at.tag == "br":
            buffer.append(" ")
            continue
        block = at.tag in BLOCKS
        if at is not node and at.tag in MENUS and at.links >= MENU_LINKS and density(at) > MENU_DENSITY:
            stack.append(None)
            continue
        if block:
            text = flush()
            if text:
                yield text
            stack.append(None)
        stack += reversed(at.children)
    text = flush()
    if text:
        yield text


def main_text_of(page: str) -> str:
    """The main text of one page, blocks joined by an empty line."""
    root = read_page(page)
    strip_boilerplate(root)
    measure(root)
    top, score = best_container(root)
    return "\n\n".join(block for part in kept_siblings(widened(top), score) for block in blocks_of(part))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            text = [main_text_of(page.as_py() or "") for page in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points of text).

    Null and empty pages, and pages of boilerplate alone, have an empty text.
    Character references are decoded, white space inside a block (``<br>``
    included) is one space, blocks are joined by two line feeds in page order.
    Rows pass one by one, so repeats, ties and null ids stay; other columns are
    not read; an empty table gives an empty result.
    """
    kept = pages.select("page_id", "url", "html")
    schema = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return kept.mapInArrow(_extract, f"{schema}, text string, n_chars long")
