"""Main text of HTML pages by composite text density.

The page is parsed into a DOM without what is never text (scripts, styles, hidden
parts, ...).  Elements that seldom hold article text (menus, headers, footers, sidebars,
forms) and elements with a class, id or role that names such a part (adverts,
notices, comments, ...; a whole class name, each of its parts such a word or a neutral one like ``area``) are left out
before anything is measured, however long they are.  They stay only where the article would go with them:
a header with a heading inside an ``article`` or ``main``; what holds the ``article``, or is a form, if the page has little text outside (a third for forms, else a tenth); and, on a
page that has no other text, what holds the largest density sum.

For every node: C characters, T tags, LC link characters, LT link tags of its
subtree, and the composite density

    C/T * log_b(C/LC * T/LT),   b = ln(C/(C-LC) * LC + LC_body/C_body * C + e)

(counts below 1 are taken as 1; only the argument of the logarithm sees links,
so without links the density is characters per tag, times a factor of 1 or more).  A node's density sum adds its
children's densities (own text counts as one leaf child).  The The node with the
largest sum carries the main text (one in an ``article`` or ``main``, unless three times that sum lies outside); the
smallest density on its path to the
body is the threshold.  From the body down the path, every node beside the
path whose density reaches the threshold belongs to the text as well.
Departures, so that no text of the article is lost: beside the path, but inside an ``article`` or ``main`` that holds it, all blocks
stay; elsewhere blocks below the threshold stay if at most half of their text is links and they are headings or hold paragraphs or stand
between blocks that stay.  Lists (and boxes without paragraphs) mostly of links go below the threshold, wherever they are.

Text: character references decoded; white space inside a block becomes one
space; blocks are trimmed and joined by one line break in page order, empty
ones left out.  Nothing is cut or capped.

Defined cases: null and empty html, and pages without text, give the empty
string; unclosed and misnested tags are closed where the next block starts,
as browsers do for paragraphs and list items; markup nests as deep as it likes
(no recursion).  Other columns are carried along.
"""

from __future__ import annotations

import html as charrefs
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
SOFT = frozenset("nav header footer aside form menu dialog".split())  # may wrap the text of a page
SKIP = RAW | SOFT | frozenset("button select svg math canvas object audio video head datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
PARTS = frozenset("ad ads advert adverts advertisement adsense banner promo promoted sponsor sponsored comment comments "
                  "disqus cookie cookies consent gdpr notice notices alert popup modal overlay sidebar sidebars aside "
                  "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar widget widgets "
                  "share sharing social related recommended newsletter subscribe subscription signup login search "
                  "pagination pager skip toc".split())
#: Words that may stand beside those of PARTS in a name.
NEUTRAL = frozenset("area list section wrapper wrap container box block item items inner outer bar panel page site user reader top "
                    "bottom left right global primary secondary thread form link links text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote pre figcaption dd li td".split())
LISTS = frozenset("ul ol dl menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements that a new block closes, if open within the nearest scope.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th"},
        "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("html body article section main div td th table ul ol dl blockquote figure details".split())

_TAG = re.compile(r"""<(?:!--(?P<note>.*?)(?:-->|\Z)|(?P<decl>[!?][^>]*)(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|"""
                  r"""(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>)""", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")


class Node:
    __slots__ = ("tag", "up", "kids", "noise", "hint", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, up: "Node | None", noise: bool, hint: bool):
        self.tag, self.up, self.noise, self.hint = tag, up, noise, hint
        self.kids: list = []  # nodes and strings, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def _names_a_part(name: str) -> bool:
    words = [w for w in re.split("[_-]+", name) if w and not w.isdigit()]
    return any(w in PARTS for w in words) and all(w in PARTS or w in NEUTRAL for w in words)


def _is_noise(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element never holds text, and whether its name, class, id or role hints that it holds none."""
    if tag in SKIP and tag not in SOFT:
        return True, False
    hint = tag in SOFT
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, hint or tag == "article" and "comment" in attrs.lower()
    for k, v in _ATTR.findall(attrs):
        k = k.lower()
        v = v.strip("\"'").lower()
        if k == "hidden" or k == "aria-hidden" and v == "true":
            return True, False
        if k in ("class", "id"):
            hint = hint or any(_names_a_part(name) for name in v.split())
        elif k == "role" and v in ROLES:
            hint = True
    return False, hint


def parse(page: str) -> Node:
    """The DOM's root; text nodes have their character references decoded."""
    root = top = Node("html", None, False, False)
    at, n = 0, len(page)

    def text(s: str) -> None:
        if s:
            top.kids.append(charrefs.unescape(s) if "&" in s else s)

    def close(tags: set | frozenset, stop: frozenset) -> None:
        """Close the nearest open element of ``tags`` and all inside it, unless one of ``stop`` comes first."""
        nonlocal top
        x = top
        while x.up is not None:
            if x.tag in tags:
                top = x.up
                return
            if x.tag in stop:
                return
            x = x.up

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            break
        m = _TAG.match(page, lt)
        if m is None:  # a lone "<" is text
            text(page[at:lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        if m["start"]:
            tag, attrs = m["start"].lower(), m["attrs"]
            if top.tag == "head" and tag not in IN_HEAD:
                top = top.up  # the head ends where something else starts
            if tag in ("html", "body") or tag == "head" and top is not root:
                continue
            if tag in CLOSES_P:
                close({"p"}, SCOPE)
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                close({"h1", "h2", "h3", "h4", "h5", "h6"}, SCOPE)
            if tag in SAME:
                close(SAME[tag], frozenset(("ul", "ol", "dl", "table", "select")))
            node = Node(tag, top, *_is_noise(tag, attrs))
            top.kids.append(node)
            if tag in VOID or attrs.endswith("/") and tag not in RAW and tag not in ("p", "div", "a", "span", "b"):
                continue
            if tag in RAW:  # up to its end tag, whatever stands between
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                at = page.find(">", end.end()) + 1 or n if end else n
                continue
            top = node
        elif m["end"]:
            tag = m["end"].lower()
            if tag in ("html", "body"):
                continue
            close({tag}, frozenset() if tag in SCOPE or tag in SKIP else SCOPE - {tag})
    text(page[at:])
    return root


def _blocks(root: Node) -> list[str]:
    """Texts of the blocks below ``root``, noise left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        s = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if s:
            out.append(s)

    stack: list = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.noise:
            if x.tag == "br":
                run.append(" ")
                continue
            block = x.tag not in INLINE
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(x.kids))
    flush()
    return out


def _measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes; noise counts nothing.  Returns the nodes, parents first."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(k for k in x.kids if isinstance(k, Node) and not k.noise)
    for x in reversed(order):  # children before parents
        x.chars = x.tags = x.link_chars = x.link_tags = 0
        x.density = 0.0
        for k in x.kids:
            if isinstance(k, str):
                x.chars += len(_SPACE.sub(" ", k).strip())
            elif not k.noise:
                x.chars += k.chars
                x.tags += k.tags + 1
                x.link_chars += k.link_chars
                x.link_tags += k.link_tags + (k.tag == "a")
        if x.tag == "a":
            x.link_chars = x.chars
    share = root.link_chars / max(root.chars, 1)
    for x in order:
        c, t, lc, lt = x.chars, max(x.tags, 1), max(x.link_chars, 1), max(x.link_tags, 1)
        if c:
            base = math.log(c / max(c - x.link_chars, 1) * x.link_chars + share * c + math.e)
            x.density = c / t * max(math.log(max(c / lc * t / lt, 1.0)) / base, 0.0 if x.link_chars else 1.0)
    return order


def _own_text(x: Node) -> int:
    return sum(len(_SPACE.sub(" ", k).strip()) for k in x.kids if isinstance(k, str))


def _sum(x: Node) -> float:
    """Density sum: own text and the children's densities."""
    return _own_text(x) + sum(k.density for k in x.kids if isinstance(k, Node) and not k.noise)


def _up(x: Node | None) -> Iterator[Node]:
    """``x`` and the nodes around it, innermost first."""
    while x is not None:
        yield x
        x = x.up


def _in_article(x: Node) -> bool:
    return any(y.tag in ("article", "main") for y in _up(x))


def _follow_hints(root: Node, nodes: list[Node]) -> list[Node]:
    """Make noise of what the hints name, but for what holds the article itself; the nodes left, measured."""
    for x in nodes:  # a header of the article, not of the page
        if x.tag in HEADINGS:
            head = next((y for y in _up(x) if y.hint), None)
            if head is not None and head.tag == "header" and _in_article(head) and not any(y.hint for y in _up(head.up)):
                head.hint = False
    holds = [x for x in nodes if x.tag in ("article", "main", "form") and any(y.hint for y in _up(x))
             and not (x.tag != "form" and x.hint)]
    best = max(nodes, key=_sum)
    for x in nodes:
        x.noise = x.hint
    left = _measure(root)
    if any(x.tag in ("article", "main") and x.chars for x in left):
        return left
    outside = root.chars
    for x in holds:  # text inside, without the parts that hints name there
        inner = [x.hint, x.noise]
        x.hint = x.noise = False
        _measure(x)
        x.hint, x.noise = inner
    # an article before a form, the largest first; most pages in a form are one form, other parts seldom hold the article
    holds = [x for x in holds if x.chars > outside * (3 if all(y.tag == "form" for y in _up(x) if y.hint) else 10)]
    inner = max(holds, key=lambda x: (x.tag != "form", x.chars), default=None if outside else best)
    if inner is not None:
        for x in _up(inner):
            x.hint = x.noise = False
    return _measure(root)


def _stays(k: Node, between: bool) -> bool:
    """Whether a block below the threshold may belong to the article."""
    if not k.chars or 2 * k.link_chars > k.chars:
        return False
    stack = [k]
    while stack and not between:
        x = stack.pop()
        between = x.tag in PROSE
        stack += [y for y in x.kids if isinstance(y, Node) and not y.noise]
    return between


def _has(x: Node, tags: frozenset) -> bool:
    stack = list(x.kids)
    while stack:
        k = stack.pop()
        if isinstance(k, Node) and not k.noise:
            if k.tag in tags:
                return True
            stack += k.kids
    return False


_P = frozenset(("p",))


def main_text(page: str) -> str:
    """The main text of one page."""
    root = parse(page)
    nodes = _measure(root)
    if any(x.hint for x in nodes):
        nodes = _follow_hints(root, nodes)
    if not root.chars:
        return ""
    best = max(nodes, key=_sum)
    if not _in_article(best):
        inside = max((x for x in nodes if x.chars and _in_article(x)), key=_sum, default=None)
        if inside is not None and best not in _up(inside) and _sum(best) < 3 * _sum(inside):
            best = inside
    path = list(_up(best))
    threshold = min(x.density for x in path)
    outer = max((i for i, x in enumerate(path) if x.tag in ("article", "main")), default=0)
    for i, (x, inner) in enumerate(zip(path[1:], path), 1):  # beside the path: what is as dense as the path stays
        if i <= outer:
            continue
        blocks = [k for k in x.kids if isinstance(k, Node) and not k.noise and k.tag not in INLINE]
        dense = [j for j, k in enumerate(blocks) if k is inner or k.density >= threshold]
        for j, k in enumerate(blocks):
            if k is not inner and k.density < threshold and not _stays(k, bool(dense) and dense[0] < j < dense[-1]):
                k.noise = True
    around = set(map(id, path))
    for x in nodes:
        if x.link_tags > 1 and 2 * x.link_chars > x.chars and x.density < threshold and id(x) not in around and (
                x.tag in LISTS or x.tag in ("div", "section", "table") and not _has(x, _P)):
            x.noise = True
    return "\n".join(_blocks(root))


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``html_col`` replaced by the main text (column ``out``, a name it does not have)."""
    keep = [c for c in pages.columns if c != html_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(b.schema.get_field_index(html_col))
            got = pa.array([main_text(t.decode("utf-8", "replace")) for t in texts_of(col)], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), got], [*keep, out])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in keep)
    return pages.withColumn(html_col, F.col(html_col).cast("binary")).mapInArrow(
        run, f"{kept}, `{out}` string" if kept else f"`{out}` string")
