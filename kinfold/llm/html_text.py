"""Main-text extraction from HTML by tag-path ratios.

Every text node of a page belongs to a root-to-leaf **tag path** (``html/body/article/p``). Nodes of one path play one
role, so the page is judged by path, not by node: for each path the text length and the punctuation are summed and
divided by its number of nodes. The ratios are smoothed over the order in which paths first appear, fused into one
score, and compared with a threshold that follows their spread on the page. Text in links counts for nothing.

Paths over the threshold mark the content; the smallest element that holds their nodes (an article or main element
around it, where there is one) is the content's region, and every block in it is kept, so that headings and short
paragraphs of the article stay.

Elements whose tag, role or class names a menu, header, footer, sidebar, notice, advert, form or reader comments are **suspects**. The
text decides about them too: one that holds an article or main element, or most of the unlinked text of the page (of its own article, inside one), is part
of the layout and stays; any other is left out before the paths are scored. "Most" is over half for a name inside a longer one (``has-sidebar``) and for
a form (of the text outside other suspects), and over four fifths for a name of its own. Scripts, styles, controls and hidden elements never count.

A page is read once; the work is linear in its length, however deep or unclosed its elements are.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import with_columns

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？¿¡]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An open element of the second kind ends where one of the first begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("html body article section main div table td th ul ol dl blockquote form aside nav header footer fieldset".split())
#: Start tags that do not end an open paragraph.
IN_PARAGRAPH = INLINE | VOID - {"hr"} | RAW | {"button", "label", "select", "option", "svg", "canvas", "audio", "video", "object", "picture", "map", "output"}

NEVER = frozenset("head script style noscript template button select option textarea input label iframe object embed svg canvas audio video dialog title xmp noembed noframes math".split())
#: Suspect elements by tag.
SUSPECT = {"nav": 2, "header": 2, "footer": 2, "aside": 2, "menu": 2, "fieldset": 2, "form": 1}
#: Share of the text that a suspect of each degree must exceed to stay.
MOST = {1: 0.5, 2: 0.8}
#: Unlinked characters of an article element next to which no other element of suspect name is the page's text.
ARTICLE = 200
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar tooltip".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox adblock sponsor sponsored sponsors promo promos promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc masthead header footer sidebar sidenav aside widget widgets "
    "cookie cookies consent gdpr notice notices alert disclaimer newsletter subscribe subscription signup popup modal overlay paywall "
    "comment comments commentlist disqus discussion reply replies respond feedback reviews share sharing social related recommended recommendations "
    "copyright login search toolbar skip hidden".split())
PLAIN = frozenset("html body article main".split())


@dataclass
class Node:
    path: int
    text: str
    block: int
    element: int
    linked: bool


@dataclass
class Page:
    """Text nodes in order, and for each element (numbered as they open) its tag, parent, last element inside, and degree of suspicion (3: never text)."""

    nodes: list[Node]
    tags: list[str]
    parent: list[int]
    until: list[int]
    suspect: list[int]


def suspicion(tag: str, attributes: str) -> int:
    """0: none; 1: a suspect name inside a longer one, or a form; 2: a suspect by its own name, tag or role; 3: never text."""
    if tag in NEVER:
        return 3
    degree = SUSPECT.get(tag, 0)
    if not attributes or attributes.isspace():
        return degree
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = html.unescape(next((v for v in values if v), "")), name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 3
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 3
        if name == "role" and value.lower().strip() in ROLES:
            degree = 2
        if name in ("class", "id") and tag not in PLAIN:
            if not NAMES.isdisjoint(value.lower().split()):
                degree = 2
            joined_ = CAMEL.sub("-", value).lower()
            if not NAMES.isdisjoint(SPLIT.split(joined_)) or "side-bar" in joined_ or "sign-up" in joined_:
                degree = max(degree, 1)
    return degree


def read_page(page: str) -> Page:
    """The page's text nodes and elements."""
    tags, parent, until, suspect, path = ["#page"], [0], [0], [0], [0]
    stack: list[int] = [0]  # open elements
    places: dict[str, list[int]] = {}  # stack places of the open elements of each tag
    blocks, scopes, rows = [0], [0], [0]  # stack places of open elements that are not inline; that are scopes; that are scopes but no cells
    paths: dict[tuple[int, str], int] = {}
    nodes: list[Node] = []
    block = dropped = links = 0
    at, end = 0, len(page)

    def pop_to(place: int) -> None:
        nonlocal dropped, links
        while len(stack) > place:
            e = stack.pop()
            tag = tags[e]
            until[e] = len(tags) - 1
            places[tag].pop()
            for held in (blocks, scopes, rows):
                if held[-1] == len(stack):
                    held.pop()
            dropped -= suspect[e] == 3
            links -= tag == "a"

    def last(names) -> int:
        """Stack place of the innermost open element of these tags, or -1."""
        return max((places[t][-1] for t in names if places.get(t)), default=-1)

    def add(text: str) -> None:
        if not dropped and text and not text.isspace():
            nodes.append(Node(path[stack[-1]], html.unescape(text) if "&" in text else text, block, stack[-1], links > 0))
        elif not dropped and text and nodes and nodes[-1].block == block:
            nodes[-1].text += " "

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br":
            if nodes and nodes[-1].block == block:
                nodes[-1].text += " "
            continue
        if tag not in INLINE:
            block += 1
        if closing:
            place = last((tag,))
            if place > (blocks[-1] if tag in INLINE else -1):  # a formatting end tag does not leave its block
                pop_to(place)
            continue
        if tag in VOID:
            continue
        if tag not in IN_PARAGRAPH and (place := last(("p",))) > scopes[-1]:
            pop_to(place)
        if tag in ENDS and (place := last(ENDS[tag])) > 0 and place >= rows[-1]:
            pop_to(place)
        degree = suspicion(tag, attributes)
        if tag in RAW and not attributes.rstrip().endswith("/"):  # its content is no markup
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if attributes.rstrip().endswith("/") and tag in ("svg", "path", "use"):
            continue
        place = len(stack)
        places.setdefault(tag, []).append(place)
        if tag not in INLINE:
            blocks.append(place)
        if tag in SCOPES:
            scopes.append(place)
            if tag not in ("td", "th"):
                rows.append(place)
        parent.append(stack[-1])
        path.append(paths.setdefault((path[stack[-1]], tag), len(paths) + 1))
        stack.append(len(tags))
        tags.append(tag)
        until.append(0)
        suspect.append(degree)
        dropped += degree == 3
        links += tag == "a"
    pop_to(1)
    until[0] = len(tags) - 1
    return Page(nodes, tags, parent, until, suspect)


def without_suspects(p: Page) -> list[Node]:
    """The nodes outside those suspect elements that the text does not clear."""
    strong_until, own = -1, [0] * len(p.tags)
    strong = [False] * len(p.tags)  # inside a suspect by its own name
    for e, degree in enumerate(p.suspect):
        strong_until = max(strong_until, p.until[e] if degree == 2 else -1)
        strong[e] = e <= strong_until
    for n in p.nodes:
        if not n.linked:
            own[n.element] += len(n.text.strip())
    # unlinked characters before each element, in the order in which elements open: all, and those outside strong suspects
    whole = list(accumulate(own, initial=0))
    plain = list(accumulate((0 if s else x for x, s in zip(own, strong, strict=True)), initial=0))

    def text(e: int, sums: list[int] = whole) -> int:
        return sums[p.until[e] + 1] - sums[e]

    mains = [0]  # number of article and main elements before each element
    for t in p.tags:
        mains.append(mains[-1] + (t in ("article", "main")))
    written = [text(e) if t in ("article", "main") else 0 for e, t in enumerate(p.tags)]
    best = max(written, default=0)
    base = [0] * len(p.tags)  # nearest article or main element around each element, or the page
    gone_until, out_of = -1, [False] * len(p.tags)
    for e in range(1, len(p.tags)):
        up = p.parent[e]
        base[e] = up if p.tags[up] in ("article", "main") else base[up]
        if e <= gone_until:
            out_of[e] = True
        elif p.suspect[e] in MOST:
            inside = mains[p.until[e] + 1] - mains[e + 1] > 0
            weak = p.suspect[e] == 1
            other = base[e] == 0 and (4 * best > text(e) if weak else best >= ARTICLE)  # an article elsewhere on the page
            sums = plain if weak else whole
            if not inside and (other or text(e, sums) <= MOST[p.suspect[e]] * text(base[e], sums)):
                out_of[e], gone_until = True, p.until[e]
    return [n for n in p.nodes if not out_of[n.element]]


def path_scores(nodes: list[Node]) -> dict[int, float]:
    """Fused, smoothed text and punctuation ratio of each tag path."""
    chars: dict[int, float] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    for n in nodes:
        count[n.path] = count.get(n.path, 0) + 1
        chars.setdefault(n.path, 0.0)
        marks.setdefault(n.path, 0.0)
        if not n.linked:
            chars[n.path] += len(n.text.strip())
            marks[n.path] += len(PUNCTUATION.findall(n.text))
    paths = list(count)
    raw = [chars[p] / count[p] * (1.0 + marks[p] / count[p]) ** 0.5 for p in paths]
    weights = [math.exp(-0.5 * (d / 0.6) ** 2) for d in range(3)]
    out = {}
    for i, p in enumerate(paths):
        near = [(weights[abs(j - i)], raw[j]) for j in range(max(0, i - 2), min(len(raw), i + 3))]
        out[p] = sum(w * x for w, x in near) / sum(w for w, _ in near)
    return out


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order, white space within a block collapsed, joined by a space."""
    read = read_page(page or "")
    nodes = without_suspects(read)
    if not nodes:
        return ""
    scores = path_scores(nodes)
    values = list(scores.values())
    mean = sum(values) / len(values)
    spread = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    threshold = min(spread, 0.5 * max(values)) if len(values) > 1 else 0.0
    chosen = [n for n in nodes if scores[n.path] >= threshold and not n.linked] or [n for n in nodes if scores[n.path] >= threshold]
    region, highest = min(n.element for n in chosen), max(n.element for n in chosen)
    while read.until[region] < highest:  # elements are numbered as they open: the smallest around the first and the last
        region = read.parent[region]
    around, e = None, region
    while e:  # the outermost article or main element around the region
        around = e if read.tags[e] in ("article", "main") else around
        e = read.parent[e]
    if around is not None:
        region = around
    else:
        while region and read.tags[region] not in ("section", "div", "body", "td", "html"):
            region = read.parent[region]
        inside, last = [False] * (len(read.tags) + 1), region  # elements of the articles in the region
        for e in range(region + 1, read.until[region] + 1):
            if e > last and read.tags[e] in ("article", "main"):
                last = read.until[e]
            inside[e] = region < e <= last
        # the region is wider than the page's articles: only they count, if they hold the content
        held = sum(len(n.text) for n in chosen if inside[n.element])
        if held and 2 * held >= sum(len(n.text) for n in chosen):
            return joined([n for n in nodes if inside[n.element]])
    return joined([n for n in nodes if region <= n.element <= read.until[region]])


def joined(nodes: list[Node]) -> str:
    blocks: list[list[str]] = []
    last = None
    for n in nodes:
        if n.block != last:
            blocks.append([])
            last = n.block
        blocks[-1].append(n.text)
    return " ".join(t for b in blocks if (t := " ".join("".join(b).split())))


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: bool = False) -> DataFrame:
    """One row for each page: id, text (main text, empty if none), n_chars (its code points).

    Whole pages; NULL and empty pages give the empty text, a page cut off in the middle is read as far as it goes. With
    ``carry``, the input row comes as the struct ``row`` in place of the id. Ids may be NULL or repeat; an empty table
    gives an empty result. No shuffle. Other columns are not looked at.
    """
    def compute(pages: list) -> list[pa.Array]:
        texts = [main_text(p) for p in pages]
        return [pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())]

    return with_columns(df, id_col, html_col, "text string, n_chars long", ["text", "n_chars"], lambda: compute, carry)
