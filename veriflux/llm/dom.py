"""A small tolerant HTML reader: a page becomes arrays of nodes, with what the main-text model needs to know of each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CONTROLS = {"button": CLOSES_P | {"button"}, "select": CLOSES_P | {"select", "input", "textarea", "button"}}  # what ends an open one
# A quote opens a value only where a value begins, behind an equals sign.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</?([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?|=)*+)>", re.S)
_NAMES = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SAID = re.compile(r"[^\W\d_]{4,}|©")

TAGS = tuple("html body article main section div p h1 h2 h3 h4 ul ol li a nav header footer aside form table tr td th dl dt dd figure figcaption blockquote pre b".split())
# Words of attributes that tell a part's purpose; the model weighs them.
PURPOSE = {
    "body": "article content post entry story text body main page copy paragraph prose read",
    "menu": "menu nav navigation navbar breadcrumb breadcrumbs toc pagination pager tabs links skip topbar",
    "edge": "header footer masthead banner copyright foot head logo site bottom top legal",
    "side": "sidebar side aside rail widget related recommended more popular trending recent tags archive author bio",
    "sold": "ad ads advert advertisement adverts sponsor sponsored promo promotion promoted dfp sponsors deal",
    "said": "comment comments reply replies discussion respond disqus thread reader response feedback",
    "note": "cookie cookies notice consent gdpr alert popup modal overlay newsletter subscribe banner disclaimer signup warning privacy",
    "form": "form search login input signin register button share social follow tools print",
}
KINDS = tuple(PURPOSE)
_PURPOSES: dict[str, int] = {}  # bit sets
for _k, _words in enumerate(PURPOSE.values()):
    for _w in _words.split():
        _PURPOSES[_w] = _PURPOSES.get(_w, 0) | 1 << _k
# Words that notices, forms and edges use in their text; the model weighs them too.
SPOKEN = frozenset((
    "cookie cookies consent accept privacy policy gdpr subscribe newsletter signup login logout password username register copyright rights reserved "
    "share tweet follow reply replies comment comments posted advertisement sponsored promoted related trending read menu search submit cancel "
    "datenschutz akzeptieren anmelden abonnieren kommentar antworten accepter confidentialité abonnez connexion commentaires répondre aceptar "
    "privacidad suscríbete comentarios responder publicidad anzeige ©"
).split())
N_FEATURES = len(TAGS) + 2 * len(KINDS) + 16


BREAK = -1  # stands among the pieces wherever a block begins or ends


@dataclass
class Page:
    """Nodes in page order; node 0 is the page. pieces: (node, text). raw: nodes whose content isn't text."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    names: list[str] = field(default_factory=lambda: [""])
    pieces: list[tuple[int, str]] = field(default_factory=list)
    raw: set[int] = field(default_factory=set)


_TAG_PURPOSE = {t: 1 << KINDS.index(kind) for t, kind in (
    ("article", "body"), ("main", "body"), ("nav", "menu"), ("menu", "menu"), ("header", "edge"), ("footer", "edge"),
    ("aside", "side"), ("form", "form"), ("dialog", "note"),
)}


@lru_cache(1 << 14)
def purposes(names: str) -> int:
    """What attribute words say of a part, as a set of bits."""
    found = 0
    for word in _TOKEN.findall(names):
        found |= _PURPOSES.get(word.lower(), 0)
    return found


def _names(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    return " ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes))


def parse(text: str) -> Page:
    """Never fails: stray end tags are ignored, open elements end with the page, paragraphs and list items end where
    the next begins, and an unclosed inline element ends with the block around it."""
    page, at, open_ = Page(), 0, [0]
    tag, parent = page.tag, page.parent
    size = len(text)

    def close(names: tuple[str, ...], holders: tuple[str, ...] | frozenset = ()) -> None:
        for k in range(len(open_) - 1, 0, -1):
            name = tag[open_[k]]
            if name in names:
                del open_[k:]
                return
            if name in holders:
                return

    while at < size:
        m = _TAG.search(text, at)
        if not m:
            if not text[at:].isspace():
                close(("head",))
            page.pieces.append((open_[-1], text[at:]))
            break
        if m.start() > at:
            if not text[at : m.start()].isspace():
                close(("head",))  # text ends an open head
            page.pieces.append((open_[-1], text[at : m.start()]))
        at = m.end()
        name = m[1]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            page.pieces.append((BREAK, ""))
        if text[m.start() + 1] == "/":
            if name == "br" or name not in VOID:
                close((name,), frozenset(("table", "article", "#page")) if name in INLINE else ("#page",))
            continue
        if name not in HEAD:
            close(("head",))
        for control, ends in CONTROLS.items():
            if name in ends:
                close((control,), ("#page", "form", "td", "div"))
        if name in CLOSES_P:
            close(("p",), ("article", "section", "div", "td", "li", "body", "table", "aside", "main", "blockquote"))
        if name in SAME_ENDS:
            close(SAME_ENDS[name], HOLDS[name])
        node = len(tag)
        tag.append(name)
        parent.append(open_[-1])
        page.names.append(_names(m[2]))
        if name in RAW:
            page.raw.add(node)
            end = re.compile(f"</{name}\\s*>", re.I).search(text, at)
            at = end.end() if end else size
        elif name not in VOID and not m[2].rstrip().endswith("/"):
            open_.append(node)
    return page


_TAG_NO = {t: k for k, t in enumerate(TAGS)}


def features(page: Page) -> np.ndarray:
    """Per node: tag, purposes named by its own and by its ancestors' attributes, depth, place among its siblings,
    size and density of its subtree."""
    n = len(page.tag)
    tags, parents = page.tag, page.parent
    depth, nth, children, own_kinds, above, in_link = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        in_link[i] = in_link[p] or tags[i] == "a"
        nth[i] = children[p]
        children[p] += 1
        above[i] = above[p] | own_kinds[p]
        own_kinds[i] = _TAG_PURPOSE.get(tags[i], 0) | (purposes(page.names[i]) if page.names[i] else 0)
    own, linked, marks, spoken = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for node, text in page.pieces:
        if node == BREAK or text.isspace():
            continue
        own[node] += len(text)
        if in_link[node]:
            linked[node] += len(text)
        marks[node] += text.count(". ") + text.count(", ")
        spoken[node] += sum(w in SPOKEN for w in _SAID.findall(text.lower()))
    total, nodes, paragraphs = own.copy(), [1.0] * n, [1.0 if t == "p" else 0.0 for t in tags]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        total[p] += total[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
        spoken[p] += spoken[i]
        nodes[p] += nodes[i]
        paragraphs[p] += paragraphs[i]
    t, k = len(TAGS), len(KINDS)
    out = np.zeros((n, N_FEATURES), np.float32)
    known = np.array([_TAG_NO.get(x, -1) for x in tags])
    out[np.flatnonzero(known >= 0), known[known >= 0]] = 1
    bits = np.arange(k)
    out[:, t : t + k] = np.array(own_kinds)[:, None] >> bits & 1
    out[:, t + k : t + 2 * k] = np.array(above)[:, None] >> bits & 1
    parent, own, total, links, sentences, nodes, paragraphs, depth, nth, children, spoken = (
        np.array(x) for x in (parents, own, total, linked, marks, nodes, paragraphs, depth, nth, children, spoken)
    )
    whole, up = max(1.0, total[0]), np.maximum(parent, 0)
    rest = out[:, t + 2 * k :]
    rest[:, 0], rest[:, 1] = depth, nth
    rest[:, 2] = children
    rest[:, 3] = children[up]
    rest[:, 4] = np.log1p(total)
    rest[:, 5] = total / whole
    rest[:, 6] = total / np.maximum(1, total[up])
    rest[:, 7] = links / np.maximum(1, total)
    rest[:, 8] = total / nodes
    rest[:, 9] = sentences / np.maximum(1, total) * 100
    rest[:, 10] = np.log1p(paragraphs)
    rest[:, 11] = links[up] / np.maximum(1, total[up])
    rest[:, 12] = np.log1p(own)
    rest[:, 13] = paragraphs[up]
    rest[:, 14] = spoken / np.maximum(1, total) * 100
    rest[:, 15] = (spoken / np.maximum(1, total) * 100)[up]
    return out


def blocks(page: Page, keep: np.ndarray) -> str:
    """The text of kept nodes: one line for each block, white space inside a block as one space."""
    lines: list[list[str]] = [[]]
    for node, text in page.pieces:
        if node == BREAK:
            if lines[-1]:
                lines.append([])
        elif keep[node] and node not in page.raw:
            lines[-1].append(text)
    joined = (" ".join(html.unescape("".join(line)).split()) for line in lines)
    return "\n".join(line for line in joined if line)
