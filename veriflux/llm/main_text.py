"""Main text of web pages by gradient-boosted trees over DOM nodes.

The model gives each block element the odds that it is, or holds, main text. Decoding is hierarchical: an element that
is cut takes all its descendants along, and the choice that is best over the whole tree is found from the leaves up,
so no part is kept inside a part that is dropped. Inline elements go with the block around them.

There are no labelled pages. The model learns from a bounded sample of pages that say by their own elements (article,
nav, footer, aside, ...) what their parts are; copies of them are rebuilt with neutral elements that carry only
attribute words, or not even these, and with further kinds of boilerplate, so that it doesn't rest on one template.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.llm import dom

SAMPLE = 160
VARIANTS = 4
TOGETHER = 64  # pages whose nodes are scored at once
ROUNDS, DEPTH, BINS, SHRINK, PENALTY = 60, 4, 32, 0.25, 1.0
BOND = 1.0  # odds by which an element goes with the one around it
RESULT = "page_id bigint, url string, text string"
MARKUP = frozenset("script style noscript template iframe svg select button textarea head title".split())  # never text of a page
ASIDE = frozenset("nav header footer aside form menu dialog".split()) | MARKUP  # what teaches that a part is no main text

# Pages that always teach, besides those of the sample: layouts that pages without article elements use.
SEEDS = (
    "<html><body><div class=top><a href=/>Home</a> <a href=/a>News</a></div><article><header><h1>{0}</h1><p>{1}</p></header><p>{2}</p><h2>{3}</h2><ul><li>{4}</li><li>{5}</li></ul>"
    "<table><tr><th>{6}</th><th>{7}</th></tr><tr><td>{8}</td><td>{9}</td></tr></table><p>{10}</p></article><footer>© 2021 {11}</footer></body></html>",
    "<html><body><nav><ul><li><a href=/>{3}</a></li><li><a href=/b>{4}</a></li></ul></nav><article><h1>{0}</h1><dl><dt>{5}</dt><dd>{1}</dd><dt>{6}</dt><dd>{2}</dd></dl><ol><li>{7}</li><li>{8}</li></ol>"
    "<figure><img src=x><figcaption>{9}</figcaption></figure><p>{10}</p></article><aside><h3>Related</h3><ul><li><a href=/c>{11}</a></li></ul></aside></body></html>",
    "<html><body><form action=/><div class=header><a href=/>{3}</a></div><article><h1>{0}</h1><p>{1}</p><p>{2}</p><blockquote><p>{10}</p></blockquote><pre>{8}</pre></article><div class=footer>© {4}</div></form></body></html>",
)
NOTICES = (
    "We use cookies to improve this site. Accept all cookies or read our privacy policy.", "This website uses cookies. By continuing you consent to our use of cookies.",
    "Subscribe to our newsletter and never miss a story.", "Sign up for the newsletter: enter your email address to subscribe.", "Please login or register to post a comment.",
    "Share this page. Follow us. Tweet.", "Advertisement", "Sponsored: promoted content from our partners.", "Copyright 2020. All rights reserved.", "Related stories you may like to read.",
    "Wir verwenden Cookies. Mit Akzeptieren stimmen Sie zu; mehr im Datenschutz.", "Nous utilisons des cookies, accepter ou lire la politique de confidentialité.", "Usamos cookies. Aceptar o leer la política de privacidad.",
    "3 comments. Reply. Great post, thank you!", "Anna says: I read this twice and still do not agree with it. Reply",
)


@dataclass
class Model:
    start: float
    edges: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature and cut of each inner node, value of each leaf
    prior: np.ndarray  # what each feature adds before the trees do

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the odds."""
        binned = _binned(x, self.edges)
        out = self.start + x @ self.prior
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[np.arange(len(x)), feature[at]] > cut[at])
            out += value[at - len(feature)]
        return out


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.int16)


def boost(x: np.ndarray, y: np.ndarray, prior: np.ndarray | None = None) -> Model:
    """Second-order boosting of the logistic loss; complete trees of DEPTH levels on binned features. The trees start from
    the mean and the prior weights of the features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    binned, n, width = _binned(x, edges), len(x), BINS + 1
    mean = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    model = Model(float(np.log(mean / (1 - mean))), edges, [], np.zeros(x.shape[1]) if prior is None else prior)
    score = model.start + x @ model.prior
    for _ in range(ROUNDS if n else 0):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p)
        feature, cut, at = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, width, np.int64), np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            for j in range(x.shape[1]):
                if not len(edges[j]):
                    continue
                cell = (at - first) * width + binned[:, j]
                g = np.bincount(cell, slope, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(cell, bend, count * width).reshape(count, width).cumsum(1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + PENALTY) + rest_g**2 / (rest_h + PENALTY) - g[:, -1:] ** 2 / (h[:, -1:] + PENALTY)
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best
                best[better] = top[better]
                feature[first : first + count][better], cut[first : first + count][better] = j, k[better]
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > cut[at])
        leaf = at - len(feature)
        value = SHRINK * np.bincount(leaf, slope, 2**DEPTH) / (np.bincount(leaf, bend, 2**DEPTH) + PENALTY)
        model.trees.append((feature, cut, value))
        score += value[leaf]
    return model


def decode(page: dom.Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the most probable choice in which nothing below a cut node is kept."""
    n = len(page.tag)
    block = [name not in dom.INLINE for name in page.tag]
    never = [name in MARKUP for name in page.tag]
    keep_gain = [o + BOND if b else 0.0 for o, b in zip(odds.tolist(), block, strict=True)]
    gain = [0.0] * n  # of the best choice below and at a node over cutting it
    kept = [False] * n
    for i in range(n - 1, -1, -1):
        total = keep_gain[i] + gain[i]
        kept[i] = i == 0 or (total > 0 or not block[i]) and not never[i]
        if i and kept[i]:
            gain[page.parent[i]] += max(total, 0.0)
    for i in range(1, n):
        kept[i] = kept[i] and kept[page.parent[i]]
    return np.array(kept)


def extract(texts: list[str | None], model: Model) -> list[str]:
    """Main text of pages; their nodes are scored together."""
    pages = [dom.parse(t or "") for t in texts]
    if not pages:
        return []
    seen = [dom.features(p) for p in pages]
    odds = np.split(model.odds(np.concatenate(seen)), np.cumsum([len(x) for x in seen])[:-1])
    return [dom.blocks(p, decode(p, o)) for p, o in zip(pages, odds, strict=True)]


# Training pages.

_WORDS = {"body": ("content", "post-content", "entry", "article-body", "story", "main-text", "prose"), "nav": ("menu", "navbar", "topnav", "breadcrumbs"),
          "footer": ("footer", "site-footer", "legal", "bottom"), "header": ("masthead", "header", "banner"), "aside": ("sidebar", "related", "widget", "recommended")}
SEEDED = 24
PRIOR = np.zeros(dom.N_FEATURES)  # elements that say what they are; trees may overrule them
PRIOR[[dom.TAGS.index(t) for t in ("nav", "footer", "aside")]] = -4.0
PROSE = "It was late in the year when they came back to the old house by the river, and nothing there had changed, or so it seemed to them at first. " * 4
_MORE = ("comments", "comment-list", "comments", "reader-comments", "discussion", "cookie-notice", "consent", "newsletter", "subscribe-box", "promo", "sponsored", "share", "share-buttons", "ad", "ad-slot", "login-form", "search", "popular-posts")


def _labels(page: dom.Page) -> np.ndarray | None:
    """1 for article elements with all that they hold and what holds them, 0 for the rest; None if there is none."""
    n = len(page.tag)
    inside = [False] * n
    for i in range(1, n):
        p = page.parent[i]
        purpose = dom.purposes(page.names[i])
        own_header = page.tag[i] == "header" and inside[p]  # an article's own heading
        bad = page.tag[i] in ASIDE and not own_header or purpose and not purpose & 1
        inside[i] = (inside[p] or page.tag[i] in ("article", "main")) and not bad
    y = np.array(inside, float)
    if not y.any():
        return None
    for i in range(n - 1, 0, -1):
        if y[i]:
            y[page.parent[i]] = 1
    return y


def _varied(page: dom.Page, y: np.ndarray, others: list[str], rng: random.Random) -> tuple[dom.Page, np.ndarray]:
    """The page with other elements and more boilerplate around the same text."""
    plain, worded, wrapped, short = rng.random() < 0.6, rng.random() < 0.8, rng.random() < 0.15, rng.random() < 0.2
    out, labels, at = dom.Page(), [1.0], {0: 0}
    top = next((i for i, t in enumerate(page.tag) if t in ("article", "main")), -1)

    def add(tag: str, parent: int, names: str, label: float) -> int:
        out.tag.append(tag)
        out.parent.append(parent)
        out.names.append(names)
        labels.append(label)
        return len(out.tag) - 1

    def some(count: int) -> str:
        words = rng.choice(others).split()
        k = rng.randrange(max(1, len(words) - 40))
        return " ".join(words[k : k + count])

    def extra(parent: int) -> None:
        name = rng.choice(_MORE)
        tag = rng.choice(("form", "section", "div", "aside")) if "form" not in name else "form"
        if rng.random() < 0.2:  # a notice that nothing but its text gives away
            box = add("div", parent, "", 0.0)
            out.pieces.append((add("p", box, "", 0.0) if rng.random() < 0.5 else box, rng.choice(NOTICES)))
            return
        box = add(tag, parent, name if tag in ("div", "section") or rng.random() < 0.5 else "", 0.0)
        for _ in range(rng.randint(1, 6)):
            item = box if rng.random() < 0.25 else add(rng.choice(("p", "li", "div")), box, rng.choice(("", "", "item")), 0.0)
            if out.tag[item] == "div" and rng.random() < 0.5:
                item = add("p", item, "", 0.0)
            out.pieces.append((item, rng.choice(NOTICES) if rng.random() < 0.5 else some(rng.randint(2, 40))))

    by_node: dict[int, list[str]] = {}
    for node, text in page.pieces:
        if node != dom.BREAK:
            by_node.setdefault(node, []).append(text)
    for i in range(1, len(page.tag)):
        tag, names = page.tag[i], page.names[i]
        kind = {"article": "body", "main": "body"}.get(tag, tag)
        if kind in _WORDS and plain:
            tag, names = rng.choice(("div", "section", "div")), rng.choice(_WORDS[kind]) if worded or kind != "body" else ""
        parent = at[page.parent[i]]
        if y[i] and tag == "p" and rng.random() < 0.3:
            tag = rng.choice(("li", "li", "blockquote", "h2", "h3", "div", "pre", "td", "th", "dt", "dd", "figcaption", "p"))
            names = rng.choice(("", "", "lead", "text"))
            holders = {"li": (rng.choice(("ul", "ol")),), "td": ("table", "tr"), "th": ("table", "tr"), "dt": ("dl",), "dd": ("dl",), "figcaption": ("figure",)}
            for holder in holders.get(tag, ()):
                parent = add(holder, parent, "", 1.0)
            for _ in range(rng.choice((0, 1, 3)) if tag in holders else 0):  # short neighbours
                out.pieces.append((add(tag, parent, "", 1.0), some(rng.randint(1, 9))))
        if i == top:
            for _ in range(rng.randint(0, 2)):
                extra(parent)
            if wrapped:  # pages that are one form
                parent = add("form", parent, "", 1.0)
            if rng.random() < 0.5:
                parent = add("div", parent, rng.choice(("wrapper", "container", "main", "")), 1.0)
                if rng.random() < 0.5:
                    extra(parent)
        at[i] = add(tag, parent, names, float(y[i]))
        if i in page.raw:
            out.raw.add(at[i])
        quotes = y[i] and page.tag[i] == "p" and rng.random() < 0.12
        for text in by_node.get(i, ()):  # short articles are main text too, and so is what an article says of cookies
            out.pieces.append((at[i], rng.choice(NOTICES)) if quotes else (at[i], " ".join(text.split()[: rng.randint(1, 8)]) if short and y[i] and not text.isspace() else text))
        for _ in range(rng.choice((0, 0, 1, 2)) if i == top else 0):
            extra(at[i])
    if top > 0:
        for _ in range(rng.randint(0, 3)):
            extra(at[page.parent[top]])
        if rng.random() < 0.3:
            extra(at[top])
    return out, np.array(labels)


def fit(pages: list[str], seed: int = 7) -> Model:
    """From pages with article elements, and the layouts of SEEDS filled with words of these pages."""
    rng, xs, ys = random.Random(seed), [], []
    parsed = [(p, y) for p in map(dom.parse, pages) if (y := _labels(p)) is not None]
    others = [t for p, _ in parsed for n, t in p.pieces if n != dom.BREAK and len(t) > 40 and n not in p.raw] or [PROSE]

    def words(low: int, high: int) -> str:
        found = html.escape(rng.choice(others)).split()
        at = rng.randrange(max(1, len(found) - high))
        return " ".join(found[at : at + rng.randint(low, high)])

    for k in range(max(SEEDED, len(parsed) // 4)):
        lengths = ((4, 9), (15, 60), (30, 90), (1, 4), (2, 14), (2, 14), (1, 3), (1, 3), (1, 9), (3, 12), (20, 70), (3, 9))
        page = dom.parse(SEEDS[k % len(SEEDS)].format(*(words(*n) for n in lengths)))
        parsed.append((page, _labels(page)))
    for page, y in parsed:
        for k in range(1 + VARIANTS):
            shown, labels = (page, y) if not k else _varied(page, y, others, rng)
            block = np.array([name not in dom.INLINE for name in shown.tag])
            xs.append(dom.features(shown)[block])
            ys.append(labels[block])
    return boost(np.concatenate(xs), np.concatenate(ys), PRIOR)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([_labels(dom.parse(h.as_py())) is not None for h in batch.column("h")], pa.bool_()))


def train(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` pages with labels, drawn by a hash of their content from all such pages.

    Pages whose text names an article or main element are counted; whether it is one that labels the page, and not part
    of a comment or a list of comments, is found by reading pages in the order of their hashes, in shares that grow until
    there are enough of them. Without any, the layouts of SEEDS alone teach the model.
    """
    page = pages[html_col].cast("string")
    named = pages.select(page.alias("h"), F.xxhash64(page).alias("k")).filter(F.col("h").rlike("(?i)<(article|main)"))
    share, drawn = min(1.0, 4 * sample / max(named.count(), 1)), []
    while True:
        some = named.filter(F.col("k") <= int(share * (1 << 64)) - (1 << 63)) if share < 1 else named
        drawn = some.mapInArrow(_labelled, "h string, k bigint").orderBy("k", "h").limit(sample).collect()
        if len(drawn) >= sample or share >= 1:
            return fit([r.h for r in drawn])
        share = min(1.0, 16 * share)


def _extract(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t for k in range(0, batch.num_rows, TOGETHER) for t in extract(batch.column("html").slice(k, TOGETHER).to_pylist(), model)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: the blocks of main text, one line each, in page order.

    Null and empty pages, and pages without main text, give an empty text. Character references are decoded after
    markup is read; white space inside a block becomes one space. Malformed markup is read as far as it makes sense.
    Ids and addresses may be null or repeat; other columns are not read; an empty table gives no rows.
    """
    columns = (pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    held = pages.sparkSession.sparkContext.broadcast(model)
    return pages.select(*columns).mapInArrow(lambda batches: _extract(batches, held.value), RESULT)
