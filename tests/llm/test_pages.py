"""Main text of hand-written pages of several layouts, the reader's repairs, and the model's parts against plain versions."""

import itertools

import numpy as np
import pytest

from veriflux.llm import dom, main_text

A = "The river had risen again during the night, and by morning the lower fields were under water, as they had been the year before."
B = "Nobody in the village was surprised. They had carried their things upstairs in the evening, and now they waited, drinking tea."
C = "On the third day the rain stopped, the water went back, and what it left behind was mud, driftwood and a small wooden boat."
KEPT = ("Flood", A, B, C)

PAGES = {
    "blog": (f"""<!doctype html><html><head><title>t</title></head><body><div id="navbar"><ul><li><a href=/>Home</a><li><a href=/b>Blog</a><li><a href=/c>About</a></ul></div>
      <div class="wrapper"><div class="post-content"><h1>Flood</h1><p>{A}</p><p>{B}</p><p>{C}</p></div>
      <div class="sidebar"><h3>Recent posts</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></div></div>
      <div class="footer">© 2020 Somebody. All rights reserved.</div></body></html>""", KEPT),
    "no head end": (f"""<html><head><meta charset=utf-8><title>t</title><body><nav><a href=/>Home</a> <a href=/x>More</a></nav>
      <article><h1>Flood</h1><p>{A}</p><p>{B}</p><p>{C}</p></article><footer>© 2020</footer>""", KEPT),
    "one form": (f"""<html><head><title>t</title></head><body><form id=aspnetForm method=post action=/><input type=hidden name=v value=1>
      <div class=menu><a href=/>Home</a> <a href=/x>More</a></div><article><h1>Flood</h1><p>{A}</p><p>{B}</p><p>{C}</p></article>
      <div class=footer>Copyright, all rights reserved</div></form></body></html>""", KEPT),
    "lists": (f"""<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/d>Docs</a></li></ul></nav><article><h1>Flood</h1><p>{A}</p>
      <ul><li>bring the boat</li><li>{B}</li></ul><table><tr><th>Day</th><th>Height of the water</th></tr><tr><td>Monday</td><td>two metres and more</td></tr></table>
      <dl><dt>driftwood</dt><dd>{C}</dd></dl></article><footer>© 2020 Somebody</footer></body></html>""",
      ("Flood", A, "bring the boat", B, "Day", "Height of the water", "Monday", "two metres and more", "driftwood", C)),
    "news": (f"""<html><body><div>We use cookies. Accept all cookies or read our privacy policy.</div><header class=site><a href=/>The Paper</a></header>
      <article><header><h1>Flood</h1></header><p>{A}</p><p>{B}</p><p>{C}</p>
      <section id=comments><h2>2 comments</h2><div><p>Anna: I have never seen that much water, thanks for the report.</p></div><div><p>Ben: me neither, we had to leave too.</p></div></section></article>
      <aside class=related><h3>Related</h3><a href=/1>Another flood</a></aside><footer>© 2020</footer></body></html>""", KEPT),
    "main": (f"""<html><body><header><nav><a href=/>Home</a></nav></header><main><h1>Flood</h1><p>{A}</p><div class="share-buttons"><a href=/s>Share</a> <a href=/t>Tweet</a></div>
      <p>{B}</p><p>{C}</p></main><div class="newsletter"><p>Subscribe to our newsletter.</p><form><input name=mail><button>Subscribe</button></form></div></body></html>""", KEPT),
}


@pytest.fixture(scope="module")
def model(spark):
    return main_text.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_layouts(model, name):
    page, kept = PAGES[name]
    assert main_text.extract([page], model) == ["\n".join(kept)]


def test_layouts_without_labelled_pages():
    """The layouts that always teach are enough for most."""
    model = main_text.fit([])
    right = sum(main_text.extract([page], model) == ["\n".join(kept)] for page, kept in PAGES.values())
    assert right >= len(PAGES) - 2


def text_of(html):
    page = dom.parse(html)
    return dom.blocks(page, np.ones(len(page.tag), bool))


def test_attributes_with_quotes():
    assert text_of("<p title=don't>one</p><p>it's</p>") == "one\nit's"
    assert text_of("<p title='a>b' alt=\"c>d\" x = 'e' y>one</p>") == "one"
    assert text_of('<p title="open>one</p> two') in ("one\ntwo", "two", "")
    assert text_of("<a href=x/y?z=1&b='q'>one</a><br/>two<p =x>three") == "one\ntwo\nthree"


def test_implied_ends():
    page = dom.parse("<head><title>t</title><body><p>one<button>two<p>three</p><select><option>a<option>b<div>four</div>")
    parents = {page.tag[i]: page.tag[page.parent[i]] for i in range(1, len(page.tag))}
    assert parents["body"] == "#page" and parents["div"] != "select" and parents["button"] == "p"
    assert main_text.extract([f"<body><article><h1>Flood</h1><p>{A}</p><button>Like<p>{B}</p><p>{C}</p></article>"], main_text.fit([]))[0].endswith(f"{B}\n{C}")
    assert dom.parse("<head>text").tag[dom.parse("<head>text").pieces[-1][0]] == "#page"


def test_decoding_is_the_best_of_all_choices():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(2, 9))
        page = dom.Page()
        for i in range(1, n):
            page.tag.append(str(rng.choice(["div", "p", "b", "script"])))
            page.parent.append(int(rng.integers(0, i)))
            page.names.append("")
        odds = rng.normal(-1, 2, n)
        block = [t not in dom.INLINE for t in page.tag]

        def value(kept):
            return sum(odds[i] + main_text.BOND for i in range(1, n) if kept[i] and block[i])

        best = -np.inf
        for choice in itertools.product((False, True), repeat=n - 1):
            kept = (True, *choice)
            legal = all(not kept[i] or kept[page.parent[i]] and page.tag[i] not in main_text.MARKUP for i in range(1, n))
            # Inline elements have no say of their own: they stay with what is around them.
            legal = legal and all(kept[i] or not kept[page.parent[i]] or block[i] for i in range(1, n))
            if legal:
                best = max(best, value(kept))
        got = main_text.decode(page, odds)
        assert value(got) == pytest.approx(best)


def test_first_split_of_boosting_is_the_best_one():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (200, 3)).astype(float)
    y = (x[:, 1] + rng.normal(0, 1, 200) > 3).astype(float)
    model = main_text.boost(x, y)
    p = y.mean()
    g, h = y - p, np.full(200, p * (1 - p))

    def gain(mask):
        return sum(g[m].sum() ** 2 / (h[m].sum() + main_text.PENALTY) for m in (mask, ~mask))

    best = max((gain(x[:, j] <= c), j, c) for j in range(3) for c in range(5))
    feature, cut, _ = model.trees[0]
    assert gain(x[:, feature[0]] <= model.edges[feature[0]][cut[0]]) == pytest.approx(best[0])
    assert ((model.odds(x) > 0) == (y > 0)).mean() > 0.8


def test_odd_pages(spark, model):
    """Nulls, empty and very long pages, repeated rows and ids, columns with clashing names, an empty table."""
    page, kept = PAGES["blog"]
    long = f"<html><body><article><h1>Flood</h1>{''.join(f'<p>{A} {i}.</p>' for i in range(4000))}</article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, "u", None), (3, "u", ""), (4, "u", "plain text"), (5, "u", long), (6, "u", "<" * 3000), (7, "u", "<div>" * 3000 + "x")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, h int")
    got = sorted(((r.page_id, r.text) for r in main_text.extract_main_text(df, model).collect()), key=str)
    assert len(got) == len(rows) and [t for i, t in got if i in (1, None)] == ["\n".join(kept)] * 3
    assert {t for i, t in got if i in (2, 3)} == {""} and dict(got)[5].count("\n") == 4000
    assert main_text.extract_main_text(df.limit(0), model).count() == 0
