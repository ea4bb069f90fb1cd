"""Main texts of deep pages, of equal texts in other slots and of long lists of children."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from folioforge.llm import html


def test_deep_elements_close_only_themselves():
    page = "<div id=wrap><article>" + "<div>" * 250 + "deep" + "</div>" * 250 + "<p>rest</article></div><p>after"
    assert html.extract([page]) == ["deep\nrest"]
    menu = "<nav>" + "<div>" * 250 + "deep" + "</div>" * 250 + "<p>more menu</nav><p>text"
    assert html.extract([menu]) == ["text"]
    assert html.extract(["<div>" * 500 + "<nav>menu</nav>text" + "</div>" * 500 + "<p>after"]) == ["text\nafter"]


def test_only_aligned_texts_are_template():
    """A heading, list item or cell that says what a menu or notice says is content."""
    page = "<nav><ul><li>News<li>Sport<li>Contact</ul></nav><div><h1>%s</h1><p>%s</p><p>%s</p></div><div class=end>Sport and more</div>"
    rows = [(f"Title {i}", f"text {i} of the page " * 4, f"last words {i}") for i in range(8)]
    rows[2] = ("News", rows[2][1], "Sport and more")
    got = html.extract([page % r for r in rows])
    assert [g.split("\n") for g in got] == [[t.strip() for t in r] for r in rows]


def test_long_pages_have_a_template():
    """Every page has more blocks, and more children of one element, than a small table takes."""
    pages = []
    for i in range(6):
        n = 1100 + 7 * i
        pages.append("<div><p>Welcome all</p>" + "".join(f"<p>row {i} {k}</p>" for k in range(n)) + "<p>Closing notice</p></div>")
    for i, text in enumerate(html.extract(pages)):
        assert text.split("\n") == [f"row {i} {k}" for k in range(1100 + 7 * i)]


def test_large_tables_are_exact(monkeypatch):
    rng = random.Random(7)

    def page():
        make = lambda: rng.choice([f"<p>{rng.choice('abcdef')}</p>", f"<li>{rng.randrange(30)}<b>x</b>", f"<table><tr><td>{rng.choice('abc')}<td>{rng.choice('xyz')}</table>", f"<div>{rng.choice('ab')}<p>{rng.choice('cd')}</div>", rng.choice("pq")])
        return html.parse("<div>" + "".join(make() for _ in range(rng.randrange(70))) + "</div>")

    for _ in range(40):
        a, b = page(), page()
        found = []
        for most in (10**9, 0):
            monkeypatch.setattr(html, "TABLE", most)
            pairs = []
            html.align(a, b, pairs, {}, html.Pair(html.texts_of(a, []), html.texts_of(b, [])))
            found.append([(id(p), id(q)) for p, q in pairs])
        assert found[0] == found[1]


def best(p, q):
    """Simple tree matching by trying every order-keeping matching of the children."""
    if type(p) is not html.Node or type(q) is not html.Node:
        return 0 if type(p) is not type(q) else 2 if p[0] == q[0] else 1
    if p.kind != q.kind:
        return 0
    x, y, most = p.children, q.children, 0
    for k in range(min(len(x), len(y)) + 1):
        for a in itertools.combinations(x, k):
            for b in itertools.combinations(y, k):
                values = [best(u, v) for u, v in zip(a, b, strict=True)]
                if all(values):
                    most = max(most, sum(values))
    return 1 + most


@pytest.mark.parametrize("table", [2500, 0])
def test_tree_matching_against_brute_force(monkeypatch, table):
    monkeypatch.setattr(html, "TABLE", table)
    rng = random.Random(5)

    def made(depth):
        inner = "".join(made(depth - 1) if depth and rng.random() < 0.6 else f"<p>{rng.choice('abc')}</p>" for _ in range(rng.randrange(4)))
        return f"<{(tag := rng.choice(['div', 'section']))}>{inner}</{tag}>"

    for _ in range(150):
        a, b = html.parse(made(2)), html.parse(made(2))
        known = html.Pair(html.texts_of(a, []), html.texts_of(b, []))
        assert html.weight(a, b, known) == best(a, b)
        pairs, elements = [], {}
        html.align(a, b, pairs, elements, known)
        assert len(elements) + sum(2 if p[0] == q[0] else 1 for p, q in pairs) == best(a, b)


@pytest.mark.parametrize("held", [1 << 18, 0])
def test_elements_inside_others_are_matched_once(monkeypatch, held):
    """Nested elements' tables and weights are kept, or (without room for tables) made twice at most, not once for each level around them."""
    monkeypatch.setattr(html, "HELD", held, raising=False)
    calls, tell = [], html.weight
    monkeypatch.setattr(html, "weight", lambda *a: calls.append(1) or tell(*a))
    a, b = ("<div>" * 12 + "".join(f"<p>{name}{i}</p><ul><li>x<li>y</ul>" for i in range(15)) + "</div>" * 12 for name in "ab")
    a, b, pairs = html.parse(a), html.parse(b), []
    html.align(a, b, pairs, {}, html.Pair(html.texts_of(a, []), html.texts_of(b, [])))
    assert len(pairs) == 45 and len(calls) < 10_000


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def plain_pages(rng, n):
    """Pages whose tags and classes tell nothing: menu, notice, title and text, remarks; all of them vary."""
    pages, texts = [], []
    for _ in range(n):
        title, body = words(rng, 6), [words(rng, rng.randrange(1, 120)) for _ in range(rng.randrange(1, 5))]
        menu = "".join(f"<li><a href=/{i}>{words(rng, 1)}</a>" for i in range(rng.randrange(3, 8)))
        inner = f"<h1>{title}</h1>" + "".join(f"<p>{x}</p>" for x in body) + "<p>Written for you</p>"
        pages.append(f"<div><div class=a1><ul>{menu}</ul></div><div class=b2>{words(rng, 9)}</div><div class=c3>{inner}</div><div class=d4>{words(rng, 8)}</div></div>")
        texts.append("\n".join([title, *body]))
    return pages, texts


def test_the_slot_is_induced_without_names():
    pages, texts = plain_pages(random.Random(1), 30)
    assert html.extract(pages) == texts
    alone = html.extract(pages, induced=False)
    assert sum(a != t for a, t in zip(alone, texts, strict=True)) == 30  # without induction what all pages say stays, too


def test_headings_beside_the_slot_stay():
    rng = random.Random(2)
    rows = [(words(rng, 5), words(rng, 80), words(rng, 70), words(rng, 6)) for _ in range(12)]
    pages = ["<body><div class=q>%s</div><h1>%s</h1><div class=r><p>%s</p><p>%s</p></div></body>" % (r[3], *r[:3]) for r in rows]
    assert html.extract(pages) == ["\n".join(r[:3]) for r in rows]


@pytest.mark.parametrize("page, want", [
    ('<div class="layout has-sidebar"><article><h1>T</h1><p>text</p></article></div>', "T\ntext"),
    ('<div class="sidebar-wrapper"><main><p>text</p></main></div>', "text"),
    ('<article><section class="promontory-walk"><p>one</p></section><p class="footnote note">two</p><div class="social history">three</div></article>', "one\ntwo\nthree"),
    ('<article><p>text of some length here</p><div class="social-share">x</div><div id=comments><p>nice</p></div><section class="adRow">y</section></article>', "text of some length here"),
    ('<article><header><h1>T</h1></header><p>text</p><nav>more</nav><aside>side</aside></article><header>site</header>', "T\ntext"),
    ("<article hidden><p>no</p></article><p>yes</p>", "yes"),
    ("<table><tr><td><ul><li><a href=x>one</a></ul><td><p>" + "long text " * 40 + "</table>", ("long text " * 40).strip()),
    ('<div class=comment-list><p>a reader says a lot, more than the article</p></div><div><p>short article</p></div>', "short article"),
    ('<div class=comment-list><p>' + "this is the page " * 20 + '</p></div><p>end</p>', ("this is the page " * 20).strip()),
])
def test_names_are_only_a_prior(page, want):
    """On a page alone. An element that is nearly all of the page isn't left out for its name."""
    assert html.extract([page]) == [want]


def test_ambiguous_names_need_a_recurring_slot():
    """Outside an article, where the same elements on all pages are the template's; in one they are articles' own parts."""
    rng = random.Random(3)
    page = '<div><h1>%s</h1><p>%s</p><p>%s</p>%s</div>'
    rows = [(words(rng, 4), words(rng, 60), words(rng, 50)) for _ in range(10)]
    every = [page % (*r, f'<div class="social bloom">{words(rng, 5)}</div>') for r in rows]
    assert html.extract(every) == ["\n".join(r) for r in rows]
    once = [page % (*r, '<div class="social bloom">on social life</div>' if i == 4 else "") for i, r in enumerate(rows)]
    assert html.extract(once)[4].endswith("\non social life")


def test_equal_pages_are_in_no_single_task(spark, monkeypatch):
    """Of equal pages one goes to a group; the text comes back to all of them, in tasks of bounded size."""
    monkeypatch.setattr(html, "TOGETHER", 50)
    pages, texts = plain_pages(random.Random(4), 20)
    rows = [(i, "http://h.org/x", pages[0] if i % 3 else pages[i % 20]) for i in range(900)] + [(None, None, None)] * 40
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("one", F.lit("clash")).repartition(4)
    got = html.main_text(df, ["page_id", "url", "one"])
    assert got.columns == ["page_id", "url", "one", "text"]
    rows_got = got.collect()
    assert len(rows_got) == 940 and all(r.text == ("" if r.page_id is None else texts[0 if r.page_id % 3 else r.page_id % 20]) for r in rows_got)
    assert len({r.text for r in rows_got}) == 21


TITLE = "A title of page %d"
KEPT = {
    "header of the entry": f'<header class="entry-header"><h1>{TITLE}</h1></header>', "div of the entry": f'<div class="entry-header"><h1>{TITLE}</h1></div>', "article's banner": f'<div class="article-banner"><h1>{TITLE}</h1></div>',
    "header of the post": f'<header class="post-header"><h1>{TITLE}</h1></header>', "div of the post": f'<div class="post-header"><h1>{TITLE}</h1></div>', "a price": f'<div class="share-price"><p>{TITLE}</p></div>',
    "a chapter": f'<section id="navigation"><h2>Navigation</h2><p>{TITLE}</p></section>', "a heading that all pages have": "<h2>Conclusion</h2>",
}
AROUND = '<html><body><header class="site"><a href="/">Home of the site</a></header><nav><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></nav>%s<aside class="sidebar">Some other news %d</aside><footer>All rights reserved</footer></body></html>'


def shown(part: str, i: int) -> str:
    return part % i if "%d" in part else part


@pytest.mark.parametrize("induced", [True, False])
@pytest.mark.parametrize("case", KEPT)
def test_what_stands_in_an_article_is_content(case, induced):
    pages = [AROUND % (f"<article>{shown(KEPT[case], i)}<p>Words of page {i} that go on for a while, number {i * i}.</p><p>More of {i}.</p></article>", i) for i in range(8)]
    want = "Conclusion" if "Conclusion" in KEPT[case] else "A title of page"
    for i, text in enumerate(html.extract(pages, induced)):
        assert want in text and f"Words of page {i}" in text and "News" not in text and "Home" not in text and "reserved" not in text


@pytest.mark.parametrize("induced", [True, False])
def test_page_in_one_form_and_paragraphs_of_one_link(induced):
    body = [f"<div class=content><h1>Title {i}</h1><p>Words of page {i} that go on for a while.</p><p><a href=x>A linked paragraph {i}</a></p><p>Last words of {i}, and some more of them.</p></div>" for i in range(8)]
    for wrap in ("<form id=aspnetForm action=.>%s</form>", "%s"):
        for i, text in enumerate(html.extract([wrap % (AROUND % (b, i)) for i, b in enumerate(body)], induced)):
            assert text.split("\n") == [f"Title {i}", f"Words of page {i} that go on for a while.", f"A linked paragraph {i}", f"Last words of {i}, and some more of them."]


def test_notices_and_comments_in_an_article_go():
    parts = '<div class="share">Share this page</div><div class="ad">Buy now %d</div><div id="comments"><p>A reader says %d</p></div><form><p>Your name</p></form>'
    for i, text in enumerate(html.extract([AROUND % (f"<article><h1>Title {i}</h1><p>Words of page {i} that go on.</p>{parts % (i, i)}</article>", i) for i in range(8)])):
        assert text == f"Title {i}\nWords of page {i} that go on."
