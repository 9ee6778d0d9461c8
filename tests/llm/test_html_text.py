from __future__ import annotations

import re
from itertools import product

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import html_text
from ledgerloom.llm.maxflow import content_side

LONG = "This is a sentence of the article, long enough to look like one. " * 4


def cost(labels, source, sink, edges):
    return (sum(t if x else s for x, s, t in zip(labels, source, sink, strict=True))
            + sum(there * (labels[a] > labels[b]) + back * (labels[b] > labels[a]) for a, b, there, back in edges))


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_cut_is_the_cheapest_labelling(data):
    n = data.draw(st.integers(1, 7))
    number = st.integers(0, 9)
    source, sink = (data.draw(st.lists(number, min_size=n, max_size=n)) for _ in range(2))
    node = st.integers(0, n - 1)
    edges = [e for e in data.draw(st.lists(st.tuples(node, node, number, number), max_size=12)) if e[0] != e[1]]
    best = min(cost(x, source, sink, edges) for x in product([False, True], repeat=n))
    assert cost(content_side(source, sink, edges), source, sink, edges) == best


def test_long_chains_end():
    n = 3000
    side = content_side([5] + [0] * (n - 1), [0] * (n - 1) + [9], [(i, i + 1, 2, 2) for i in range(n - 1)])
    assert side == [True] + [False] * (n - 1)


PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body class="with-sidebar"><header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice">We use cookies. {LONG}</div><!-- <p>hidden</p> -->
<article><h1>Head &amp; line</h1><p>First <b>bold</b>\n  and&nbsp;so on.<br>New line {LONG}<p>Second &lt;tag&gt; {LONG}</p>
<aside>Read also {LONG}</aside><form><label>Mail</label><input></form><div class="ad">Buy {LONG}</div>
<ul><li>Item one of the list</li><li>Item two of the list</li></ul><p title="a>b">Third.</p></article>
<section id="comments"><article><p>Reader says {LONG}</p></article></section>
<aside class="sidebar">{LONG}</aside><footer>&copy; 2020 Site. {LONG}</footer></body></html>"""


def test_article_without_what_surrounds_it():
    flat = LONG.strip()
    assert html_text.main_text(PAGE).split("\n\n") == [
        "Head & line", f"First bold and so on. New line {flat}", f"Second <tag> {flat}", "Item one of the list",
        "Item two of the list", "Third."]


def test_page_without_article_element():
    page = (f"<body><div class='top'><a>Home</a> <a>News</a> <a>Sport</a></div><div><h2>Title of it</h2><p>{LONG}</p><p>Short.</p>"
            f"<p>{LONG}</p></div><div class='footer'>Imprint {LONG}</div></body>")
    assert html_text.main_text(page).split("\n\n") == ["Title of it", LONG.strip(), "Short.", LONG.strip()]


def test_odd_pages():
    for page in ("", " \n", "<", "<!--", "<script>", "<p", "</p>", "&", "<a href='x", "<p class=\"x>y", "\x00<p>\x00"):
        assert html_text.main_text(page) in ("", page.replace("<p>", " ").strip(), "\x00")
    assert html_text.main_text("<article><p>cut &am") == "cut &am"
    deep = "<div>" * 3000 + "<article>deep down there it is.</article>"
    assert html_text.main_text(deep) == "deep down there it is."
    many = "<article>" + "<p>words and words." * 20_000
    assert html_text.main_text(many).count("\n\n") == 19_999


def test_rows_of_every_kind(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, None, ""), (3, "v", "<nav>menu</nav>")]
    pages = spark.createDataFrame([(*r, 7, "x") for r in rows], "page_id bigint, url string, html string, n_chars int, text string")
    got = html_text.extract_pages(pages)
    assert got.columns == [*pages.columns, "__text"]
    assert sorted((str(r.page_id), r["__text"]) for r in got.collect()) == sorted(
        (str(i), html_text.main_text(h or "")) for i, _, h in rows)
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_elements_without_text_end_with_themselves_or_their_parents():
    rest = f"<p>Second paragraph. {LONG}</p>"
    second = f"Second paragraph. {LONG.strip()}"
    for tag in ('<svg class="i"/>', "<svg><title/><path d='x'/></svg>", "<svg><text>no</text></svg>", "<button>no",
                "<select><option>no", "<object>no", "<canvas>no</canvas>", "<button><div>no</div></button>", "<svg>", "<noscript>no",
                "<object>no<object>no</object></object>", "<button>no</button>", "<template><p>no</p></template>"):
        got = html_text.main_text(f"<article><p>One {LONG}{tag}</p>{rest}<p>Third. {LONG}<button>no</button></p></article>").split("\n\n")
        assert got == [f"One {LONG.strip()}", second, f"Third. {LONG.strip()}"], tag
    assert html_text.main_text('<article><p>a <svg class="i"/> b</p><p>Second paragraph.</p></article>') == "a b\n\nSecond paragraph."
    formula = "<math><semantics><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding='tex'>no</annotation></semantics></math>"
    assert html_text.main_text(f"<article><p>Let {formula} be. {LONG}</p></article>") == f"Let x+1 be. {LONG.strip()}"
    assert html_text.main_text(f"<article><p>One {LONG}</p><script>no<p>no") == f"One {LONG.strip()}"


P, Q = f"One paragraph. {LONG.strip()}", f"Another one. {LONG.strip()}"
TWO = f"<p>{P}</p><p>{Q}</p>"
#: Pages and the blocks of their articles, labelled by hand.
LABELLED = {
    "form around the page": (f"<form action=x><nav><a href=/>Home</a></nav><article>{TWO}</article><footer>Imprint</footer></form>", [P, Q]),
    "form around a page without article": (f"<form><div>{TWO}<p>{P}</p></div><label>Mail</label><input></form>", [P, Q, P]),
    "form in an article": (f"<article>{TWO}<form><label>Your mail address</label><input><p>We never give it away.</p></form></article>", [P, Q]),
    "form of a search": (f"<form role=search><label>Search</label><input></form><div>{TWO}</div>", [P, Q]),
    "names with other parts": (f"<article><div class='modal-verbs legal-history'>{TWO}</div></article>", [P, Q]),
    "names with other parts, no article": (f"<div class='modal-verbs'>{TWO}</div>", [P, Q]),
    "related-work": (f"<article><p>{P}</p><section id=related-work><h2>Related work</h2><p>{Q}</p></section></article>", [P, "Related work", Q]),
    "discussion-of-results": (f"<main><section class=discussion-of-results><h2>Discussion</h2><p>{Q}</p></section></main>", ["Discussion", Q]),
    "related": (f"<article><p>{P}</p><div class=related><h3>Read also</h3><p>{Q}</p></div></article>", [P]),
    "related-posts": (f"<article>{TWO}</article><section class=related-posts><p>{Q}</p></section>", [P, Q]),
    "two short paragraphs": ("<body><p>Short it is.</p><p>And so is this.</p></body>", ["Short it is.", "And so is this."]),
    "short paragraph between long ones": (f"<div><p>{P}</p><p>Yes</p><p>{Q}</p></div>", [P, "Yes", Q]),
    "heading without article": (f"<div><h2>A heading</h2>{TWO}</div>", ["A heading", P, Q]),
    "legal page": (f"<div class=legal><h1>Terms</h1>{TWO * 3}</div>", ["Terms", *[P, Q] * 3]),
    "legal line": (f"<div>{TWO}</div><div class=legal><p>All rights reserved by the owner of this.</p></div>", [P, Q]),
    "cookie notice": (f"<div class=cookie-notice>{TWO}</div><div><p>{P}</p></div>", [P]),
    "cookie notice and article": (f"<div id=cookie_consent>{TWO}<p>{P}</p></div><article><p>{P}</p></article>", [P]),
    "modal over the article": (f"<div class=modal><p>{P}</p><p>{Q}</p><p>{Q}</p></div><article><p>{P}</p></article>", [P]),
    "advert in the article": (f"<article><p>{P}</p><div class='ad box'><p>Buy now. {LONG}</p></div><p>{Q}</p></article>", [P, Q]),
    "advert, no article": (f"<div><p>{P}</p><div class=ad-slot>Buy now</div><p>{Q}</p></div>", [P, Q]),
    "sidebar": (f"<div>{TWO}</div><div class=sidebar>{TWO}</div>", [P, Q]),
    "wrapper with a sidebar": (f"<div class=with-sidebar>{TWO}</div>", [P, Q]),
    "aside": (f"<article><p>{P}</p><aside><p>{Q}</p></aside></article>", [P]),
    "header of the article": (f"<header><p>Site name.</p></header><article><header><h1>Title</h1></header><p>{P}</p></article>", ["Title", P]),
    "header by name": (f"<article><div class=entry-header><h1>Title</h1></div><div class=header><p>By us.</p></div><p>{P}</p></article>",
                       ["Title", "By us.", P]),
    "table of an article": (f"<article><p>{P}</p><table>{'<tr><td>1<td>2' * 30}</table></article>", [P, *["1", "2"] * 30]),
    "list of an article": (f"<article><p>{P}</p><ul><li>milk<li>eggs<li>flour</ul></article>", [P, "milk", "eggs", "flour"]),
    "linked paragraph": (f"<article><p>{P}</p><p><a href=x>The paper that all of this is about</a></p><p>{Q}</p></article>",
                         [P, "The paper that all of this is about", Q]),
    "menu by links": (f"<div><a href=/>Home</a> <a href=/n>News</a></div><div>{TWO}</div>", [P, Q]),
    "comments": (f"<article><p>{P}</p></article><div id=comments><article><p>{Q}</p></article><p>{Q}</p></div>", [P]),
    "comment-list in the article": (f"<article><p>{P}</p><ol class=comment-list><li><p>{Q}</p></li></ol></article>", [P]),
    "hidden": (f"<article><p>{P}</p><p hidden>{Q}</p><div style='display: none'>{Q}</div></article>", [P]),
    "roles": (f"<div role=banner><p>{P}</p></div><div role=main><p>{P}</p></div><div role=contentinfo><p>{Q}</p></div>", [P]),
    "rights": (f"<div>{TWO}</div><p>\xa9 2020 All rights reserved.</p>", [P, Q]),
    "article called sponsored": (f"<article class=sponsored>{TWO}</article>", [P, Q]),
    "article in a modal": (f"<div class=modal><article>{TWO}</article></div>", [P, Q]),
    "several articles": (f"<main><article><p>{P}</p></article><article><p>{Q}</p></article></main>", [P, Q]),
    "nothing but a menu": ("<nav><ul><li><a>One</a><li><a>Two</a></ul></nav>", []),
}


@pytest.mark.parametrize("name", LABELLED)
def test_labelled_pages(name):
    page, blocks = LABELLED[name]
    assert html_text.main_text(page).split("\n\n") == (blocks or [""])


def test_cut_is_the_cheapest_labelling_of_pages():
    compared = 0
    for page, _ in LABELLED.values():
        source, sink, edges = html_text.graph(html_text.blocks_of(page))
        if len(source) <= 12:
            compared += 1
            best = min(cost(x, source, sink, edges) for x in product([False, True], repeat=len(source)))
            assert cost(content_side(source, sink, edges), source, sink, edges) == best
    assert compared >= 30


def test_the_cut_decides_on_the_given_pages(folder):
    changed = 0
    for page in pq.read_table(f"{folder}/pages.parquet").column("html").to_pylist():
        blocks = html_text.blocks_of(page or "")
        changed += sum(x != (html_text.log_odds(b) > 0) for b, x in zip(blocks, html_text.label(blocks), strict=True))
        inside = re.findall("<article>(.*?)</article>", page or "", re.S)
        assert html_text.main_text(page or "") == "\n\n".join(b.text for x in inside for b in html_text.blocks_of(x))
    assert changed > 0
