"""HTML extraction on hand-written pages and on pages built to break a reader."""
import time

import pytest

from scorecraft.llm import html_extract

MENU = "".join(f"<li><a href='/{w}'>{w.title()}</a></li>" for w in ("home", "news", "sport", "about us"))
LINES = ["The council met on Tuesday evening to discuss the new bridge over the river.",
         "After two hours of debate, members voted nine to four in favour of the plan.",
         "Work is expected to begin in the spring and to last for about eighteen months.",
         "Traffic will use the old crossing until then, a spokesperson for the town said."]
ARTICLE = "<h1>Council backs a new bridge</h1>" + "".join(f"<p>{x}</p>" for x in LINES)
TEXT = "\n\n".join(["Council backs a new bridge", *LINES])
PAGES = [
    f"<html><head><title>News</title></head><body><nav><ul>{MENU}</ul></nav><article>{ARTICLE}</article><footer>&copy; 2024 The Gazette</footer></body></html>",
    f"<body><header><div class=logo>The Gazette</div><ul class=menu>{MENU}</ul></header><main><article>{ARTICLE}</article></main>"
    f"<section class='comments'><h3>Comments</h3><p>What a waste of money, if you ask me.</p></section><footer><p>All rights reserved.</p></footer></body>",
    f"<body><div class='cookie-notice'><p>We use cookies.</p><button>OK</button></div><ul class=nav>{MENU}</ul><div class='article-body'>{ARTICLE}</div>"
    f"<aside class=sidebar><h3>Most read</h3><ul>{MENU}</ul></aside><form class=newsletter><label>Your address</label><input><button>Subscribe</button></form></body>",
    f"<body data-y='12.5'><ul class=menu data-y>{MENU}</ul><article data-y=main>{ARTICLE.replace('<p>', '<p class=it&#39;s data-y=7.5>')}</article><div class=footer>Imprint</div></body>",
]


@pytest.fixture(scope="module")
def model(spark):
    pages = [(i, "u", p.replace("Council", f"Council {i}")) for i, p in enumerate(PAGES * 6)]
    return html_extract.fit(spark.createDataFrame(pages, "page_id long, url string, html string").select("html"))


@pytest.mark.parametrize("i", range(len(PAGES)))
def test_main_text_of_a_written_page(model, i):
    assert html_extract.main_texts(model, [PAGES[i]]) == [TEXT]


def texts(page):
    return [b.text for b in html_extract.blocks(page)]


def test_quotes_and_marks_in_attributes():
    assert texts("<p class=it's>First para.</p><p>Second isn't lost?</p><p>Third</p>") == ["First para.", "Second isn't lost?", "Third"]
    assert texts('<p title="a > b" x=\'<p>\'>one<p a"b c=\'>two') == ["one", "two"]
    assert texts('<a href="x>link</a><p>kept</p>') == ["link", "kept"]
    assert texts("1 < 2 and <b>3</b> <c") == ["1 < 2 and 3 <c"]
    for mark in ("data-y", "data-y=''", "data-y=12.5", "data-y='x'", "data-y=1"):
        page = html_extract.blocks(f"<div {mark}><p>text</p></div>")
        assert [(b.text, b.label) for b in page] == [("text", None)]


@pytest.mark.parametrize("page,found", [
    ('<a "' * 200_000, 1), ("<div>a" * 100_000, 100_000), ("<p><div>" + "<h1>x" * 100_000, 100_000), ("<b>a" * 100_000 + "<p>z", 2),
    ("</div>" * 100_000, 0), ("<body>a" * 50_000, 50_000), ("".join(f"<x{i}>a" for i in range(50_000)), 1),
    ('<a x=">" ' * 100_000, 1), ("<svg>a" * 50_000, 1), ("<!--" * 100_000, 0)])
def test_time_grows_with_the_length(page, found):
    start = time.process_time()
    assert len(html_extract.blocks(page)) == found
    assert time.process_time() - start < 20  # a quadratic reader takes many minutes


def test_depth_does_not_change_what_a_block_inherits():
    deep = html_extract.blocks("<article class=story>" + "<div>" * 3000 + "<p>in</p>" + "</div>" * 3000 + "</article><p>out</p>")
    assert [(b.text, "article" in b.tags, b.own, b.hints[0]) for b in deep] == [("in", True, "p", True), ("out", False, "p", False)]
    head = html_extract.blocks("<html><head><title>t</title><body><p>x")
    assert [(b.text, b.own) for b in head] == [("x", "p")]
