import pytest

from tallyridge.llm.extraction import extract, main_text

ARTICLE = "<h1>Title of it</h1><p>First <b>bold</b>ly, with some text &amp; more; long enough to count.<p>Second one, short.<ul><li>a<li>b</ul><blockquote>Quoted, too.</blockquote>"
WANT = "Title of it First boldly, with some text & more; long enough to count. Second one, short. a b Quoted, too."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home.</a></nav><article>{ARTICLE}</article><footer>&copy; us, 2020. All rights.</footer></body></html>",
    f"<body><div id='top-menu'>Home, About. Contact.</div><div class=\"content\">{ARTICLE}</div><div class='comments'><p>I like it, really. Nice! Long comment, too.</p></div><div>(c) 2020</div>",
    f"<main><form><p>Search, please.</p></form>{ARTICLE}<aside><p>Related, see also: this.</p></aside></main><script>var x = '</p><p>no, never.';</script>",
    f"<div class=page><div class=siteHeader>My, site.</div><section><div class=ad>Buy, now!</div><!-- <p>gone, too.</p> -->{ARTICLE}</section><div role=contentinfo>Imprint, etc.</div></div>",
])
def test_article_only(page):
    assert main_text(page) == WANT


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain text only", "plain text only"), ("<p>", ""), ("<nav>a</nav>", ""), ("a < b &lt; c", "a < b < c"), ("<!-- open", ""), ("<p>x<script>never closed", "x"),
    ("<p>&#x41;&nbsp; \n b&unknown;</p>", "A b&unknown;"), ("<b>a</b>b<br>c<td>d", "ab c d"), ("<p title='a>b'>q</p>", "q"), ("</p></div>t", "t"),
])
def test_odd_markup(page, want):
    assert main_text(page) == want


BODY = "<p>" + "A long sentence, with words; and more of them. " * 40 + "</p>"


@pytest.mark.parametrize("page,first,last", [
    (f"<body><nav>Home.</nav><article><h1>Title</h1><p>lead</p><div>{BODY}</div></article><footer>Us.</footer></body>", "Title lead A long", "of them."),
    (f"<article><section>{BODY * 5}</section><section class=end><p>A short end, though.</p></section></article>", "A long", "A short end, though."),
    (f"<body><div class=content><h1>Title</h1><p>lead</p><div>{BODY * 5}</div><p>last</p></div><div>(c) 2020</div></body>", "Title lead A long", "of them. last"),
    (f"<main><article>{BODY * 12}</article><article><p>Another, shorter one.</p></article></main>", "A long", "Another, shorter one."),
])
def test_nothing_of_the_article_is_lost(page, first, last):
    text = main_text(page)
    assert text.startswith(first) and text.endswith(last)


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>One, two.</p>" * 20000 + "</article>") == " ".join(["One, two."] * 20000)
    assert main_text("<div>" * 3000 + "x, y." + "</div>" * 3000) == "x, y."


def test_table(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "old"), (1, "u", f"<article>{ARTICLE}</article>", "old"), (2, None, None, "old"), (None, "v", "", None)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, WANT, len(WANT)), (1, WANT, len(WANT)), (2, "", 0)]
    assert extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
