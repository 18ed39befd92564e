from __future__ import annotations

import time

import pytest

from ledgerloom.llm import extraction

LONG = "The river rose during the night and by the morning it had covered the lower fields and the road to the mill."


@pytest.fixture(scope="module")
def tree(spark):
    return extraction.train(spark)


def test_fits_its_examples(tree):
    x, y = extraction.examples()
    assert (tree.predict(x) == (y == 1)).mean() > 0.95


def test_article_without_its_surroundings(tree):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><script>var t='</p>';</script>"
        "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy our very good things today and save</div>"
        f"<article><h1>Flood &amp; mill</h1><p><b>{LONG}<br>It&nbsp;fell &lt;later&gt;.<p>Short end.</p><form>Write to us <input></form></article>"
        "<section id=comments><p>I saw it from my window and could not believe how fast it came up</p></section>"
        "<aside>Other news of the week from the whole valley and beyond</aside><footer>&copy; the valley paper</footer>"
    )
    assert extraction.main_text(page, tree) == f"Flood & mill\n\n{LONG} It fell <later>.\n\nShort end."


def test_odd_pages(spark, tree):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p"), (None, "u", f"<p>{LONG}</p>"), (4, "u", f"{LONG}"), (4, "u", f"{LONG}"), (5, "u", "<a" * 2000), (6, "u", "<div>" * 3000 + LONG)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extraction.extract(pages, tree).collect()
    assert len(got) == len(rows)
    texts = sorted((str(r.page_id), r.text) for r in got)
    assert texts.count(("4", LONG)) == 2 and ("None", LONG) in texts and ("1", "") in texts and ("6", LONG) in texts
    assert all(r.n_chars == len(r.text) for r in got)
    assert extraction.extract(pages.limit(0), tree).count() == 0


@pytest.mark.parametrize("page", [
    "<html><head><title>x</title><meta charset=utf-8><body><article>{}</article></body></html>",
    "<html><head><title>x</title><noscript><div>no</div></noscript><article>{}</article>",
    "<html><head><title>x<body><article>{}</article>",
    "<head><script>var a;</script>{}",
    "<body><svg viewBox='0 0 1 1'/><article>{}</article>",
    "<body><math/><article>{}</article><math></math>",
    "<body><div><svg><path d=1><circle/></div><article>{}</article><svg><text>no</text></svg>",
    "<body><svg><path d=1><article>{}</article>",
    *(f"<body><div><{tag}><b>no</b></div><article>{{}}</article>" for tag in ("select", "object", "canvas", "iframe", "noscript", "template", "svg", "math")),
    *(f"<body><div><{tag}><b>no</b></div><article>{{}}</article><{tag}>no</{tag}>" for tag in ("select", "object", "canvas", "iframe", "noscript", "template")),
    "<body><ul><li><canvas><li>{}</ul>",
    "<body><p><object><p>no</p><object>no</object>no</object>{}</p>",
    "<body><select><option>no<option>no</select><p>{}",
])
def test_hidden_elements_take_no_text_with_them(page):
    assert [b.text for b in extraction.blocks(page.format(LONG))] == [LONG]


@pytest.mark.parametrize("tag", ["script", "style", "textarea"])
def test_raw_text_without_an_end_reaches_to_the_end(tag):
    assert [b.text for b in extraction.blocks(f"<p>{LONG}<{tag}>a<p>b</p>")] == [LONG]


ARTICLE = "".join(f"<p>The harbour was quiet on morning {i}, and the boats lay still while the tide came slowly in over the flats.</p>" for i in range(4))
COMMENTS = "<div class=comments><article><p>I was there and it was a wonderful day for the whole family, thank you all for it</p></article></div>"


@pytest.mark.parametrize("page", [
    "<html class='js nav-open'><body><main>{a}</main>{c}",
    "<body class='single-post has-sidebar'><article>{a}</article>{c}",
    "<body class='header-fixed no-footer'><div class=content>{a}</div>{c}",
    "<body><form id=aspnetForm action=/><div id=page>{a}</div></form>",
    "<body><form id=aspnetForm><div class=content>{a}</div>{c}<input></form>",
    "<body><div class='sidebar-right header-large'><main>{a}</main>{c}</div>",
    "<body><div id=search-wrapper>{a}</div>{c}",
    "<body><article>{a}{c}</article>",
])
def test_wrappers_with_side_names(tree, page):
    text = extraction.main_text(page.format(a=ARTICLE, c=COMMENTS), tree)
    assert text.count("The harbour was quiet") == 4 and "wonderful" not in text


def test_the_header_of_an_article_is_part_of_it(tree):
    page = f"<body><header><h1>The Daily Example</h1></header><article><div class=article-header><h1>A quiet morning in the harbour</h1></div>{ARTICLE}</article>"
    text = extraction.main_text(page, tree)
    assert text.startswith("A quiet morning in the harbour") and "Daily" not in text


def test_a_form_beside_the_article_stays_out(tree):
    page = f"<body><main>{ARTICLE}</main><form><p>Leave your address here and we will send you a letter every month about the harbour and its boats</p></form>"
    assert "address" not in extraction.main_text(page, tree)


@pytest.mark.parametrize("unit", ["<b>", "<b></i>", "<b><p></p>", "<p><div><b>", "<svg><foreignObject><g><p>", "<form>", "<div class=nav>", "<li><b>", "</i>"])
def test_many_unclosed_tags_take_linear_time(tree, unit):
    start = time.perf_counter()
    extraction.main_text("<body>" + unit * (200_000 // unit.count("<")) + "words at the end", tree)
    assert time.perf_counter() - start < 20
