"""Main text of pages: layouts with a known article, awkward input, and the given pages."""

from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vendorium.llm import html_text

PROSE = "The night train to the coast is one of the last of its kind, and it was on the list of those that the ministry wanted to end."
MORE = "For the people in the villages along the line it is the only way to get to the hospital, to the market and to the school."
AD = "Buy two pairs of the new shoes and you will get the third of them for free if you order with the code from this page."

LAYOUTS = {
    "plain body": (f"<body><p>{PROSE}</p><p>Be.</p><p>{MORE}</p></body>", f"{PROSE} Be. {MORE}"),
    "menu and footer by words alone": (
        f"<div><a href=/a>Home</a> <a href=/b>News</a></div><h1>Night trains</h1><p>{PROSE}</p><p>{MORE}</p><div><a href=/c>Imprint</a></div>",
        f"Night trains {PROSE} {MORE}",
    ),
    "aside, form and notices": (
        f"<div class='cookie-notice'>{AD}</div><header><h2>The Paper</h2></header><article><header><h1>Night trains</h1></header><p>{PROSE}</p>"
        f"<aside>{AD}</aside><form><p>{AD}</p><input><textarea>{AD}</textarea></form><p>To.</p><footer>{AD}</footer></article><div id=sidebar><p>{AD}</p></div>",
        f"Night trains {PROSE} To.",
    ),
    "reader comments by class": (f"<article><p>{PROSE}</p><section class='post-comments'><p>{MORE}</p></section></article>", PROSE),
    "reader comments by heading": (f"<article><p>{PROSE}</p><div><h3>3 Comments</h3><p>{MORE}</p></div></article>", PROSE),
    "comments as articles": (f"<main><article><p>{PROSE}</p></article><div id=comments><article class=comment><p>{MORE}</p></article></div></main>", PROSE),
    "page inside a form": (f"<form id=aspnet><nav><a href=/>x</a></nav><article><p>{PROSE}</p></article></form>", PROSE),
    "menu never closed": (f"<nav><ul><li><a href=/>Home</a><article><p>{PROSE}</p><p>As.</p></article>", f"{PROSE} As."),
    "settings of the page": (f"<body class='with-sidebar has-cookies'><div class='content no-sidebar'><p>{PROSE}</p></div></body>", PROSE),
    "hidden": (f"<article><p>{PROSE}</p><p>Is.</p><div hidden>{AD}</div><div style='display: none'>{AD}</div><div aria-hidden=true>{AD}</div></article>", f"{PROSE} Is."),
    "scripts, styles and comments": (
        f"<head><title>x</title><style>p{{}}</style><script>if(a<b)document.write('<p>{AD}</p>')</script></head><body><!-- <p>{AD}</p> --><p>{PROSE}</p><noscript>{AD}</noscript>",
        PROSE,
    ),
    "references and white space": ("<article><p>a&nbsp;&lt;b&gt; &amp;amp; &#8364;\n\t c<b>d</b>e<br>f &am</p></article>", "a <b> &amp; € cde f &am"),
    "quoted end of tag": (f"<article><p title='a > b' data-x=\"<p>\">{PROSE}</p></article>", PROSE),
    "tables and lists": (f"<article><ul><li>one<li>two</ul><table><tr><td>3<td>4</table><p>{PROSE}</p></article>", f"one two 3 4 {PROSE}"),
    "only short words": ("<article><p>To.</p></article><footer>all rights</footer>", "To."),
    "text without tags": ("just a few words", "just a few words"),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, wanted = LAYOUTS[name]
    assert html_text.main_text(page) == wanted


def test_pass_two_takes_the_nearest():
    def block(text, chrome=False, heading=False, article=0):
        return html_text.Block(text, 0, chrome, article, heading)

    found = [block("x", chrome=True), block("T", heading=True), block(PROSE), block("a"), block("b"), block("y", chrome=True), block("c")]
    first = html_text.first_labels(found)
    assert first == [False, None, True, None, None, False, None]
    assert html_text.final_labels(found, first) == [False, True, True, True, False, False, False]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "</p></div>", "&#0;&#xD800;<p>&", "<a \"" * 2000, "<div>" * 20_000 + "</section>" * 20_000])
def test_awkward_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_long_page_is_read_whole():
    page = "<article>" + "<p>of the last word</p>" * 100_000 + "<p>the very end</p></article>"
    text = html_text.main_text(page)
    assert text.startswith("of the last word of") and text.endswith("the very end") and len(text) == 17 * 100_000 + 12


SCHEMA = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()), StructField("Text", StringType()), StructField("_text", StringType())])


def test_rows(spark):
    rows = [(1, "u", "<p>a b</p>", "old", "k"), (1, "u", "<p>a b</p>", "old", "k"), (None, None, None, None, None), (2, "v", "", "", "")]
    done = html_text.extract(spark.createDataFrame(rows, SCHEMA))
    assert done.columns == ["page_id", "url", "_text", "text", "n_chars"]
    assert sorted(map(tuple, done.collect()), key=repr) == sorted([(1, "u", "k", "a b", 3)] * 2 + [(None, None, None, "", 0), (2, "v", "", "", 0)], key=repr)
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_pages(spark, sf_dir):
    """The article element of the given pages, by a pattern that only fits their layout."""
    pages = {row.page_id: row.html for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    done = html_text.query(spark, sf_dir)
    assert done.columns == ["page_id", "url", "text", "n_chars"]
    found = {row.page_id: row for row in done.collect()}
    assert found.keys() == pages.keys()
    for page, source in pages.items():
        inner = re.search("<article>(.*)</article>", source, re.DOTALL)[1]
        wanted = " ".join(html.unescape(re.sub("</?(?:p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert found[page].text == wanted and found[page].n_chars == len(wanted)
    assert done.filter(F.col("n_chars") == 0).count() == 0
