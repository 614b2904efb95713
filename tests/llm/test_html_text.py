"""Main text by line blocks: page layouts with known articles, tolerant markup, edge rows, the query on all pages."""

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gamelake.llm import queries
from gamelake.llm.html_text import article_text, main_text, stretches, stripped_lines
from gamelake.llm.tables import table

LONG = "Words of a paragraph that go on for quite a while, so that they carry weight in the page. " * 2
P1, P2, P3 = LONG + "One.", LONG + "Two.", LONG + "Three."
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Menu entry number {i}</a></li>' for i in range(12)) + "</ul>"


def squeezed(*parts):
    return " ".join(" ".join(parts).split())


@pytest.mark.parametrize("page, want", [
    # regions
    (f"<nav>{MENU}</nav><article><h1>Head</h1><p>{P1}<p>Short.<p>{P2}</article><footer>{P3}</footer>", squeezed("Head", P1, "Short.", P2)),
    (f"<header><h1>Site</h1></header><main><h1>Head</h1><p>{P1}</main><aside>{P2}</aside>", squeezed("Head", P1)),
    (f"<article><header><h1>Head</h1></header><p>{P1}</p><section id='comments'><h2>2 comments</h2><p>{P2}</p></section></article>", squeezed("Head", P1)),
    (f"<article><p>{P1}<div class='ad'>{P2}</div><p>Mid.</p><form>{P3}<input></form><p>{P3}</p></article>", squeezed(P1, "Mid.", P3)),
    (f"<article><p>{P1}</article><article class='comment'><p>{P2}{P3}</article>", squeezed(P1)),
    ("<nav><a href='/'>Home</a></nav><div class=ad>Buy this now and here</div><article><p>Of.</article><footer>Much longer than that</footer>", "Of."),
    # no regions: menus by links, parts by class, the rest by blocks
    (f"<body><div id='top'>{MENU}</div><div id='x1'><h1>Head</h1><p>{P1}<p>And.<p>{P2}</div><div id='x2'>Imprint</div></body>", squeezed("Head", P1, "And.", P2)),
    (f"<div class='cookie-notice'>{P3}</div><div><p>{P1}</p></div><div class='sidebarLeft'>{P2}</div>", squeezed(P1)),
    (f"<div class='page has-sidebar'><div class='text'><div>{P1}</div><div>{P2}</div></div><div id='comment-list'>{P3}</div></div>", squeezed(P1, P2)),
    (f"<div>{P1}<br>line<br/>break</div>", squeezed(P1, "line break")),
    (f"<p>{P1}</p><p>{P2}</p>", squeezed(P1, P2)),
    # markup
    (f"<article><p>a<b>b</b>c &amp;lt; &eacute;&#233;&#xe9; x&nbsp;\n\t y &copy;<!-- no > <p> --><p>{P1}<p>1 < 2 <3</article>", squeezed("abc &lt; ééé x y ©", P1, "1 < 2 <3")),
    (f"<article><script>var t='</p>';if(a<b){{}}</script><style>p{{}}</style><p title='a>b'>{P1}<SCRIPT>x</SCRIPT ></article>", squeezed(P1)),
    (f"<article><p><b>{P1}<br><p>{P2}", squeezed(P1, P2)),
    (f"<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul><p>{P1}</article>", squeezed("a b c d e", P1)),
    (f"<article><p>{P1}</article><!-- never closed <p>{P2}", squeezed(P1)),
    (f"<article><p>{P1}</article><a title='never closed>{P2}", squeezed(P1)),
    (f"<article hidden><p>{P2}{P3}</article><article><p>{P1}</article>", squeezed(P1)),
    ("plain text", "plain text"), ("", ""), (None, ""), ("<html><body></body></html>", ""), ("<<<>>>", "<<<>>>"), ("<!DOCTYPE html><title>t</title>", ""),
])
def test_layouts(page, want):
    assert article_text(page) == want


def test_blocks_surge_and_dive():
    lines = stripped_lines(f"<div>tiny</div><div><p>{P1}<p>b<p>{P2}</div><div>tiny</div>")
    assert [x and x.text[:4] for x in lines if x] == ["tiny", "Word", "b", "Word", "tiny"]
    found = stretches(lines)
    assert len(found) == 1 and [x.text[:4] for x in lines[found[0][0]:found[0][1]] if x] == ["Word", "b", "Word"]


def test_long_and_deep_pages():
    many = "<article>" + "<div><b><i>" * 20_000 + "<p>" + P1 + "</article>"
    assert article_text(many) == squeezed(P1)
    huge = f"<article>{'<p>' + P1 + '</p>'}</article>".replace(P1, P1 * 20_000)
    assert article_text(huge) == squeezed(P1 * 20_000)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<a href=x>", "</a>", "<li>", "<!--", "-->", "<b", ">", '"', "'",
                                 "word", " ", "&amp;", "&#0;", "<nav>", "</nav>", "<script>", "</script>", "<td class=ad>", "</table>", "é"]), max_size=40))
def test_any_markup_gives_text(parts):
    text = article_text("".join(parts))
    assert text == " ".join(text.split())


def test_rows(spark):
    rows = [(1, "u", f"<p>{P1}</p>", "clash", 5), (1, "u", f"<p>{P1}</p>", "clash", 5), (None, None, None, None, None), (3, "", "", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    one = (1, "u", squeezed(P1), len(squeezed(P1)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([one, one, (None, None, "", 0), (3, "", "", 0)], key=str)
    assert main_text(pages.limit(0)).count() == 0


def test_query_on_all_pages(spark, sf):
    """Pages of the given table hold one ``article`` element each: its text by plain tag removal."""
    want = {}
    for page in table(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", page["html"] or "", re.S)
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner[1])).split()) if inner else ""
        want[page["page_id"]] = (page["url"], text, len(text))
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in queries.op12_html_text(spark, sf).collect()}
    assert got == want and want
