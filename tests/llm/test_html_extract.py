import html
import re
import time

import pytest

from vitrine.llm import html_extract as M


def planted(page):
    """Blocks of the generator's article element, read off by plain patterns."""
    body = re.search(r"<article>(.*?)(?:</article>|<footer|$)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in blocks if x)


def test_query_keeps_exactly_the_article(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = M.op9_html_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == planted(pages[r.page_id].html)


LONG = "This sentence is part of the article and it is long enough to count as running text for a reader. " * 2


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain words", "plain words"),
    ("<nav><a href=x>Home</a></nav><article><h1>T &amp; t</h1><p>One&nbsp;two\n three</p><p>Hi.</p></article><footer>f</footer>", "T & t\nOne two three\nHi."),
    # no article element: menu lists, sidebar, comments, form, cookie notice around running text
    (f"<body><div class='menu'><ul><li><a>A</a><li><a>B</a></ul></div><ul><li><a>Link one</a></li><li><a>Link two</a></li><li><a>x</a></li></ul>"
     f"<div><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div id=sidebar><p>{LONG}</p></div>"
     f"<form><p>{LONG}</p></form><div class='cookie-notice'>{LONG}</div><div id='comments'><p>{LONG}</p></div><footer>{LONG}</footer>",
     "Head\n" + "\n".join([LONG.strip(), "Short.", LONG.strip()])),
    # an advert and an aside inside the article, a comment marked as article, a header with the title
    (f"<header>Site</header><main><article><header><h1>T</h1></header><p>{LONG}<div class=ad>Buy</div><aside><p>a<p>b<p>c<p>d</aside><p>End"
     f"</article><article class='comment'>{LONG}</article></main>", "T\n" + LONG.strip() + "\nEnd"),
    # markup left open, stray end tags, scripts with tags inside, comments
    ("<nav><ul><li>x<article><p>a<b>b</div></p><script>if(a<b){'</p>'}</script><!-- <p>no --><p>c", "ab\nc"),
    ("<body class='has-sidebar'><article><p>kept</p></article>", "kept"),
    ("<article><table><tr><td>a<td>b</table><p style='display: none'>no</p><p>x<br>y</p></article>", "a\nb\nx y"),
])
def test_pages(page, want):
    assert M.main_text(page) == want


def test_surge_and_dive_points():
    import numpy as np
    assert M.window_sums(np.array([0, 5, 0, 0, 0, 7]), 3).tolist() == [5, 5, 0, 7, 7, 7]


def test_hostile_pages_stay_linear():
    for page in ("<" * 100_000, "<a " * 50_000, "<div>" * 50_000, "&" * 100_000, "<!--" * 50_000, "x" * 1_000_000, "</div>" * 50_000, "<p x='" * 20_000):
        began = time.process_time()
        M.main_text(page)
        assert time.process_time() - began < 20, page[:10]


def test_edge_rows(spark):
    rows = [(1, None, None, "t"), (None, "u", "<p>a</p>", "t"), (2, "u", "<p>a</p>", "t"), (2, "u", "<p>a</p>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(str, M.extract(df).collect()))
    assert got == sorted(["Row(page_id=1, url=None, text='', n_chars=0)", "Row(page_id=None, url='u', text='a', n_chars=1)"]
                         + ["Row(page_id=2, url='u', text='a', n_chars=1)"] * 2)
    assert M.extract(df.limit(0)).count() == 0
