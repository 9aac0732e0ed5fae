from __future__ import annotations

import re
import time
from dataclasses import replace
from html import unescape

import pytest

from tidemark.llm.pages import Page, _texts, main_texts, train

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/pages.parquet"))


def plain(html):
    """The article of the given tables, which all mark it alike."""
    article = html[html.index("<article>") + 9 :].split("</article>")[0].split("<footer>")[0]
    blocks = re.split(r"</?(?:p|h1|div)>", article)
    cleaned = (" ".join(unescape(re.sub(r"<[^>]+>", " ", block)).split()) for block in blocks)
    return "\n".join(filter(None, cleaned))


def test_articles_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = main_texts(pages).toPandas().set_index("page_id")
    for row in pages.collect():
        assert got.loc[row.page_id, "text"] == plain(row.html)
        assert got.loc[row.page_id, "n_chars"] == len(plain(row.html)) and got.loc[row.page_id, "url"] == row.url


def unmarked(html):
    """The page without any tag or class that says what is the article and what is not."""
    return re.sub(r"<(/?)(?:article|nav|footer)\b", r"<\1div", html).replace(' class="ad"', "")


def test_trees_find_articles_that_nothing_marks(spark, model):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    pages, wanted = [unmarked(row.html) for row in rows], [plain(row.html) for row in rows]
    got = _texts(pages, model)
    assert sum(a == b for a, b in zip(got, wanted)) >= 0.95 * len(rows)
    lines = [(set(a.split("\n")), set(b.split("\n"))) for a, b in zip(got, wanted)]
    assert sum(len(a & b) for a, b in lines) >= 0.98 * sum(len(b) for _, b in lines)
    assert sum(len(a - b) for a, b in lines) <= 0.02 * sum(len(b) for _, b in lines)
    # Without the trees nothing tells the boilerplate.
    assert not any(a == b for a, b in zip(_texts(pages, None), wanted))


def test_only_the_trees_judge(spark, model):
    html = spark.read.parquet(f"{SF}/pages.parquet").first().html
    for page in (html, unmarked(html)):
        assert _texts([page], replace(model, weights=model.weights * 0)) != _texts([page], model)
        assert _texts([page], replace(model, value=-model.value)) != _texts([page], model)


def test_time_is_linear_in_nesting():
    def seconds(n):
        start = time.process_time()
        Page("<p><table>" + "<section><span>" * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(32_000) < 16 * max(seconds(4000), 0.02)


CASES = [
    ("<main><p>Real  text\n of the page.</p><aside>side</aside><p>More <i>te</i>xt<br>two</main><footer>f</footer>",
     "Real text of the page.\nMore text two"),
    ("<nav>menu</nav><article><h1>Head</h1><p>a &lt;b&gt; &eacute; &#x41;&amp b</p><script>x='<p>no</p>'</script>"
     "<style>p{}</style><form>Name <input></form><div class='comments'><p>nice, thanks!</p></div></article>",
     "Head\na <b> é A& b"),
    ("<article><ul><li>one<li>two</ul><p>open <b>bold<p>next</b> block</article>", "one\ntwo\nopen bold\nnext block"),
    ("<article><p>text <span class='ad'>BUY</span>end</p><div id='cookie-notice'>we use cookies</div></article>", "text end"),
    ("<head><title>t</title><meta charset=utf-8><style>p{}</style><body><article><p>no end of the head</article>", "no end of the head"),
    ("<head><title>t</title><noscript><img src=x></noscript><article><p>no body</article>", "no body"),
    ("<head><template><p>no</p><div>no</div></template><noscript><p>no</noscript></head><article><p>ended</article>", "ended"),
    ("<head><title>t</title>text alone", "text alone"),
    ("<article><p>before</p><svg viewBox='0 0 1 1'/><p>after <math/>it</p><iframe src='x'/><p>end</p></article>", "before\nafter\nit\nend"),
    ("<article><p>a</p><svg><svg/><text>no</text></svg><iframe src='x'/>no</iframe><p>b</p></article>", "a\nb"),
    ("<body class='has-sidebar'><article><p>beside a bar</article><div class=sidebar><p>bar</div>", "beside a bar"),
    ("<body class='sidebar'><div class='content-with-sidebar'><main><p>in a layout</main></div>", "in a layout"),
    ("<article class='post comments-open'><p>open</p><div class='comments'><article class='comment'><p>nice</article></div>", "open"),
    ("<article><header class='entry-header'><h1>Title</h1></header><div class='single-post-header'><p>by</div><p>x</article>",
     "Title\nby\nx"),
    ("<article><p>a long enough text of the page</article><div class='related'><article><p>teaser</article></div>",
     "a long enough text of the page"),
    ("", ""),
    ("<!-- nothing -->", ""),
    ("<p>a<p>b", "a\nb"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_pages(model, html, text):
    assert _texts([html], model) == [text]
    assert _texts([html], None) == [text]


def test_broken_markup_never_fails(model):
    for html in ("<", "</", "<a", "<a href='", "</p></div></html>", "<![CDATA[x", "<div>" * 3000 + "deep", "&#xFFFFFFFF;", "<p/>x"):
        assert isinstance(_texts([html], model)[0], str)


def test_depth_of_unclosed_elements_is_kept_whole():
    page = Page("<article>" + "<section><p>word" * 500)
    assert page.last[0] == len(page.parent) - 1 == 1001


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "a", 1), (1, "u", "<article><p>x</p></article>", "a", 1), (None, None, None, None, 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, label int")
    got = sorted((tuple(row) for row in main_texts(pages).collect()), key=repr)
    assert got == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert main_texts(pages.where("page_id = 9")).count() == 0
