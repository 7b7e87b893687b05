"""Main text of pages: hand-made layouts, the test pages' own containers, odd input."""

import html
import re

import pytest
from pyspark.sql import functions as F

from mlframe.llm import html_content as H
from mlframe.llm.queries import op5_html

BODY = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def container_text(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_query_finds_the_articles(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op5_html(spark, sf_dir).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {k: container_text(v) for k, v in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_the_scan_finds_content_without_a_container(spark, model, sf_dir):
    """The same pages with their article tags taken out: only the scores are left to find the region."""
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        bare = re.sub(r"</?article>", "", r["html"])
        assert H.extract(bare, model) == container_text(r["html"])


@pytest.mark.parametrize("page,text", [
    (f"<body><nav><a>x y</a></nav><main><h1>T &amp; U</h1><p>{BODY}\n  end</p></main><footer>f g</footer></body>", f"T & U\n\n{BODY} end"),
    (f"<div class='sidebar'><p>{BODY}</p></div><article><p>{BODY}</p><aside>no</aside><p>tail of it</p></article>", f"{BODY}\n\ntail of it"),
    (f"<article><p>{BODY}</p></article><section class='comments'><p>{BODY}</p><p>{BODY}</p></section>", BODY),
    (f"<article><p>a<b>b</b>c &lt;tag&gt; {BODY}</p><form>go</form><script>var x='<p>no</p>'</script></article>", f"abc <tag> {BODY}"),
    (f"<article><p>{BODY}<ul><li>one two</li><li>three</li></ul></article>", f"{BODY}\n\none two\n\nthree"),
    (f"<!-- <p>no</p> --><P CLASS=x>{BODY}&nbsp;&#233;</P>", f"{BODY} é"),
    (f"<article><header><h1>Title</h1></header><p>{BODY}</p></article>", f"Title\n\n{BODY}"),
    ("", ""),
    (None, ""),
    ("<p></p><nav>only menu</nav>", ""),
    (f"{BODY} and 1 < 2", f"{BODY} and 1 < 2"),
])
def test_layouts(model, page, text):
    assert H.extract(page, model) == text


HEADS = "<!DOCTYPE html><html><head><meta charset=utf-8><title>t</title><link rel=x href=y>"


@pytest.mark.parametrize("page,text", [
    (f"{HEADS}<body><nav>a b</nav><p>{BODY}</p></body></html>", BODY),
    (f"{HEADS}<p>{BODY}</p>", BODY),
    (f"{HEADS}{BODY}", BODY),
    (f"{HEADS}<nav>a b</nav><div><article><p>{BODY}</p></article></div>", BODY),
    (f"<body><form id='aspnetForm'><input name=v><nav>a b</nav><div><p>{BODY}</p></div><label>c d</label></form></body>", BODY),
    (f"<form><div><p>{BODY}</p></div><form>go</form></form><footer>f g</footer>", BODY),
    (f"<div class='site-content no-sidebar'><article><p>{BODY}</p></article></div>", BODY),
    (f"<div class='has-sidebar'><div><p>{BODY}</p></div><div class='sidebar'><p>side bar</p></div></div><footer>f g</footer>", BODY),
    (f"<div id='page-with-banner'><form><main><p>{BODY}</p></main><div class='widget'>w x</div></form></div>", BODY),
    (f"<nav><a>a b</a><article><p>{BODY}</p></article>", BODY),
    # boilerplate that holds much stays out where the content is outside
    (f"<div><p>{BODY}</p></div><div class='comments'><p>{BODY}</p><p>x y z</p></div>", BODY),
    (f"<div><p>{BODY}</p><div class='ad'>buy it</div><p>tail of it</p></div>", f"{BODY}\n\ntail of it"),
    (f"<article><p>{BODY}</p></article><aside class='related'><article><p>{BODY} {BODY}</p></article></aside>", BODY),
    ("<p>x</p><footer>f g h i j</footer>", "x"),
])
def test_content_inside_boilerplate_elements(model, page, text):
    assert H.extract(page, model) == text


def test_hint_words_are_learned(spark):
    """Where a hint word names the elements around the content, it costs nothing elsewhere in the same pages."""
    wrapped = [(i, f"<div class='social'><nav>a b</nav><article><p>{BODY}</p></article></div><div class='widget'>w</div>") for i in range(40)]
    fitted = H.fit(spark.createDataFrame(wrapped, "page_id long, html string"))
    assert fitted.hint("social") > 0.9 > 0.1 > fitted.hint("widget")
    page = f"<div><p>{BODY}</p><div class='social'><p>more of it</p></div><div class='widget'>no</div></div>"
    assert H.extract(page, fitted) == f"{BODY}\n\nmore of it"


@pytest.mark.parametrize("piece", ["<", "<a ", "<a b='", "<p>", "</p>", "<!--", "<script>", "&amp;", "<div class=\"", "x "])
def test_long_broken_pages_end_soon(model, piece):
    H.extract(piece * (200_000 // len(piece)), model)


def test_columns_nulls_and_empty_tables(spark, model):
    rows = [(1, f"<p>{BODY}</p>", "a", 5), (1, None, "b", 6), (None, "", "c", 7)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, other int")
    out = H.main_text(pages, model).orderBy("other").collect()
    assert [(r["page_id"], r["text"], r["n_chars"], r["other"]) for r in out] == [(1, BODY, len(BODY), 5), (1, "", 0, 6), (None, "", 0, 7)]
    assert H.main_text(pages.limit(0), model).count() == 0
    none = H.fit(pages.select("page_id", F.lit(None).cast("string").alias("html")))
    assert H.extract(f"<nav>a</nav><p>{BODY}</p>", none) == BODY
