"""Main text of hand-made pages."""

import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm.html_extract import extract, main_text, surges

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1><form><input><label>Search here</label></form></header>
<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>
<div class="cookie-banner">We use cookies and want you to read this very long notice about them now.</div>
<article><h1>Head &amp; line</h1><p><b>First   paragraph <i>with</i> some&nbsp;text.<br>and a break<p>Second &lt;one&gt;, caf&eacute;.</p>
<div class="ad">Buy this now, it is cheap and good and everyone has one already.</div><ul><li>one<li>two</ul><p>End.</article>
<aside>Related stories that go on and on for quite a while, with many words.</aside>
<section id="comments"><p>A reader says a lot of things here, at some length, about the article.</p></section>
<footer>&copy; Site</footer></body></html>"""
TEXT = "Head & line\nFirst paragraph with some text. and a break\nSecond <one>, café.\none\ntwo\nEnd."


def test_article():
    assert main_text(ARTICLE) == TEXT


def test_cut_off_page():
    assert main_text(ARTICLE[:ARTICLE.index("<ul><li>one")]) == "\n".join(TEXT.split("\n")[:3])


def test_surge_and_dive_without_marks():
    body = "".join(f"<p>Paragraph {i} of the main text, which is long enough to stand out here.</p>" for i in range(6))
    page = ("<body><div><a href=x>Home</a></div><div><a href=y>News</a></div><div><a href=z>Sport</a></div><h2>Title</h2>" + body
            + "".join("<div><a href=q>link</a></div>" for _ in range(5)) + "<div>foot</div></body>")
    got = main_text(page).split("\n")
    assert got[0] == "Title" and len(got) == 7 and got[-1].startswith("Paragraph 5")


def test_block_without_marks():
    """Short paragraphs of an unmarked block stay, what is around it goes."""
    body = "<h1>Title</h1><p>Short.</p>" + "".join(f"<div><p>A paragraph {i} that is long enough to be found as text.</p></div>" for i in range(5))
    page = ("<body><div><a href=x>Home</a> <a href=y>News</a></div><div>Tagline of site</div><div>" + body + "<p>Bye.</p></div>"
            "<div><a href=q>link</a></div><div>All rights kept</div></body>")
    got = main_text(page).split("\n")
    assert got[:2] == ["Title", "Short."] and got[-1] == "Bye." and len(got) == 8


def test_surges():
    assert surges([0, 0, 0, 50, 60, 2, 55, 0, 0, 0, 0, 9], 3, 0.15) == [(3, 7)]
    assert surges([], 3) == [] and surges([0, 0], 3) == []


@pytest.mark.parametrize("page,want", [("", ""), ("<p>a &lt b", "a < b"), ("1 < 2", "1 < 2"), ("<p>x<scr", "x"),
                                       ("<script>never closed <p>x", ""), ("<!-- open <p>x", ""), ("<article></article>", ""),
                                       ("<p title='a>b'>q", "q"), ("plain", "plain"), ("<form><article><p>in a form</p></article></form>", "in a form")])
def test_odd_pages(page, want):
    assert main_text(page) == want


def test_long_page():
    page = "<article>" + "".join(f"<p>{i} " + "word " * 50 + "</p>" for i in range(5000)) + "</article>"
    assert len(main_text(page).split("\n")) == 5000
    assert len(main_text("<div>" * 20_000 + "<p>deep text</p>").split()) == 2


def test_dataframe(spark):
    rows = [(1, "u", ARTICLE, "t"), (2, None, None, "t"), (None, "u", "", "t"), (1, "u", ARTICLE, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.url, r.text, r.n_chars) for r in extract(df).collect())
    assert got == [("1", "u", TEXT, len(TEXT)), ("1", "u", TEXT, len(TEXT)), ("2", None, "", 0), ("None", "u", "", 0)]
    assert extract(df.limit(0)).collect() == []


def test_given_pages_hold_their_documents(spark):
    """The article of a given page is its title and the document's lines."""
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.001"
    got = extract(spark.read.parquet(f"{d}/pages.parquet")).withColumn(
        "doc_id", F.regexp_extract("url", "://[^/]+/[a-z]+/([0-9]+)", 1).cast("long"))
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("text").alias("doc"))
    rows = got.join(docs, "doc_id").collect()
    assert rows
    for r in rows:
        lines = [" ".join(x.split()) for x in r.doc.split("\n")]
        assert r.text.split("\n")[1:] == [x for x in lines if x]
