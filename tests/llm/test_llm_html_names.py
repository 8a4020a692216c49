"""Classes that name the text beside other words, and texts in several blocks."""

import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm.html_extract import main_text

BODY = "".join(f"<p>Paragraph {i} of the main text, long enough to stand out from the rest.</p>" for i in range(4))
TEXT = "\n".join(f"Paragraph {i} of the main text, long enough to stand out from the rest." for i in range(4))


@pytest.mark.parametrize("tag", [
    "div class='post-content no-sidebar'", "div class='entry comments-open'", "section class='content has-toc'",
    "div class='content-with-sidebar'", "div class='story related-enabled'", "article class='post comments-open'",
    "div class='page side' id='main-content'"])
def test_names_of_the_text_win(tag):
    side = "<div class='sidebar'><p>A sidebar with much text of its own, which must not be in the result at all.</p></div>"
    assert main_text(f"<body>{side}<{tag}>{BODY}</{tag.split()[0]}><p>Foot of the page.</p></body>") == TEXT


@pytest.mark.parametrize("tag", [
    "div class='article-footer'", "div class='post-comments'", "div class='sidebar no-ads'", "div class='cookie-banner'",
    "article class='comment-body'", "div class='content__ad'", "div id='comments' class='content'", "div class='ad post'",
    "div hidden", "div style='color: red; display: none'", "section title=x hidden=hidden"])
def test_other_names_still_go(tag):
    assert main_text(f"<article>{BODY}<{tag}><p>Something else that is long enough to be taken.</p></{tag.split()[0]}></article>") == TEXT


def test_siblings_with_one_mark_are_one_text():
    more = "<p>A second part of it, after the advert.</p>"
    page = f"<body><div><div class='post-content'>{BODY}</div><div class='ad'>Buy this, buy this.</div><div class='post-content x'>{more}</div></div></body>"
    assert main_text(page) == f"{TEXT}\nA second part of it, after the advert."
    assert main_text(f"<body><article>{BODY}</article><article>{more}</article></body>") == TEXT


@pytest.mark.parametrize("tag", ["article title='A hidden valley'", "article data-x='it hidden=no'", "article data-x=it's", "article title=hidden",
                                 "article title='a = b > c'", 'article data-x=5" class=big'])
def test_values_hide_nothing(tag):
    assert main_text(f"<body><{tag}>{BODY}</article><p>Foot of the page.</p></body>") == TEXT


def test_apostrophes_in_unquoted_values():
    page = f"<article><p data-x=it's>First paragraph of the text.</p>{BODY}<p data-y=it's>The last one of them.</p></article>"
    assert main_text(page) == f"First paragraph of the text.\n{TEXT}\nThe last one of them."


def test_article_in_a_block_with_an_odd_name():
    page = f"<body><div class='popular-science'><article>{BODY}</article></div><p>A paragraph outside of it, fairly long as well, but no text.</p></body>"
    assert main_text(page) == TEXT
    ads = f"<body><div class='ad'><p>{'Buy it now. ' * 30}</p></div><article>{BODY}</article></body>"
    assert main_text(ads) == TEXT


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(n):
        page = "".join(f"<div><p>line {i} of it</p>" for i in range(n))
        t = time.perf_counter()
        main_text(page)
        return time.perf_counter() - t

    seconds(500)
    assert seconds(8000) < 24 * seconds(1000)
