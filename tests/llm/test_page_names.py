"""Pages whose wrappers, sections and paragraphs have telling names, near-copied articles, and pages that parse slowly."""

import time

import pytest

from tiers.llm import htmltext

TEXT = "The whole story is told in this paragraph, and it is the longest one on the page by far."


def text_of(html):
    found = htmltext.blocks(html)
    best = max((s for _, s, _, _ in found), default=0)
    return " ".join(t for _, s, t, _ in found if s == best)


@pytest.mark.parametrize(
    "html",
    [
        f"<body class='right-sidebar'><p>{TEXT}</p></body>",
        f"<body class='no-sidebar with-comments'><div><p>{TEXT}</p></div></body>",
        f"<div class='has-sidebar'><div class='sidebar'>Links</div><p>{TEXT}</p></div>",
        f"<body><form id='aspnetForm'><div id='sidebar'>Links</div><p>{TEXT}</p><form class='search'>Find</form></form></body>",
        f"<div class='sidebar-right-wrapper'><main><p>{TEXT}</p></main></div>",
        f"<main><section class='cookie-recipes'><p>{TEXT}</p></section></main>",
        f"<main><div class='social-history'><p>{TEXT}</p></div><div class='social-share'>Tell friends</div></main>",
        f"<article><p class='share-price'>{TEXT}</p><ul class='related-posts'><li>More</li></ul></article>",
        f"<article><p>{TEXT}</p></article><div class='comments'><article><p>I do not agree. {TEXT}</p></article></div>",
        f"<p>{TEXT}</p><div id='comment-list'>{'I do not agree at all. ' * 20}</div>",
        f"<div class='ad-slot'>Buy</div><p>{TEXT}</p><div class='top-banner-2'>Now</div><div class='cookie-notice'>Accept</div>",
    ],
)
def test_the_article_stays_whatever_its_wrappers_are_called(html):
    assert text_of(html) == TEXT


def test_long_names_do_not_merge_branches(spark):
    long = " ".join(f"utility-{c}{i}" for i in range(60) for c in "xyz")
    page = f"<div class='{long}'><div class='list'>Home About</div><div class='words'>Own words {{i}}</div></div>"
    rows = [(i, "http://a.example/", page.replace("{i}", str(i))) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in htmltext.main_text(df).collect()} == {f"Own words {i}" for i in range(12)}


def test_own_texts_stay_beside_many_near_copies(spark):
    copied = "".join(f"<p>Paragraph {k} of a release that many pages repeat</p>" for k in range(5))
    rows = [(i, "http://a.example/", f"<article><h1>Title {i}</h1>{copied}</article>") for i in range(60)]
    rows += [(1000 + i, "http://a.example/", f"<article><p>Own first {i}</p><p>Own second {i}</p></article>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in htmltext.main_text(df).collect()}
    assert all(texts[1000 + i] == f"Own first {i} Own second {i}" for i in range(20))


def test_end_tags_without_a_beginning_are_cheap():
    began = time.time()
    assert text_of("<div>" * 2000 + "</b></section>" * 60_000 + "text") == "text"
    assert time.time() - began < 10
