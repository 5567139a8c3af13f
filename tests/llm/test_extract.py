import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.llm import extract

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p { color: red }</style></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies. Accept?</div>
<article><h1>A title &amp; more</h1>
<p>First   paragraph of the article,
with a <b>bold</b> word, a <a href="#">link</a> and a long enough sentence to be read as prose by anyone.</p>
<script>var x = "<p>no</p>";</script>
<p>Second paragraph: caf&eacute; &#8212; it goes on, and ends here.</p></article>
<section class="comments"><p>Great post, thanks, I learned a lot from it, and so on.</p></section>
<footer><p>Copyright 2024, all rights reserved.</p></footer></body></html>"""

TEXT = ("A title & more\n\nFirst paragraph of the article, with a bold word, a link and a long enough sentence to be read as prose "
        "by anyone.\n\nSecond paragraph: café — it goes on, and ends here.")


def cost(excess, edges, content):
    cut = sum(-x if x < 0 and c else x if x > 0 and not c else 0 for x, c in zip(excess, content))
    return cut + sum(w for u, v, w in edges if content[u] != content[v])


@pytest.mark.parametrize("seed", range(30))
def test_min_cut_is_the_cheapest_labelling(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    excess = [rng.randint(-20, 20) for _ in range(n)]
    edges = [(u, v, rng.randint(0, 12)) for u in range(n) for v in range(u + 1, n) if rng.random() < 0.5]
    got = extract.min_cut(excess, edges)
    best = min(cost(excess, edges, labels) for labels in itertools.product([False, True], repeat=n))
    assert cost(excess, edges, got) == best


def test_article_without_its_surroundings():
    assert extract.main_text(PAGE) == TEXT


def test_odd_pages(spark):
    long_page = "<html><body><article>" + "<p>" + "word, " * 200_000 + "</p></article></body></html>"
    odd = ["", None, "   ", "<", "<p", "<!-- open", "</div></p>", "<script>never closed", "&amp;&#0;&bogus;",
           "<div>" * 3_000 + "deep" + "</div>" * 3_000, PAGE, PAGE, long_page]
    rows = spark.createDataFrame(pd.DataFrame({"page_id": range(len(odd)), "html": odd, "text": "clash"}))
    got = {r.page_id: r.out for r in rows.withColumn("out", extract.extract(F.col("html"))).collect()}
    assert [got[i] for i in (0, 1, 2)] == ["", "", ""]
    assert got[10] == got[11] == TEXT
    assert got[12] == ("word, " * 200_000).strip()
    assert all(isinstance(t, str) for t in got.values())
    assert rows.limit(0).select(extract.extract(F.col("html"))).count() == 0


PROSE = "Long prose, of two sentences. It says what it has to say, and it goes on for a while, as prose does. " * 3
LONG = PROSE.strip()


@pytest.mark.parametrize("page,text", [
    (f"<html><body><div><p>{PROSE}</p><p>The end.</p></div><footer><p>Imprint</p></footer>", [LONG, "The end."]),
    (f"<html><body><nav><ul><li>Home</ul></nav><div><h1>Title</h1><p>{PROSE}</p></div>", ["Title", LONG]),
    (f"<html><body><nav><ul><li>Home</ul></nav><div><h1>Title</h1><div><p>{PROSE}</p></div></div>", ["Title", LONG]),
    (f"<html><body><div><p>{PROSE}</p><div class=ad>Buy, buy, buy!</div><p>So it was.</p></div><footer>Imprint</footer>", [LONG, "So it was."]),
    (f"<html><body><div><p>{PROSE}</p><div class=ad><p>Buy!</p></div><p>Yes.</p><div class=ad><p>Buy!</p></div></div>", [LONG, "Yes."]),
    (f"<html><body><p>{PROSE}</p><p>The end.</p><footer>Imprint</footer>", [LONG, "The end."]),
    (f"<html><body><div>Log in</div><div><p>{PROSE}</p></div><div>Imprint</div>", [LONG]),
])
def test_short_blocks_of_a_container_without_telling_names(page, text):
    assert extract.main_text(page) == "\n\n".join(text)


@pytest.mark.parametrize("page,text", [
    (f"<html><body><form id=form1><nav>Home</nav><article><h1>Title</h1><p>{PROSE}</p></article></form>", ["Title", LONG]),
    (f"<html><body><form><main><p>Short.</p></main><p>{PROSE}</p></form><div><p>{PROSE * 4}</p></div>", ["Short.", (PROSE * 4).strip()]),
    (f"<html><body><form id=aspnetForm><nav>Home</nav><div><p>{PROSE}</p></div></form>", [LONG]),
    (f"<html><body><div><p>{PROSE}</p></div><form><p>Your name, please, and your address.</p></form>", [LONG]),
])
def test_forms(page, text):
    assert extract.main_text(page) == "\n\n".join(text)


ARTICLE = f"<article><h1>Title</h1><p>{PROSE}</p></article>"
COMMENT = "Great post, thanks, I learned a lot from it, and so on; I will tell all my friends, of whom there are many. " * 2


@pytest.mark.parametrize("page,text", [
    # words in the names of wrappers, of whole articles, of elements around the only text
    (f'<div class="layout has-sidebar"><p>{PROSE}</p></div><footer>Imprint</footer>', [LONG]),
    (f'<main class="comments-open"><p>{PROSE}</p></main>', [LONG]),
    (f'<div class="social-history"><p>{PROSE}</p></div>', [LONG]),
    (f'<div class="hentry comments-open">{ARTICLE}</div>', ["Title", LONG]),
    (f'<div class="related-posts-enabled">{ARTICLE}</div>', ["Title", LONG]),
    (f'<div id="ad-free-site">{ARTICLE}<p class="ad">Buy!</p></div>', ["Title", LONG]),
    (f'<div class="widget"><nav>Home</nav>{ARTICLE}</div>', ["Title", LONG]),
    (f'<div class="popup"><p>{PROSE}</p></div>', [LONG]),
    (f'<article class="post has-sidebar"><p>{PROSE}</p></article><aside>About us.</aside>', [LONG]),
    (f'<div class="content has-sidebar"><p>{PROSE}</p><p>The end.</p></div><div class="sidebar"><p>{PROSE}</p></div>', [LONG, "The end."]),
    # what these names say of the parts themselves
    (f'{ARTICLE}<div class="sidebar"><p>{PROSE}</p></div>', ["Title", LONG]),
    (f'{ARTICLE}<div class="page-sidebar"><h2>News</h2><p>{PROSE}</p></div>', ["Title", LONG]),
    (f'{ARTICLE}<div class="comments"><p>{COMMENT}</p><p>{COMMENT}</p></div>', ["Title", LONG]),
    (f'{ARTICLE}<ol class="comment-list">' + f'<li class="comment"><article class="comment-body"><p>{COMMENT}</p></article></li>' * 9 + "</ol>", ["Title", LONG]),
    (f'{ARTICLE}<div class="user-comments"><p>{COMMENT * 4}</p></div>', ["Title", LONG]),
    (f'{ARTICLE}<div class="related-posts"><article><h2>Other</h2><p>{PROSE[:90]}</p></article><article><p>{PROSE[:80]}</p></article></div>', ["Title", LONG]),
    (f'<div class="content"><p>{PROSE * 2}</p></div><div class="related"><article><p>{PROSE}</p></article></div>', [(PROSE * 2).strip()]),
    (f'<div class="cookie-notice"><p>{PROSE}</p></div>{ARTICLE}<div class="site-footer"><p>{PROSE}</p></div>', ["Title", LONG]),
    (f'<article><p>{PROSE}</p><div class="share-buttons"><p>Share this, if you like.</p></div><p>The end.</p></article>', [LONG, "The end."]),
    # an article's own header, and text that is hidden from screen readers only
    (f'<header><h1>The Site</h1></header><article><header><h1>Title</h1><p>By someone, today.</p></header><p>{PROSE}</p></article>', ["Title", LONG]),
    (f'<article><p aria-hidden="true">{PROSE}</p><p hidden>Not shown.</p></article>', [LONG]),
])
def test_names_are_weighed_by_what_the_element_holds(page, text):
    assert extract.main_text("<html><body>" + page) == "\n\n".join(text)


def test_deep_signed_elements_take_no_square_time():
    page = '<div class="has-sidebar x">' * 20_000 + PROSE + "</div>" * 20_000
    assert extract.main_text(page) == LONG


def test_many_undecided_blocks_in_one_container():
    page = "<html><body><div>" + "".join(f"<p>{'Some words, and more. ' * (i % 7)}x</p>" for i in range(5_000)) + "</div></body></html>"
    assert len(extract.main_text(page)) > 0
