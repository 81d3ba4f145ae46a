"""Main texts of pages whose articles are known."""

import html
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meadowlark.llm.html_text import extract, main_text, smoothed
from tests.llm.conftest import prose

BEFORE = [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News &amp; more</a></li></ul></nav>',
    "<header><h1>The Site</h1><p>Since 1900, all the news that there is to print, and then some more.</p></header>",
    '<div class="cookie-notice">We use cookies to make this site better for you and everyone. <button>OK</button></div>',
    '<div id="topAd">Buy now, a very long advert text that goes on and on for some time, and on.</div>',
    '<form action="/s"><label>Search the site for anything you like</label><input name=q></form>',
    '<div role="navigation"><a href="/x">One</a> <a href="/y">Two</a></div>',
    '<ul class="menu"><li><a href="/1">Sports<li><a href="/2">Politics</ul>',
    "<script>var a = '<p>not a text</p>'; if (1 < 2) { b() }</script><style>p { margin: 0 }</style>",
]
AFTER = [
    "<aside><h3>More</h3><p>A sidebar with a long enough paragraph that could be taken for a text.</p></aside>",
    '<section id="comments"><h2>Comments</h2><article class="comment"><p>I disagree with all of this, and let me tell you at length why.</p></article></section>',
    '<div class="related-posts"><a href="/r">Another article that you may like to read today</a></div>',
    "<footer>&copy; 2024 The Site &middot; All rights reserved, wherever they may lie.</footer>",
    '<div style="display: none">Hidden words that nobody sees, however many of them there are.</div>',
    '<!-- a comment with <p>markup</p> in it --><noscript>Turn on scripts</noscript>',
]


def paragraphs(seed):
    rng = random.Random(seed)
    out = [(prose(seed * 100 + i, rng.choice([1, 2, 8, 30, 60])) + rng.choice(["", " & <so> on", " \"q\"", " é ß"])) for i in range(rng.randint(2, 9))]
    return [prose(seed + 5000, 6), *out, prose(seed + 7000, 80)]


def marked_up(text, rng):
    words = html.escape(text).split()
    if len(words) > 3 and rng.random() < 0.5:
        words[1] = f"<b>{words[1]}</b>" if rng.random() < 0.5 else f'<a href="/z">{words[1]}</a>'
    return rng.choice([" ", "\n  ", "\t"]).join(words)


def page(seed, wrap):
    rng = random.Random(seed)
    texts = paragraphs(seed)
    body = [f"<h1>{marked_up(texts[0], rng)}</h1>"] + [rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br></p>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>"]).format(marked_up(t, rng)) for t in texts[1:]]
    for extra in rng.sample(BEFORE + AFTER, 2):  # some stand within the article
        if not extra.startswith(("<header", "<div class=\"related")):
            body.insert(rng.randrange(1, len(body)), extra)
    around = rng.sample(BEFORE, rng.randint(1, len(BEFORE))), rng.sample(AFTER, rng.randint(1, len(AFTER)))
    close = "" if rng.random() < 0.2 else "</body></html>"
    head = f"<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>{html.escape(texts[0])}</title></head><body class='has-sidebar'>"
    return head + "".join(around[0]) + wrap.format("\n".join(body)) + "".join(around[1]) + close, " ".join(" ".join(t.split()) for t in texts)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div>{}</div></main>", '<div id="content"><div class="post">{}</div></div>', '<article class="post with-sidebar comment-open">{}</article>'])
def test_articles(wrap):
    for seed in range(60):
        made, want = page(seed, wrap)
        assert main_text(made) == want, seed


def test_one_article_beside_unmarked_text():
    """Without landmarks or names, ratios alone tell paragraphs from lists of links."""
    links = "".join(f'<div><a href="/{i}">Link number {i}</a></div>' for i in range(12))
    texts = [prose(i, 50) for i in range(6)]
    made = f"<body>{links}<div><div>{''.join(f'<p>{t}</p>' for t in texts)}</div></div>{links}</body>"
    assert main_text(made) == " ".join(texts)


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p> </p>") == main_text("<nav>menu</nav>") == main_text("<script>x") == ""
    assert main_text("plain words") == "plain words"
    assert main_text("<p>a&nbsp;b&#8212;c &lt;d&gt; &am &amp e") == "a b—c <d> &am & e"
    assert main_text("<p>one<!-- never ended <p>two") == "one"
    assert main_text("<p>one<p>two</p></p></div></b><b>th</b>ree</b> <a href='") == "one two three"
    assert main_text("<p>1 < 2 and <![if x]>3<![endif]> > 2<?php x ?> ok</p>") == "1 < 2 and 3 > 2 ok"
    assert main_text("<p>so<b>me</b>thing<br>else<td>cell<td>next") == "something else cell next"
    assert main_text('<div class="ad">the only text of this page</div>') == "the only text of this page"  # names don't count then
    deep = "<div>" * 20000 + "<p>deep down</p>" + "</div>" * 20000 + "</x>" * 20000
    assert main_text(deep) == "deep down"
    long = prose(3, 200_000)
    assert main_text(f"<article><p>{long}</p></article>") == long


@given(st.lists(st.sampled_from([*"<>/!-&;\"'= abdivp\n", "<p>", "</p>", "<div class=ad>", "<!--", "<script", "&amp;", "<![CDATA[", "<?"]), max_size=60).map("".join))
@settings(max_examples=300, deadline=None)
def test_never_fails(text):
    got = main_text(text)
    assert got == " ".join(got.split())


def test_smoothing():
    x = np.array([0.0, 0, 10, 0, 0, 0, 0, 0])
    even = smoothed(x, 1.0)
    assert even.argmax() == 2 and even[1] == pytest.approx(even[3], rel=0.2) and (even >= 0).all() and even[7] == 0
    assert smoothed(np.full(5, 3.0)) == pytest.approx(np.full(5, 3.0))


def test_tables(spark):
    rows = [(1, "u", "<article><p>Text é</p></article>", "old"), (1, "u", "<article><p>Text é</p></article>", "old"), (2, None, None, "x"), (None, "v", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract(df).collect()), key=repr)
    assert got == sorted([(1, "Text é", 6), (1, "Text é", 6), (2, "", 0), (None, "", 0)], key=repr)
    assert extract(df.limit(0)).count() == 0 and extract(df).columns == ["page_id", "url", "html", "text", "n_chars"]
