"""Main text of pages: hand-made pages, hidden junk and odd markup."""

from __future__ import annotations

import html
import random
import time

import pytest

from modeforge.llm.maintext import main_text

P1 = "The first paragraph, which has commas, is long enough to be read as a story and not as a label."
P2 = "Another one follows, it says more of the same, and ends where it should."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("<!-- only --><script>var a='<p>x</p>'</script>", ""),
        ("just words &amp; more", "just words & more"),
        (f"<article><h1>Title</h1><p>{P1}<p>{P2}</article>", f"Title {P1} {P2}"),
        # Phrases do not part words, breaks and blocks do; an open phrase does not matter.
        ("<article><p><b>One<br>two<p>th<i>ree</i>,\n four&nbsp;five</p></b></article>", "One two three, four five"),
        # Boxes by element, role, class and id.
        (f"<body><nav><a href=x>Home</a></nav><div class='ad box'>{P2}</div><div id=main>{P1}<p>{P2}</div><div id='cookie-notice'>{P2}</div><footer>{P2}</footer>", f"{P1} {P2}"),
        (f"<main><p>{P1}</p><aside>{P2}</aside><form><p>{P2}</p><input></form><div role=complementary>{P2}</div></main>", P1),
        (f"<div><p>{P1}</p><p>{P2}</p></div><section id=comments><article class=comment><p>{P2 * 9}</p></article></section>", f"{P1} {P2}"),
        # Menus without a name go by their links; single links in the text stay.
        (f"<div><p>{P1} <a href=x>here</a></p><ul><li><a href=1>Home page</a></li><li><a href=2>News, all of it</a></li></ul></div>", f"{P1} here"),
        (f"<div class=page><div><a href=1>One</a> <a href=2>Two</a></div><div class=story><p>{P1}</p></div></div>", P1),
        # Sections of one story are siblings; boxes of links are not, and words beside the story stay out.
        (f"<body><div><p>{P1}</p></div><div><p>{P2}</p></div><div><a href=1>Far</a> | <a href=2>away</a></div></body>", f"{P1} {P2}"),
        (f"<body><div><p>{P1}</p><p>{P2}</p><p>{P2}</p></div><div>Menu</div></body>", f"{P1} {P2} {P2}"),
        # Names do not outweigh the article; a page's header does not stay, that of the article keeps its headings.
        (f"<div class='wrap sidebar'><header><h1>Site</h1></header><article><header><h1>T</h1><p>by someone</p></header><p>{P1}</p></article></div>", f"T {P1}"),
        (f"<form action=x><div><p>{P1}</p><p>{P2}</p><button>Go</button></div></form>", f"{P1} {P2}"),
        (f"<article class='post has-sidebar with-ads'><p>{P1}</p></article>", P1),
        # Lists, tables and quotes are text.
        (f"<article><p>{P1}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><blockquote>said</blockquote></article>", f"{P1} one two a b c said"),
        # Hidden parts, attributes with marks, unfinished and stray tags.
        (f"<article><p hidden>no</p><p title='a > b'>{P1}</p><p style='display: none'>no</p></span></p></article>", P1),
        ("<article><p>1 < 2 and 3 > 2</p><p>cut <a href='x", "1 < 2 and 3 > 2 cut"),
        ("<article><p>&lt;b&gt; &#233;&#x20AC; &amp;amp; &copy &unknown;</p></article>", "<b> é€ &amp; © &unknown;"),
        ("<ARTICLE><H1>A</H1><SCRIPT>if (a</b) '</p>'</SCRIPT><P>b</ARTICLE>", "A b"),
        ("<article><h1>Only a title</h1></article><div class=ad>words, words, words</div>", "Only a title"),
    ],
)
def test_hand_made_pages(source, text):
    assert main_text(source) == text


def test_junk_around_an_article_never_shows():
    rng = random.Random(4)
    words = "alpha beta, gamma delta. épsilon & zeta <eta>".split(" ")
    junk = [
        "<nav><ul><li><a href='/x'>JUNK</a></li></ul></nav>", "<header><p>JUNK, junk</p></header>", "<div class='ad'>JUNK text, JUNK</div>",
        "<aside><p>JUNK</p></aside>", "<!-- JUNK <p> -->", "<script>var JUNK = '</p>';</script>", "<div id='sidebar'><p>JUNK</p></div>",
        "<section class='comments'><p>JUNK, JUNK and JUNK, by a reader who writes a lot.</p></section>", "<footer>JUNK &copy;</footer>",
        "<div class='cookie-banner'>JUNK, JUNK</div>", "<form><label>JUNK</label><input></form>",
    ]
    for _ in range(300):
        blocks = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 8))]
        marked = "".join(f"<p>{html.escape(b)}</p>" if rng.random() < 0.7 else f"<p><b>{html.escape(b)}<br>" for b in blocks)
        source = "<!DOCTYPE html><html><body>" + "".join(rng.sample(junk, 4)) + f"<article><h1>Head</h1>{marked}</article>" + "".join(rng.sample(junk, 4))
        assert main_text(source) == " ".join(["Head", *(" ".join(b.split()) for b in blocks)])


def test_large_and_deep_pages_take_linear_time():
    started = time.monotonic()
    deep = "<div>" * 50_000 + f"<p>{P1}</p>"
    assert main_text(deep) == P1
    assert main_text("<article>" + f"<p>{P1}" * 20_000) == " ".join([P1] * 20_000)
    assert main_text("<p>" + "x" * 2_000_000) == "x" * 2_000_000
    assert main_text("<article>" + "<ul><li>" * 20_000 + "end") == "end"
    main_text("<a '" * 50_000)
    main_text("</i>" * 100_000 + "<" * 100_000)
    assert time.monotonic() - started < 30
