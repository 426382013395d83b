import random
import re

import pytest

from lodestack.llm import html_text
from lodestack.llm.html_text import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="side-bar sidebar"><p>Side, text, with, many, commas, in, it</p></div>
<div id="content"><h1>Title</h1><p>One, two &amp; three in a paragraph<b> of</b> text.<p>Second<br>line.<ul><li>a<li>b</ul>
<div class="comments"><p>I, disagree, strongly, with, all, of, this</p></div><form>x<input></form><script>var t="</p>";</script></div>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><footer>&copy; f</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "Title One, two & three in a paragraph of text. Second line. a b"


def test_declared_article():
    page = '<nav><a>x</a></nav><div class="ad">Ad text, long, with, commas, more, than, the, article.</div><article><h1>H</h1><p>S.</article>'
    assert main_text(page) == "H S."


LONG = "".join(f"<p>Long, paragraph, number, {k}, of, the, section.</p>" for k in range(10))
SHORT = """<h3>More</h3><ul><li>one</li></ul><blockquote>said</blockquote><pre>code</pre><table><tr><td>cell</td></tr></table>
<section><h4>End</h4><p>Bye.</p></section>"""
BESIDE = "More one said code cell End Bye."


def test_one_long_section_and_short_ones():
    links = "".join(f'<li><a href="/{k}">Another story of today</a></li>' for k in range(30))
    long = main_text(LONG)
    assert long.count("Long,") == 10
    for holder in ("article", "main", "div"):
        page = f"<nav><a>x</a></nav><{holder}><p>Intro.</p><section>{LONG}</section>{SHORT}</{holder}><footer>f</footer>"
        assert main_text(page) == f"Intro. {long} {BESIDE}"
    page = f"<main><div><p>Intro.</p><section>{LONG}</section>{SHORT}</div><div><ul>{links}</ul></div></main>"
    assert main_text(page) == f"Intro. {long} {BESIDE}"
    page = f"<main><article><div><section>{LONG}</section></div>{SHORT}</article><div><ul>{links}</ul></div></main>"
    assert main_text(page) == f"{long} {BESIDE}"


def test_siblings_of_the_best_container_in_a_body():
    long = main_text(LONG)
    page = f"<body><nav><a>x</a></nav><div>{LONG}</div><ul><li>First point.<li>Second point.</ul><div><p>Short end.</div><ul><li><a>a</a></ul></body>"
    assert main_text(page) == f"{long} First point. Second point. Short end."
    page = f"<body><div>{LONG}</div><h3>Sub</h3><div><p>one paragraph</div><table><tr><td>cell</table><blockquote>Quote me.</blockquote>Loose.<p><a>menu</a></p></body>"
    assert main_text(page) == f"{long} Sub one paragraph cell Quote me. Loose."
    page = f"<header>Site</header><article><header class='entry-header'><h1>The Title</h1></header>{LONG}<footer>f</footer></article>"
    assert main_text(page) == f"The Title {long}"


INSIDE = [
    '<section id="discussion"><h2>Discussion</h2><p>What it means.</p></section>', '<h2 id="related-work">Related work</h2><p>Others.</p>', '<h3 id="print">Print</h3>', '<h2 id="search">Search</h2>',
    '<p class="social-impact">On society.</p>', '<div class="ad-hoc-analysis"><p>By hand.</p></div>', '<section class="notice">A notice of law.</section>', '<div class="menu-of-the-day"><p>Soup.</p></div>',
    '<ul class="related"><li>a related thing<li>another</ul>', '<table class="comment-statistics"><tr><td>7</table>', '<figure class="popup"><figcaption>A figure.</figcaption></figure>', '<div role="search">How we searched.</div>',
]
FURNITURE = [
    '<div class="ad">Buy this.</div>', '<div class="advert-box top"><p>Buy, more, now.</p></div>', '<section class="comments"><p>I disagree.</p></section>', '<div id="comments"><p>So do I.</p></div>',
    '<article class="comment"><p>Me too.</p></article>', '<ul class="share-buttons"><li><a href="x">Share</a></ul>', '<div class="related-posts"><a href="x">Another story</a></div>', '<div class="newsletter"><p>Our letter.</p></div>',
    '<div class="search-box"><label>Find</label> <input> it</div>', '<aside>Aside.</aside>', '<nav><a>n</a></nav>', '<form>Your name <input></form>', '<footer>f</footer>',
]


@pytest.mark.parametrize("part", INSIDE)
def test_names_of_parts_of_an_article_do_not_cut_them(part):
    page = f"<nav><a>x</a></nav><article><h1>T</h1>{LONG}{part}<p>End.</p></article><footer>f</footer>"
    assert main_text(page) == main_text(f"<article><h1>T</h1>{LONG}{re.sub('(id|class|role)=.[^>]*', '', part)}<p>End.</p></article>")
    assert all(w in main_text(page) for w in re.sub("<[^>]*>", " ", part).split())


@pytest.mark.parametrize("part", FURNITURE)
def test_furniture_in_an_article_goes(part):
    assert main_text(f"<article><h1>T</h1>{LONG}{part}<p>End.</p></article>") == f"T {main_text(LONG)} End."


def test_all_articles_but_teasers():
    card = "<article><h2><a href='x'>Another story</a></h2><p>Short, and, sweet.</p></article>"
    linked = "<article><a href='x'><h3>A third story</h3></a><p>Read, it.</p></article>"
    story = "<article><h2>Part {0}</h2><p>It is short.</p></article>"
    long = main_text(LONG)
    assert main_text(f"<body>{card}<article><h1>T</h1>{LONG}</article>{card}{linked}</body>") == f"T {long}"
    assert main_text(f"<main>{story.format(1)}<div>{story.format(2)}</div>{card}</main>") == "Part 1 It is short. Part 2 It is short."
    assert main_text(f"<article><h1>T</h1><p>Short.</p></article>{card}") == "T Short."
    assert main_text(f"<article><h2>A</h2>{LONG}</article><article><h2>B</h2><p>b.</p></article>") == f"A {long} B b."


WORDS = "stone river, amber house walked over the; quiet (old) bridge and then, later on, came back.".split()


def _page(rng):
    """A page and the text of its article: known blocks of every kind among everything that must go."""
    say = lambda a, b: " ".join(rng.choice(WORDS) for _ in range(rng.randint(a, b)))
    blocks, texts = [], []
    for k in range(rng.randint(3, 12)):
        kind = rng.choice(["p", "p", "p", "h2", "h3", "h4", "h5", "ul", "ol", "blockquote", "pre", "table", "dl"]) if k else "p"
        x, y = say(30, 60) if k == 0 else say(2, 50), say(1, 9)
        if kind == "ul" or kind == "ol":
            blocks.append(f"<{kind}><li>{x}<li>{y}</{kind}>")
        elif kind == "table":
            blocks.append(f"<table><tr><th>{x}<td>{y}</table>")
        elif kind == "dl":
            blocks.append(f"<dl><dt>{x}<dd>{y}</dl>")
        else:
            blocks.append(f"<{kind}>{x} <i>{y}</i></{kind}>")
        texts.append(f"{x} {y}")
        if rng.random() < 0.3:
            blocks.append(rng.choice(['<script>var t = "<p>no</p>";</script>', f"<aside>{say(3, 9)}</aside>", f"<form>{say(2, 4)}<input></form>", "<!-- no -->"]))
    inner = "".join(blocks)
    if rng.random() < 0.5:
        at = rng.randint(1, len(blocks))
        inner = f"<section>{''.join(blocks[:at])}</section>" + "".join(blocks[at:])
    holder = rng.choice(["article", "main", "div id=content", "section"])
    junk = [
        f"<header><h1>{say(2, 4)}</h1></header>", "<nav><ul>" + "".join(f"<li><a href=x>{say(1, 2)}</a>" for _ in range(6)) + "</ul></nav>",
        f'<div class="side-bar sidebar"><p>{say(20, 60)}</p></div>', f'<div class="cookie-notice">{say(5, 20)}</div>', f'<div class="ad">{say(5, 25)}</div>',
        f"<form>{say(3, 6)}</form>",
    ]
    after = [f'<div class="comments"><p>{say(20, 60)}</p></div>', f"<footer>{say(3, 9)}</footer>", f"<style>p {{}}</style><div id=related><p>{say(9, 20)}</p></div>"]
    rng.shuffle(junk)
    rng.shuffle(after)
    page = f"<html><head><title>t</title></head><body>{''.join(junk[: rng.randint(0, 6)])}<{holder}>{inner}</{holder.split()[0]}>{''.join(after)}</body></html>"
    return page, " ".join(texts)


@pytest.mark.parametrize("seed", range(300))
def test_generated_pages_give_their_article(seed):
    page, text = _page(random.Random(seed))
    assert main_text(page) == text


def test_cut_off_and_odd_markup():
    assert main_text("<p>open and cut <b>here</") == "open and cut here"
    assert main_text("plain 1 < 2 & more") == "plain 1 < 2 & more"
    assert main_text("<script>never closed") == ""
    assert main_text("<div>" * 5000 + "deep") == "deep"
    assert main_text(None) == main_text("") == ""
    assert main_text("<p>&#x41;&eacute;&nbsp;b</p>") == "Aé\xa0b"


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main string")
    got = sorted((str(r.page_id), r.main_text) for r in html_text.extract(pages).collect())
    assert got == sorted([("1", main_text(PAGE))] * 2 + [("None", ""), ("2", "")])
    assert html_text.extract(pages.filter("false")).count() == 0
    clash = pages.withColumnRenamed("main", "main_text")
    assert html_text.extract(clash).columns == ["page_id", "url", "main_text"]
