import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from filingloom.llm import html
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_on_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op8_main_text"](spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        body = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<(/?b|br)>", " ", body))
        blocks = [" ".join(unescape(p).split()) for p in parts]
        text = "\n\n".join(b for b in blocks if b)
        assert got[page["page_id"]]["text"] == text and got[page["page_id"]]["n_chars"] == len(text)


STORY = "A paragraph of the story that goes on for a good while and says a thing or two."
CASES = {
    "marked": (f"<nav>Home</nav><article><h1>T</h1><p>{STORY}<p>Tiny.</article><footer>Foot</footer>", f"T\n\n{STORY}\n\nTiny."),
    "classes": (
        f"<div class='top menu'><a href=x>Home</a></div><div class=content><h2>T</h2><p>{STORY}</p><div class=ad>Buy!</div>"
        f"<p>Second&nbsp;&amp; last.</p></div><div id=sidebar><p>{STORY}</p></div><div class='comments'><p>{STORY}</p></div>",
        f"T\n\n{STORY}\n\nSecond & last.",
    ),
    "roles": (f"<div role=banner>Site</div><main><p>{STORY}</p></main><div role=contentinfo>x</div>", STORY),
    "raw parts": (f"<script>var a='</p><p>no';</script><style>p{{}}</style><article><p>{STORY}</p><form>Mail <input></form></article>", STORY),
    "comments inside": (f"<article><p>{STORY}</p><section class=comments><article><p>{STORY}</p></article></section></article>", STORY),
    "article as comment": (f"<article><p>{STORY}</p></article><article class=comment><p>{STORY}</p></article>", STORY),
    "notice first": (f"<div class=cookie-notice><p>{STORY}</p></div><div id=post-body><p>{STORY} x</p></div>", f"{STORY} x"),
    "page header": (f"<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>{STORY}</p></article>", f"T\n\n{STORY}"),
    "hidden": (f"<article><p hidden>no</p><p style='display: none'>no</p><p>{STORY}</p></article>", STORY),
    "open menu": (f"<nav><ul><li>Home<article><p>{STORY}</p></article>", STORY),
    "links": (f"<div><a>One</a> <a>Two</a></div><div></div><div></div><div><p>{STORY} {STORY}</p></div>", f"{STORY} {STORY}"),
    "breaks": ("<article><p>one<br>two <b>bo</b>ld\n\t x</p></article>", "one two bold x"),
    "names of paragraphs": (
        "<article><h2 id=comments-on-method>C</h2><p class=share>share price rose</p><p id=advertising>ads</p><p class=alert>look</p>"
        "<section id=related-work><h2>Related</h2><p>work</p></section><section class=discussion><p>talk</p></section></article>",
        "C\n\nshare price rose\n\nads\n\nlook\n\nRelated\n\nwork\n\ntalk",
    ),
    "regions in an article": (
        f"<article><div class='share-buttons'>Tweet</div><p>{STORY}</p><div class=ad>Buy</div><ul class=related-posts><li>More</ul>"
        f"<div class='newsletter-signup box'>Mail</div><div id=comments><p>{STORY}</p></div><div class=cookie-notice>ok</div></article>",
        STORY,
    ),
    "formula": ("<article><p>see <math><mi>E</mi></math> ok</p></article>", "see E ok"),
    "closed widgets": (f"<article><p>a <svg><text>no</text></svg> b</p><select><option>no</select><p>{STORY}</p></article>", f"a b\n\n{STORY}"),
    "ends behind the article": (f"<article><p>{STORY}</p><svg><p>more</p></article><footer><svg></svg>x</footer>", f"{STORY}\n\nmore"),
    "bare": ("just text &lt;b&gt; &#233; &hellip;", "just text <b> é …"),
    "nothing": ("<nav>menu</nav><script>x</script>", ""),
    "broken": ("<article><p>a < b and c <3 d</p", "a < b and c <3 d</p"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, text = CASES[name]
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    ["<p>hello there</p><a " + '"x" ' * 5000, "<b>" * 30000 + "</i>" * 30000, "<p>hello there</p>" + '<a href="' * 20000],
    ids=["cut_tag", "open_tags", "open_quotes"],
)
def test_broken_markup_takes_linear_time(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("tag", ["select", "object", "canvas", "svg", "template", "noscript"])
def test_a_tag_that_is_never_closed_eats_nothing(tag):
    page = f"<article><p>{STORY}</p><{tag} id=x><p>Second.</p><div><p>Third.</p></div></article><footer>no</footer>"
    assert html.main_text(page) == f"{STORY}\n\nSecond.\n\nThird."
    assert html.main_text(f"<article><p>{STORY}</p>" + f"<{tag}> a" * 20_000 + "</article>").count("a") > 20_000


def test_window_sums_and_stretches():
    assert html.window_sums([1, 0, 0, 5, 2], 3) == [1, 5, 7, 7, 2]
    assert html.stretches([90, 0, 0, 0, 0, 80, 70]) == [(0, 1), (3, 7)]
    assert html.stretches([]) == []


def test_edges(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, f"<p>{STORY * 2000}</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.with_main_text(pages)
    assert got.columns == pages.columns
    assert sorted(len(r["text"]) for r in got.collect()) == [0, 0, len(STORY) * 2000]
    assert html.with_main_text(pages.filter(F.lit(False))).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='has-sidebar'><main><p>{STORY}</p></main></div>", STORY),
        (f"<div class='content-sidebar-wrap'><main><h1>T</h1><p>{STORY}</p></main><div class=sidebar>Side</div></div>", f"T\n\n{STORY}"),
        (f"<div id=page-with-menu><div class=menu>Home</div><div><p>{STORY}</p></div></div>", STORY),
        (f"<form id=aspnetForm action=x><div><p>{STORY}</p></div><div class=footer>Foot</div></form>", STORY),
        (f"<main><p>{STORY}</p></main><div class=related><article><p>Other</p></article></div>", STORY),
        (f"<main><p>{STORY}</p></main><div class=comments><article><p>{STORY} {STORY}</p></article></div>", STORY),
        (f"<div class=has-sidebar><article><p>{STORY}</p></article><section class=comments><article><p>{STORY} x</p></article></section></div>", STORY),
    ],
)
def test_a_wrapper_named_like_an_aside_keeps_its_article(page, text):
    assert html.main_text(page) == text


LONG = " ".join([STORY] * 8)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><h1>T</h1><p>{STORY}</p><p><a href=x>Read the full report</a></p></article>", f"T\n\n{STORY}\n\nRead the full report"),
        (
            f"<article><p>{STORY}</p><ul>" + "".join(f"<li><a href=x>Source {i}</a></li>" for i in range(6)) + "</ul><p>End.</p></article>",
            "\n\n".join([STORY, *(f"Source {i}" for i in range(6)), "End."]),
        ),
        (f"<article><div><p>{LONG}</p></div><figure><img></figure><div><p>Short.</p></div></article>", f"{LONG}\n\nShort."),
        (f"<div class=content><div><p>{LONG}</p></div><figure><img></figure><div><p>{STORY}</p></div></div>", f"{LONG}\n\n{STORY}"),
        (f"<body><div><p>{LONG}</p></div><figure><img></figure><div><p>{STORY}</p></div></body>", f"{LONG}\n\n{STORY}"),
        (f"<div class=content><div><p>{LONG}</p></div><figure><img></figure><div><p>Short.</p></div></div>", f"{LONG}\n\nShort."),
        (f"<div><a href=x>One</a></div><div class=content><p>{LONG}</p></div><article><a href=x>More</a></article>", LONG),
    ],
)
def test_nothing_inside_the_article_is_dropped(page, text):
    assert html.main_text(page) == text
