"""Main text of pages: known texts in pages of many shapes, plain search for the best run, odd markup."""

import random
import time

import pytest

import __spark_entry__ as entry
from daygrain.llm import html_extraction
from daygrain.llm.html_extraction import Weights, best_run, main_text

PROSE = [
    "The first paragraph of the article has a dozen words or so in it.",
    "A second one follows & says that 2 < 3, “quoted” and naïve, at some length too.",
    "Short.",
    "The last paragraph closes the article with a few more words than are needed.",
]
BODY = "<h1>A title of the page</h1><p>{}</p><p>{}</p>\n<p> {}</p><p>{}</p>".format(*(p.replace("&", "&amp;").replace("2 <", "2 &lt;") for p in PROSE))
TEXT = "\n".join(["A title of the page", *PROSE])

AROUND = [
    '<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two words</a></li></ul></nav>',
    "<header><a href=/>The name of the site</a><p>With a line about what it is for, at some length.</p></header>",
    "<footer>&copy; 2024 Someone. All rights reserved, and a line that goes on and on for a while.</footer>",
    "<aside><h2>Read more</h2><p>Other pages that are worth to be read by all who read this one.</p></aside>",
    '<div class="ad">Buy the thing now and get another thing for nothing at all, today only.</div>',
    '<div class="cookie-notice"><p>We use cookies for this and that, see the long policy for what they are.</p></div>',
    '<form action="/s"><label>Search the site</label><input name=q><button>Go</button></form>',
    '<section id="comments"><h2>2 comments</h2><article class="comment"><p>I do not agree with this at all, since things are otherwise.</p></article>'
    "<article><p>But I do agree with all of it, and more than that, here is why.</p></article></section>",
    '<div class="sidebarLeft"><p>Some links and words that stand beside the text of the page.</p></div>',
    "<script>var x = '<p>no text of the page at all</p>';</script><style>p { color: red }</style>",
    "<!-- <p>A remark that nobody sees, of several words.</p> --><noscript>Turn on scripts to read this page.</noscript>",
    '<div role="dialog"><p>Subscribe to our letter with your address, it comes each week.</p></div>',
    '<p hidden>This is hidden from the reader, whatever it says.</p><div style="display: none">And so is this.</div>',
]


@pytest.mark.parametrize("place", ["<article>{}</article>", "<main>{}</main>", '<div class="content with-sidebar">{}</div>', "{}"])
@pytest.mark.parametrize("seed", range(6))
def test_the_article_comes_out_of_pages_of_many_shapes(place, seed):
    draw = random.Random(seed)
    parts = draw.sample(AROUND, 8)
    page = f"<!DOCTYPE html><html><head><title>No text</title></head><body class=nav-open>{''.join(parts[:4])}{place.format(BODY)}{''.join(parts[4:])}</body></html>"
    assert main_text(page, Weights()) == TEXT


def test_what_is_no_text_is_left_out_within_an_article():
    for part in AROUND[2:]:
        if "<header" not in part:
            middle = BODY.replace("</h1>", f"</h1>{part}")
            assert main_text(f"<body><article>{middle}</article></body>", Weights()) == TEXT, part
    inner = "<article><header><h1>A title of the page</h1></header>" + BODY.split("</h1>")[1] + "</article>"
    assert main_text(inner, Weights()) == TEXT


def test_blocks_white_space_and_references():
    page = "<article><p> a\n\tb&nbsp; <b>c</b>d &amp;amp; &#8364;&eacute <br>e<ul><li>f<li>g<p>h</ul>i<table><tr><td>j<td>k</table>l<hr>m</article>"
    assert main_text(page, Weights()) == "a b cd &amp; €é e\nf\ng\nh\ni\nj\nk\nl\nm"


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<p>", "</p>", "<!--", "<script>x", "<a href=\"x", "<ul><li></ul>", "&amp", "\x00", "<svg><p>x</svg>"])
def test_pages_without_text_or_end(page):
    assert main_text(page, Weights()) in ("", "<", "&", "\x00")


def test_short_article_beats_long_text_outside():
    page = "<div>" + "words outside of the article " * 5 + "</div><article><p>x</p></article><div>" + "more of them " * 20 + "</div>"
    assert main_text(page, Weights()) == "x"
    wide = "<nav><article>" + BODY + "</article></nav>"  # a menu that was never closed
    assert main_text(wide, Weights()) == TEXT


def test_best_run_equals_trying_all():
    draw = random.Random(1)
    for _ in range(300):
        scores = [draw.choice([-2.5, -1, -0.5, 0, 0.25, 1, 3]) for _ in range(draw.randint(0, 12))]
        runs = [(i, j) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        low, high = best_run(scores)
        assert sum(scores[low:high]) == max([sum(scores[i:j]) for i, j in runs], default=0)


def test_work_is_linear_in_hard_pages():
    hard = ["<div><p>" * 30_000, '<a "x ' * 60_000, "<ul><li>" * 30_000 + "<li>x" * 30_000, "<" * 200_000, "<!-- <p> " * 50_000,
            "<section class=comments><article>x</article></section>" * 20_000, "<script>" * 30_000, "<p><span>" * 30_000 + "</div>" * 30_000]
    for page in hard:
        start = time.perf_counter()
        main_text(page + "<p>" + "word " * 50, Weights())
        assert time.perf_counter() - start < 5, page[:20]


ROWS = "page_id long, url string, html string, text string, n_chars string, hash string, word string, name string, inside string, n string"


def test_weights_are_counted_on_labelled_pages_only(spark):
    labelled = f"<body><center>Odd words outside of it</center><article>{BODY}</article></body>"
    rows = [(i, None, h, *["x"] * 7) for i, h in enumerate([labelled, labelled, f"<body>{BODY}</body>", None, "<article>a</article><article>b</article>"])]
    pages = spark.createDataFrame(rows, ROWS).repartition(3)
    counts = html_extraction.learn_weights(pages).counts
    assert counts[False, "p"] == (8, 0) and counts[True, "h1"] == (5, 0)
    assert counts[False, "center"] == (0, 2) and counts[True, "center -"] == (0, 5)
    weights = Weights(counts)
    assert weights(True, "h1") > 0 > weights(True, "center -") and weights(False, "p") < 0
    assert html_extraction.learn_weights(pages.limit(0)) == Weights()


def test_odd_rows(spark):
    page = f"<article>{BODY}</article>"
    long = "<article>" + "<p>word word</p>" * 400_000 + "</article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, None, None), (3, "u", ""), (4, "u", long)]
    pages = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], ROWS).repartition(2)
    got = html_extraction.extract_main_text(pages, Weights()).collect()
    assert sorted((str(r.page_id), str(r.url), r.n_chars) for r in got) == sorted(
        [("1", "u", len(TEXT))] * 2 + [("None", "None", len(TEXT)), ("2", "None", 0), ("3", "u", 0), ("4", "u", 4_000_000 - 1)]
    )
    assert all(len(r.text) == r.n_chars for r in got)
    assert html_extraction.extract_main_text(pages.limit(0), Weights()).count() == 0


def test_registered_query_against_plain_text(spark, sf_dir):
    """The tables' pages have one article each; strip what surrounds it and its tags by hand."""
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = entry.queries()["op13_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)
