"""Main text against the known template of the pages and small pages written by hand."""

from __future__ import annotations

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import bag
from meterline.llm import html_extraction as he
from meterline.llm.queries import labelled_pages, op3_html_extraction

PLAIN = he.Weights()


def article(page: str) -> str:
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<(b)>", "", re.sub("</?(?:p|br|h1)>", " ", inner))).split())


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words only", "plain words only"),
        ("<p>a<p>b<td>c", "a b c"),
        ("<nav><ul><li>menu<article><p>Real text</article>", "Real text"),
        ("<script>if (a < b) {}</script>said", "said"),
        ("<p>x</p><script>never closed", "x"),
        ("<!-- a > b -->t<![CDATA[ q & r ]]>", "t q & r"),
        ("a < b and c > d", "a < b and c > d"),
        ('<p title="a>b">z</p>', "z"),
        ('<p "broken>x y</p><p>z</p>', "x y z"),
        ("fo<b>u</b>r&nbsp;five<br>six &lt;tag&gt; &#233;", "four five six <tag> é"),
        ("<article><header><h1>Head</h1></header><p>body</p></article>", "Head body"),
        ("<ul><li>One thing</li><li>Two things</li></ul>", "One thing Two things"),
        ("<footer>only a footer</footer>", ""),
        (
            "<html><head><title>x y</title></head><body><header><a href=/>Home</a> name</header>"
            '<nav>a b c</nav><div id="content"><h1>Title here</h1><p>One two</p><aside>skip me'
            '</aside><p>Three</p><div class="user-comments"><p>Great post</p></div></div>'
            '<div class="sidebar">links</div><form><label>Mail</label><input></form>'
            '<div class="cookieNotice">We use</div><footer>end</footer>',
            "Title here One two Three",
        ),
    ],
)
def test_small_pages(page, text):
    assert he.main_text(page, PLAIN) == text


@pytest.mark.parametrize("box", ["nav", "aside", 'div class="related"'])
def test_a_box_of_links_beside_a_short_text_costs_nothing(box):
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(40))
    box = f"<{box}><ul>{links}</ul></{box.partition(' ')[0]}>"
    body = "one two three four five six seven " * 10
    for parts in (("<h1>Title</h1><p>A short lead</p>", f"<p>{body}</p>"), (f"<p>{body}</p>", "<p>The end of it</p>")):
        page = f"<body><article>{parts[0]}{box}{parts[1]}</article></body>"
        assert he.main_text(page, PLAIN) == " ".join(re.sub("<.*?>", " ", " ".join(parts)).split())


BODY = "one two three four five six seven " * 10
TEXT = BODY.strip()


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-comments", "search-result", "share-enabled", "post withComments"])
@pytest.mark.parametrize("rest", ["", '<div class="sidebar">links</div>', "<footer>end</footer>"])
def test_a_wrapper_of_most_words_is_kept(name, rest):
    page = f'<body><nav>a b c</nav><div class="{name}"><p>{BODY}</p>{rest}</div></body>'
    assert he.main_text(page, PLAIN) == TEXT
    assert he.main_text(page.replace("<p>", '<div class="page"><p>'), PLAIN) == TEXT


def test_words_after_has_or_no_are_ignored_in_small_elements_too():
    page = f'<body><p>{BODY}</p><div class="no-share has-sidebar"><p>Kept words</p></div><div class="share">Lost</div></body>'
    assert he.main_text(page, PLAIN) == TEXT + " Kept words"


@pytest.mark.parametrize(
    "box",
    [
        '<section class="comments"><article class="comment"><p>Great post</p></article></section>',
        '<section class="comments"><article><p>Great post</p></article></section>',
        '<article class="comment"><p>Great post</p></article>',
        f'<section class="comments">{"<article class=comment><p>Great post I say</p></article>" * 60}</section>',
        f'<section class="comments"><p>{BODY * 3}</p></section>',
        "<aside><article><p>Teaser</p></article></aside>",
    ],
)
def test_articles_of_comments_are_left_out(box):
    assert he.main_text(f"<body><article><p>{BODY}</p></article>{box}</body>", PLAIN) == TEXT
    assert he.main_text(f"<body><main><article><p>{BODY}</p></article>{box}</main></body>", PLAIN) == TEXT
    if "<article" in box:
        assert he.main_text(f'<body><article class="post"><p>{BODY}</p>{box}</article></body>', PLAIN) == TEXT


def test_the_main_article_counts_wherever_it_lies():
    for around in ('<div class="layout sidebar-left">%s</div>', "<nav>menu %s</nav>", "<nav><ul><li>menu%s", '<div class="widget">%s'):
        page = f"<body>{around % f'<article><p>{BODY}</p></article>'}<div class='comments'>{BODY * 2}</div></body>"
        assert he.main_text(page, PLAIN) == TEXT
    articles = "".join(f"<article><p>{BODY}{i}</p></article>" for i in range(3))
    page = f'<body><div class="layout sidebar-left">{articles}</div></body>'
    assert he.main_text(page, PLAIN) == " ".join(f"{BODY}{i}" for i in range(3))


def test_pages_of_the_table(pages, spark):
    got = {r.page_id: r for r in op3_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages)
    for page in pages:
        row = got[page["page_id"]]
        assert row.text == article(page["html"])
        assert row.n_chars == len(row.text) and row.url == page["url"]


def test_weights_come_from_labelled_pages(spark):
    labelled = labelled_pages(spark, "/root/testdata/sf0.01")
    assert 100 < len(labelled) <= 300
    weights = he.learn(labelled)
    assert "div.ad" in weights.aside and "nav" in weights.aside
    assert not {"p", "article", "body"} & weights.aside


def nameless(page: str) -> str:
    return re.sub(r"<(/?)(nav|footer|header|aside)\b", r"<\1div", page)


@pytest.mark.parametrize(("change", "least"), [(str, 0.99), (nameless, 0.95)])
def test_labels_alone_decide_on_unseen_pages(spark, pages, change, least):
    """Without the usual names. Of nameless menus and footers only the scan can tell."""
    labelled = labelled_pages(spark, "/root/testdata/sf0.01")
    labelled = labelled[: len(labelled) // 2]
    weights = he.learn([(change(page), text) for page, text in labelled], usual=False)
    assert not weights.usual and weights.tags and max(weights.tags.values()) < 0
    untaught = he.Weights(aside=weights.aside if change is nameless else frozenset(), usual=False)
    seen = {page for page, _ in labelled}
    unseen = [page["html"] for page in pages if page["html"] not in seen]
    right = scanned = plain = 0
    for page in unseen:
        text = he.main_text(change(page), weights)
        right += text == article(page)
        scanned += text != he.region_text(he.Page(weights).tokens(change(page)))
        plain += he.main_text(change(page), untaught) == article(page)
    assert len(unseen) >= 100 and right >= least * len(unseen) and plain < 0.5 * len(unseen)
    if change is nameless:
        assert scanned >= 0.95 * len(unseen)


def test_labels_clear_a_usual_name():
    box = f'<div class="search"><p>{BODY}</p></div>'
    page = f"<body><article><p>Some words</p></article>{box}</body>"
    assert TEXT not in he.main_text(page, PLAIN)
    weights = he.learn([(f"<body><nav>a b c</nav>{box}</body>", TEXT)] * 3)
    assert "div.search" in weights.main and TEXT in he.main_text(page, weights)


@pytest.mark.parametrize(
    "unit",
    ["<b>x ", "<div>x ", '<div class="ad">x ', '<article class="ad">x ', '<div class="ad"><article>x ', "</i><div>x ", "<td><p>x "],
)
def test_time_is_linear_in_elements_never_closed(unit):
    def spent(n):
        started = time.process_time()
        he.main_text(unit * n, PLAIN)
        return time.process_time() - started

    spent(1000)
    assert spent(32_000) < 3 * 8 * spent(4_000) + 0.5


def test_a_strange_class_is_learned():
    word = "one two three four five six seven eight nine ten "
    page = f'<body><div class="qqbox">{word * 3}</div><p>{word}main words</p></body>'
    labelled = [(page, word + "main words")] * 3
    assert "qqbox" in he.main_text(page.replace(word * 3, "qqbox "), PLAIN)
    weights = he.learn(labelled)
    assert he.main_text(page, weights) == (word + "main words")


def test_tags_learn_negative_scores():
    word = "one two three four five six seven "
    page = f"<body><section>{word * 2}</section><hr><p>{word}</p></body>"
    weights = he.learn([(page, word * 2)] * 3 + [(page.replace("one", "uno"), ("uno two three four five six seven " * 2))] * 3)
    assert min(weights.tags.values(), default=0) <= 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-5, 5, allow_nan=False), max_size=12))
def test_best_region_against_all_regions(scores):
    low, high = he.best_region(scores)
    best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)), default=0)
    assert sum(scores[low:high]) == pytest.approx(max(0, best), abs=1e-6)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<nav>", "</nav>", "x ", "y", "<", ">", "&", '"', "<!--", "-->", "<script>", "</script>", "<a href='", "<b"]), max_size=25))
def test_any_markup(parts):
    text = he.main_text("".join(parts), PLAIN)
    assert text == " ".join(text.split())


def test_long_pages_are_whole():
    page = "<article>" + "<p>word <b>and</b> word</p>" * 40_000 + "</article>"
    assert he.main_text(page, PLAIN) == " ".join(["word and word"] * 40_000)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "u", None, "old"), (2, None, "", "old"), (2, None, "<p>é", "old"), (2, None, "<p>é", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = he.extract(pages, PLAIN)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert bag(found.drop("html")) == [(1, "u", "", 0), (2, None, "", 0), (2, None, "é", 1), (2, None, "é", 1)]
    assert he.extract(pages.limit(0), PLAIN).count() == 0
    assert he.learn([]) == PLAIN
