import html
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import mainhtml
from strata.llm.common import ship

SF = "/root/testdata/sf0.01"
PLAIN = mainhtml.Weights({"li a": -3000, "<a>": -500, "<li>": -500}, 1000, -1000)


@pytest.fixture(scope="module")
def weights(spark):
    ship(spark)
    return mainhtml.learn(spark.read.parquet(f"{SF}/pages.parquet"))


def by_hand(page):
    """The article of a page of the given tables, cut out by plain patterns."""
    inner = re.search(r"<article>(.*)</article>", re.sub(r"<script>.*?</script>", "", page, flags=re.S), re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    return "\n".join(b for b in (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in x else "", x)).split()) for x in blocks) if b)


def test_every_given_page(spark, weights):
    rows = mainhtml.extract(spark.read.parquet(f"{SF}/pages.parquet"), weights).collect()
    assert len(rows) == 250
    for r in rows:
        assert r.text == by_hand(r.html) and r.n_chars == len(r.text)


def test_given_pages_without_their_mark(spark, weights):
    """The learned weights alone find the same text."""
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    same = sum(mainhtml.main_text(r.html.replace("<article>", "<div>").replace("</article>", "</div>"), weights) == by_hand(r.html) for r in rows)
    assert same >= 0.98 * len(rows)


ARTICLE = "<h1>A title</h1><p>First paragraph with some words &amp; more.</p><p>Second <b>bold</b>text, a <a href=x>link</a> in it.</p><ul><li>one item</li></ul><p>End.</p>"
TEXT = "A title\nFirst paragraph with some words & more.\nSecond boldtext, a link in it.\none item\nEnd."
NOISE = {
    "menu": "<nav><ul><li><a href=/>Home</a><li><a href=/b>About us</a></ul></nav>",
    "header": "<header><p>The name of the site and its motto</p></header>",
    "footer": "<footer><p>All rights reserved by somebody, somewhere, some time.</p></footer>",
    "sidebar": "<div class='left sideBar'><p>Read also these other stories of ours today</p></div>",
    "notice": "<div id=cookie-notice><p>We use cookies to make everything better for you</p></div>",
    "advert": "<div class=\"ad\"><p>Buy this very good product now, it is so very good</p></div>",
    "form": "<form action=x><p>Give us your mail address please</p><input name=q><textarea>type here</textarea></form>",
    "script": "<script>var t='</p><p>not a text at all</p>'; if (a<b) x();</script>",
    "style": "<style>p{content:'<p>not a text</p>'}</style>",
    "comment": "<!-- <p>a commented out paragraph</p> -->",
    "comments": "<section id=comments><article class=comment><p>I do not agree with any of this at all</p></article></section>",
    "hidden": "<div hidden><p>never shown to anyone at all</p></div>",
    "role": "<div role=navigation><p>Some way to go to somewhere else</p></div>",
}


@pytest.mark.parametrize("mark", ["article", "main", "div role=main", "div"])
@pytest.mark.parametrize("noise", NOISE)
def test_noise_around_and_inside(mark, noise):
    n = NOISE[noise]
    inside = ARTICLE.replace("<p>Second", n + "<p>Second")
    page = f"<!DOCTYPE html><html><head><title>x y z</title></head><body>{n}<{mark}>{inside}</{mark.split()[0]}>{n}</body></html>"
    if noise == "header":  # a header inside an article belongs to it
        page = page.replace(inside, ARTICLE)
    assert mainhtml.main_text(page, PLAIN) == TEXT


def test_article_header_is_kept():
    page = "<header>Site name</header><article><header><h1>A title</h1></header><p>Words of it.</p></article>"
    assert mainhtml.main_text(page, PLAIN) == "A title\nWords of it."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("plain words", "plain words"), ("a < b and 2 > 1", "a < b and 2 > 1"),
        ("<p>one<br>two\n\n three&nbsp;four", "one two three four"), ("<article><p><b>Cut off<br></article>", "Cut off"), ("<p>it&#8217;s &lt;b&gt; &am &bogus; &#x41;</p>", "it’s <b> &am &bogus; A"),
        ("<P CLASS=x>Upper</P>", "Upper"), ("<p>cut <a href=\"x", "cut"), ("<p>text<!-- never closed <p>gone", "text"), ("<p>text</p><script>never closed <p>gone", "text"),
        ("<p title='a>b'>quoted</p>", "quoted"), ("</div></p>stray</b>", "stray"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>x<p>y<div>z</div>w", "x\ny\nz\nw"),
    ],
)
def test_odd_pages(page, text):
    assert mainhtml.main_text(page, PLAIN) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_scan_against_all_stretches(scores):
    every = [(sum(scores[i:j]), -i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    best = max(every, default=(0, 0, 0))
    assert mainhtml.best_stretch(scores) == ((-best[1], best[2]) if best[0] > 0 else (0, 0))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='a", "'>", "<a href=x>", "</a>", "<!--", "-->", "<script>", "</script>", "word ", "&amp;", "<", ">", '"', "\n", "<article>", "</article>", "<li>", "<td/>", "é"]), max_size=30))
def test_any_markup_is_read(parts):
    text = mainhtml.main_text("".join(parts), PLAIN)
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n") if line.strip())


def test_long_page_is_whole():
    r = random.Random(1)
    paragraphs = [" ".join(f"w{r.randint(0, 99)}" for _ in range(r.randint(1, 40))) for _ in range(20_000)]
    page = "<nav><a>x</a></nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert mainhtml.main_text(page, PLAIN) == "\n".join(paragraphs)


def test_empty_table_repeats_and_odd_columns(spark):
    ship(spark)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    none = mainhtml.learn(empty)
    assert none.known == {} and mainhtml.extract(empty, none).collect() == []
    page = f"<body>{NOISE['menu']}{ARTICLE}</body>"
    df = spark.createDataFrame([(1, "u", page, 5, "t"), (1, "u", page, 5, "t"), (None, None, None, None, None)], "page_id long, url string, html string, n_chars int, `a.b` string")
    out = mainhtml.extract(df, none)
    assert out.columns == ["page_id", "url", "html", "a.b", "text", "n_chars"]
    assert [r.text for r in out.collect()] == [TEXT, TEXT, ""]
