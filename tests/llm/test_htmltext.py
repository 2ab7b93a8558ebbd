"""Main text of pages: reading, costs, cuts against a search of all labellings, and whole pages."""

from __future__ import annotations

import itertools
import random
import re
import time
from html import escape, unescape

import pytest
from pyspark.sql import functions as F

from netsift.llm import htmltext
from netsift.llm.queries import op13_main_text

PROSE = [
    "The council met on Tuesday, and after four hours of debate it agreed to fund the bridge over the river.",
    "Work is to begin in spring; the old crossing, closed since last year, will be taken down first.",
    "Critics say that the sum is too small, while the mayor calls it a start & a promise to the valley.",
]


def test_reading():
    page = htmltext.read(
        "<!doctype html><title>No <b>text</b></title><h1>One &amp; two</h1 x><p>a <b>b</B>c<br>d\n\t e"
        "<p class=x>f<!-- > <p>no --> g<ul><li>h<li><a href='>'>i j</a></ul>k < l &lt;m&#x41;&am<div>n</div"
    )
    assert page.text == ["One & two", "a bc d e", "f g", "h", "i j", "k < l <mA&am", "n"]
    assert [page.tag[n] for n in page.node] == ["h1", "p", "p", "li", "li", "", "div"]
    assert page.linked == [0, 0, 0, 0, 2, 0, 0]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", []), ("plain", ["plain"]), ("<p>a<script>var t='</p>';</script>b", ["ab"]), ("<p>a<script>b", ["a"]),
        ("<p>a <button>no</button> b</p>", ["a b"]), ("<p>a <button>b", ["a b"]), ("a<!-- b", ["a"]), ("a<p", ["a"]),
        ("a <a href=\"b", ["a"]), ("</p></div>a", ["a"]), ("<div hidden>a</div>b", ["b"]), ("<STYLE>a</sTyle>b", ["b"]),
        ("<div style='display : none'>a<div>b</div></div>c", ["c"]), ("1 < 2 <3", ["1 < 2 <3"]), ("&nbsp;&#10; a&nbsp;b", ["a b"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
        ("<p>a<textarea><p>b</textarea>", ["a"]), ("<svg><text>a</text></svg>b", ["b"]), ("<select><option>a</select>b", ["b"]),
    ],
)
def test_odd_markup(html, text):
    assert htmltext.read(html).text == text


def test_cuts_equal_a_search_of_all_labellings():
    rng = random.Random(13)
    for _ in range(400):
        n = rng.randrange(1, 9)
        gain = [rng.randrange(-6, 7) for _ in range(n)]
        joined = [(i, j, rng.randrange(0, 5)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(label):
            return sum(-g for g, x in zip(gain, label) if x) + sum(w for i, j, w in joined if label[i] != label[j])

        best = min(itertools.product((False, True), repeat=n), key=lambda x: (cost(x), sum(x)))
        assert htmltext.labels(gain, joined) == list(best) == htmltext._cut(gain, joined)


def page(*body):
    return "<html><head><title>t</title></head><body>" + "".join(body) + "</body></html>"


ARTICLE = "<h1>A bridge</h1>" + "".join(f"<p>{escape(p)}</p>" for p in PROSE)
WANTED = "\n".join(["A bridge", *PROSE])
MENU = "<ul>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "Sport", "Contact us")) + "</ul>"
COMMENT = "<p>" + " ".join(PROSE) + " I do not agree.</p>"


@pytest.mark.parametrize(
    "html",
    [
        page(f"<nav>{MENU}</nav><article>{ARTICLE}</article><footer>&copy; Valley News</footer>"),
        page(f"<header><h2>Valley News</h2>{MENU}</header><main>{ARTICLE}</main><aside><h3>More</h3><p>{PROSE[0]}</p></aside>"),
        page(f"<article><header>{ARTICLE[:17]}</header>{ARTICLE[17:]}<footer>Filed under roads</footer></article>"),
        page(f"<div class=cookie-notice><p>We set cookies, and by reading on you agree.</p></div><div id=content>{ARTICLE}</div>"),
        page(f"<main>{ARTICLE}<section id=comments><h2>2 comments</h2><article class=comment>{COMMENT * 3}</article></section></main>"),
        page(f"<article>{ARTICLE}<div class='ad-box'>Buy a boat today, it is cheap and it is good.</div></article>"),
        page(f"<div class='has-sidebar'><article>{ARTICLE}</article><div class=sidebar>{COMMENT}</div></div>"),
        page(f"<form id=aspnetForm><div class=menu>{MENU}</div><div class='entry-content'>{ARTICLE}</div></form>"),
        page(f"<article>{ARTICLE}<form><label>Mail</label><input><button>Join</button><p>Join our list, it is free.</p></form></article>"),
        page(f"<div role=navigation>{MENU}</div><div role=main>{ARTICLE}</div><div role=contentinfo>Imprint</div>"),
        page(f"<article>{ARTICLE}</article><div class=related><article><p>{PROSE[1]}</p></article></div>"),
        page(f"<div>{MENU}</div><div>{ARTICLE}</div><div><a href=/imprint>Imprint</a> <a href=/terms>Terms</a></div>"),
        f"<article>{ARTICLE}",
        page(f"<article>{ARTICLE.replace('<p>', '<p>  ').replace(' the ', chr(10) + chr(9) + '<b>the</b> ')}</article>"),
    ],
)
def test_pages(html):
    assert htmltext.main_text(html) == WANTED


def article_of(html):
    """What the given tables' pages hold between the article tags, read with patterns only."""
    inside = html.split("<article>", 1)[1].split("</article>")[0]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*(>|$)", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    done = {r["page_id"]: r for r in op13_main_text(spark, folder).collect()}
    assert len(done) == len(pages)
    for r in pages:
        got = done[r["page_id"]]
        assert (got["url"], got["text"], got["n_chars"]) == (r["url"], article_of(r["html"]), len(article_of(r["html"])))


def test_pages_without_marks(spark, folder):
    """Trained on marked pages, the classifier also finds the text where no element tells its purpose."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    train, held = pages.filter("page_id % 2 = 0"), pages.filter("page_id % 2 = 1").collect()
    model = htmltext.fit(train)
    right = 0
    for r in held:
        bare = re.sub(r"(</?)(article|nav|footer)>", r"\1div>", r["html"]).replace(' class="ad"', "")
        right += htmltext.main_text(bare, model) == article_of(r["html"])
    assert right >= 0.9 * len(held)


def test_model_is_bounded_and_repeatable(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    model = htmltext.fit(pages)
    assert model == htmltext.fit(pages.repartition(7)) and [len(w) for w in model.weights] == list(htmltext.LEVELS.values())
    assert htmltext.fit(pages.limit(0)) == htmltext.Model() == htmltext.fit(pages.select(F.lit(None).cast("string").alias("html")))


def test_odd_rows_and_columns(spark):
    rows = [(1, None, "x", 3), (1, "", "x", 3), (None, "<p>", "x", 3), (2, page(f"<article>{ARTICLE}</article>"), "x", 3)]
    pages = spark.createDataFrame(rows + rows[-1:], "page_id bigint, html string, text string, `a b` int")
    model = htmltext.fit(pages)
    done = htmltext.extract(pages, model)
    assert done.columns == ["page_id", "a b", "text", "n_chars"]
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"], r["a b"]) for r in done.collect())
    whole = ("2", WANTED, len(WANTED), 3)
    assert got == [("1", "", 0, 3), ("1", "", 0, 3), whole, whole, ("None", "", 0, 3)]
    assert htmltext.extract(pages.limit(0), model).count() == 0
    assert htmltext.extract(pages, model, keep=["page_id"]).columns == ["page_id", "text", "n_chars"]


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + "a", "<p>" + "word, " * 200_000, "<li>a" * 50_000, "<a href=x>" * 50_000 + "a", "<" * 100_000,
        "<button>" * 20_000, "&amp" * 50_000, "<div class='a" * 5_000, "<p>Some words, as ever.<div>x" * 20_000, "<!--" * 50_000,
    ],
)
def test_long_pages(html):
    start = time.monotonic()
    htmltext.main_text(html)
    assert time.monotonic() - start < 20


def test_long_page_is_whole():
    many = "".join(f"<p>{n} {p}</p>" for n in range(5_000) for p in PROSE[:2])
    got = htmltext.main_text(page(f"<nav>{MENU}</nav><article>{many}</article>"))
    assert got.count("\n") == 9_999 and got.endswith(f"4999 {PROSE[1]}")
