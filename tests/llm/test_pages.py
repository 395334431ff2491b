"""Main texts of pages against what the pages were made of."""

import html
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pairsift.llm import main_text, queries
from tests.llm.helpers import got

WORDS = ["the", "quick", "brown", "naïve", "fox", "&", "<b>", "jumps", "\"over\"", "5", "> 3", "漢字", "dogs."]
NOISE = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>",
    "<header><h2>My site</h2><p>A long slogan that goes on for several words, as slogans do.</p></header>",
    "<div class='ad'>Buy this now, it is a very good thing to have in any house.</div>",
    "<div class=\"cookie-notice\"><p>We use cookies to make this page better for everybody who reads it.</p></div>",
    "<form action='/s'><label>Search</label><input name=q><button>Go</button></form>",
    "<script>var a = '<p>not a text</p>';</script>",
    "<style>p > b {color: red}</style>",
    "<!-- <p>a comment of the markup</p> -->",
]
AFTER = [
    "<aside><h3>More</h3><p>A sidebar with quite a lot of text in it, which is not the article at all.</p></aside>",
    "<section id='comments'><h3>Comments</h3><article class='comment'><p>I have read the whole article and I do"
    " not agree with anything that stands in it, not even with the title.</p></article></section>",
    "<div class='related'><p>Read next: another article that has nothing to do with this one.</p></div>",
    "<footer>&copy; 2020 A company &middot; All rights reserved in all countries of this world.</footer>",
]


def block(rnd, least=1, most=60):
    return " ".join(rnd.choices(WORDS, k=rnd.randint(least, most)))


def page(rnd):
    """A page and its main text."""
    title = block(rnd, 2, 8)
    blocks = [block(rnd) for _ in range(rnd.randint(1, 12))]
    body = [f"<h1>{html.escape(title)}</h1>"]
    for text in blocks:
        words = html.escape(text).split(" ")
        at = rnd.randrange(len(words))
        words[at] = f"<b>{words[at]}</b>" if rnd.random() < 0.5 else f"<a href='/x'>{words[at]}</a>"
        gap = rnd.choice([" ", "\n  ", "<br>", "\t"])
        inner = gap.join(words)
        shape = rnd.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>"])
        body.append(shape.format(inner))
        if rnd.random() < 0.2:
            body.append(rnd.choice(NOISE[2:]))
    shell = rnd.choice(["<article>{}</article>", "<main><article>{}</article></main>", "<div id=page><article>{}</article></div>"])
    before, after = rnd.sample(NOISE, rnd.randint(1, 5)), rnd.sample(AFTER, rnd.randint(1, 3))
    text = "\n\n".join([title, *blocks])
    head = "<!DOCTYPE html><html><head><title>Not me</title></head><body>"
    return head + "".join(before) + shell.format("\n".join(body)) + "".join(after) + "</body></html>", text


def test_made_pages(spark):
    rnd = random.Random(1)
    made = [page(rnd) for _ in range(300)]
    rows = [(i, f"http://x/{i}", body) for i, (body, _) in enumerate(made)]
    result = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got(result) == sorted(((i, u, text, len(text)) for (i, u, _), (_, text) in zip(rows, made)), key=repr)


def test_all_pages_of_the_table(spark):
    """Their article's blocks, cut out by hand."""

    def by_hand(body):
        inner = body[body.find("<article>") + 9 : body.find("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", inner)]
        return "\n\n".join(b for b in blocks if b)

    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    wanted = [(r.page_id, r.url, by_hand(r.html), len(by_hand(r.html))) for r in rows]
    assert got(queries.op11_html_extraction(spark, folder)) == sorted(wanted, key=repr)


def test_pages_without_an_article():
    long = "A paragraph of the text that is long enough to be one, with a comma and more."
    menu = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(9))
    body = f"<body><div><ul>{menu}</ul></div><div class=post><h1>Title</h1><div>" + f"<p>{long}</p>" * 5
    assert main_text.main_text(body + "<p>Yes.</p></div></div><div>Legal</div></body>") == "\n\n".join(
        ["Title", *[long] * 5, "Yes."]
    )
    form = f"<form><div><label>Name</label></div><article><p>{long}</p><p>No.</p></article></form>"
    assert main_text.main_text(form) == f"{long}\n\nNo."


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "plain  text\nonly &amp; &nbsp;so"), (None, None, "<p>a<p>b"),
        (4, "u", "<script>never closed <p>x</p>"), (5, "u", "<p>" + "long " * 50_000), (6, "u", "<div>" * 3000 + "deep"),
        (7, "u", "<![foo[ x ]]><p>after"), (8, "u", "<article><p>cut in the &am"), (9, "u", "<nav>only <a>a menu</a></nav>"),
        (1, "u", None), (10, "u", "<title>t</title><p>x &#0; &#xD800; &copy y"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("text", "n_chars", "kept"):
        pages = pages.selectExpr("*", f"'x' AS {name}")
    result = main_text.extract(pages)
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    found = [(r.page_id, r.text) for r in result.collect()]
    assert all(r.n_chars == len(r.text) for r in result.collect())
    assert found.count((1, "")) == 2
    texts = dict(found)
    assert texts[2] == texts[4] == texts[9] == ""
    assert texts[3] == "plain text only & so"
    assert texts[None] == "a\n\nb"
    assert texts[5] == " ".join(["long"] * 50_000)
    assert texts[6] == "deep"
    assert texts[7].endswith("after")
    assert texts[8] == "cut in the &am"
    assert texts[10] == "x � � © y"
    assert main_text.extract(pages.where("page_id > 99")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<a>", "</a>", "<!--", "-->", "<![", "]]>",
    "<article>", "</article>", "<script>", "</script>", "<", ">", "&", "&#", "x ", "é", "<br/>", "<?", "<form", "</", "\x00"]), max_size=25))
def test_broken_markup_never_fails(parts):
    assert main_text.main_text("".join(parts)) == main_text.main_text("".join(parts)).strip()


def test_pathological_pages_are_read_in_time():
    """Nothing that grows with the square of a page's length."""
    begin = time.monotonic()
    assert main_text.main_text("<p>all</p>" + "<a <" * 50_000) == "all"
    assert main_text.main_text("<p>all</p>" + "<!--" * 20_000) == "all"
    nested = main_text.main_text("<div>some text" * 30_000)
    assert nested.count("some text") >= main_text.MAJORITY * 30_000 - 1
    assert main_text.main_text("<div>x</p></span>" * 20_000).count("x") >= main_text.MAJORITY * 20_000 - 1
    assert time.monotonic() - begin < 60


def test_smoothing_and_clustering():
    ratios = np.array([0, 0, 0, 90, 0, 0, 0, 0], float)
    smooth = main_text.smoothed(ratios)
    weights = [np.exp(-0.5 * d * d) for d in range(-3, 4)]
    assert np.isclose(smooth[3], 90 / sum(weights))
    assert np.isclose(smooth[1], 90 * weights[5] / sum(weights[2:]))
    assert smooth[7] == 0
