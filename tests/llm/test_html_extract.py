"""Main text of pages: known pages, other templates, decoding, and trees."""

from __future__ import annotations

import html as html_lib
import itertools
import re

import numpy as np
import pytest

from hopgrid.llm import html_extract as hx

PAGES = "/root/testdata/sf0.01/pages.parquet"


def article(source):
    body = re.search(r"<article>(.*)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>|<br>", body)
    return " ".join(t for b in blocks if (t := " ".join(html_lib.unescape(re.sub(r"<[^>]*>", "", b)).split())))


@pytest.fixture(scope="module")
def model(spark):
    return hx.learn(spark.read.parquet(PAGES))


def test_given_pages(spark):
    pages = spark.read.parquet(PAGES)
    got = {r.page_id: r for r in hx.main_texts(pages).collect()}
    want = {r.page_id: article(r.html) for r in pages.collect()}
    right = sum(got[i].text == t and got[i].n_chars == len(t) for i, t in want.items())
    assert right >= 0.98 * len(want)


def test_other_templates(model):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rng = np.random.default_rng(6)
    say = lambda n: " ".join(rng.choice(words, n)) + "."
    good = total = 0
    for k in range(40):
        paragraphs = [say(int(rng.integers(20, 90))) for _ in range(rng.integers(2, 6))]
        main = "".join(f"<p>{p}</p>" for p in paragraphs)
        opening, closing = [("<article>", "</article>"), ("<div class='post-content'>", "</div>"), ("<main>", "</main>"), ("<div id=content>", "</div>")][k % 4]
        page = (f"<html><body><header><a href='/'>{say(3)}</a></header><nav><a href=a>{say(2)}</a> <a href=b>{say(1)}</a></nav>"
                f"<div class='cookie-notice'>{say(12)}</div>{opening}{main}{closing}<aside class=sidebar><p>{say(15)}</p></aside>"
                f"<div class='comments'><p>{say(30)}</p><p>{say(25)}</p></div><form><label>{say(3)}</label><input></form><footer>{say(9)}</footer>")
        good += hx.extract_texts([page], model)[0] == " ".join(paragraphs)
        total += 1
    assert good >= 0.85 * total


def test_odd_pages(spark):
    odd = [(1, "u", None), (2, None, ""), (None, "u", "no tags &amp; so"), (4, "u", "<p"), (5, "u", "<div>" * 3000 + "x"), (6, "u", "<script>x"),
           (7, "u", "<article><p>One&nbsp;&eacute; <b>two</b>three<br>four<p>Five " + "word " * 4000 + "</article>"), (7, "u", "</p></div>")]
    got = hx.main_texts(spark.createDataFrame([(*r, "x") for r in odd], "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(odd) and all(r.n_chars == len(r.text) for r in got)
    long = next(r.text for r in got if r.n_chars > 1000)
    assert long.startswith("One é twothree four Five word word")
    assert hx.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_decoding_is_the_best_consistent_choice():
    page = hx.Page("<div><p>a</p><p>b</p></div><div><ul><li>c</li></ul></div>")
    n = len(page.tag)
    rng = np.random.default_rng(0)
    for _ in range(50):
        p = np.r_[1 - 1e-4, rng.uniform(0.01, 0.99, n - 1)]
        score = lambda y: sum(np.log(q if v else 1 - q) for q, v in zip(p, y))
        legal = [y for y in itertools.product([False, True], repeat=n) if y[0] and all(not y[i] or y[page.parent[i]] for i in range(1, n))]
        assert score(page.decode(p)) == pytest.approx(max(map(score, legal)))


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    x = np.concatenate([x, np.zeros((3000, 200))], 1)  # the columns of the plain rule
    assert ((hx.Trees(x, y, 1000).predict(x) > 0.5) == y).mean() > 0.97


def test_text_without_an_element(model):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(rng.choice(words, n)) + "."
    one, two = say(60), say(80)
    nav = "<nav><a href=a>Home page</a> <a href=b>News</a></nav>"
    pages = {f"<html><body>{one}<br><br>{two}</body></html>": f"{one} {two}", "no tags &amp; so": "no tags & so", f"{one}\n{two}": f"{one} {two}",
             f"<html><body>{nav}{one}<br>{two}<footer>{say(5)}</footer></body></html>": f"{one} {two}",
             f"<html><body>{nav}<div class=sidebar><p>{say(4)}</p></div></div></p>{one} <b>{two}</b></body></html>": f"{one} {two}"}
    assert hx.extract_texts(list(pages), model) == list(pages.values())
    assert hx.extract_texts(list(pages)[:3], None) == list(pages.values())[:3]
    links = "".join(f"<a href=x>{say(2)}</a> | " for _ in range(6))
    assert "|" not in hx.extract_texts([f"<html><body>{links}<article><p>{one}</p><p>{two}</p></article></body></html>"], model)[0]


def test_closing_tags_after_letters_that_grow():
    page = hx.Page("<p>" + "İ" * 40 + "</p><script>x</SCRIPT><p>kept</p><p>last</p>")
    assert [t for _, t in page.blocks] == ["İ" * 40, "kept", "last"]


MENU = "<nav><a href=a>Home</a></nav>"
AROUND = (f"<html><body><header><h2>Site name</h2></header>{MENU}", "<form><label>Mail</label><input></form><footer>foot</footer></body></html>")
BODY = "<p>First words of it, and more.</p><p>Second part of the text.</p>"
TEXT = "First words of it, and more. Second part of the text."


def with_article(k):
    return f"{AROUND[0]}<article><p>Words of page {k}, some.</p><p>More of {k}.</p></article>{AROUND[1]}"


@pytest.mark.parametrize("marked, others, copies", [(0, 20, 1), (1, 0, 1), (2, 0, 1), (5, 0, 1), (1, 20, 1), (1, 0, 5)])
def test_small_tables(spark, marked, others, copies):
    """Whatever there is to learn from: the text, and no menu, header, form or footer."""
    plain = f"{AROUND[0]}<div>{BODY}</div>{AROUND[1]}"
    rows = [(k, "u", with_article(k)) for k in range(marked) for _ in range(copies)] + [(1000 + k, "u", plain) for k in range(others)]
    got = hx.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == (TEXT if r.page_id >= 1000 else f"Words of page {r.page_id}, some. More of {r.page_id}."), r


@pytest.mark.parametrize("count", [1, 3, 10])
def test_few_training_pages(spark, count):
    pages = [r.html for r in spark.read.parquet(PAGES).orderBy("page_id").collect()]
    rng = np.random.default_rng(count)
    for _ in range(5 if count == 1 else 1):
        some = [pages[i] for i in rng.choice(np.arange(60, len(pages)), count, replace=False)]
        model = hx.learn_from([(k, page) for k, page in enumerate(some)])
        got = hx.extract_texts(pages[:60], model)
        assert sum(not t for t in got) <= 2
        assert sum(t == article(p) for t, p in zip(got, pages)) >= 55


FOREIGN = [
    ("<html><body><div id=top><ul class=menu><li><a href=/>Start</a></li><li><a href=/n>News</a></li></ul></div><div class=layout><div class='post-body'>"
     "<h1>On rivers</h1><p>Rivers run to the sea, as is known.</p><blockquote>So it was said.</blockquote><ul><li>One, two.</li><li>Three.</li></ul></div>"
     "<div class='sidebar'><h3>Recent</h3><p>Something else.</p></div></div><div class=footer>All rights.</div></body></html>",
     "On rivers Rivers run to the sea, as is known. So it was said. One, two. Three."),
    ("<!doctype html><body><header><a href=/>Brand</a></header><main><section><h2>Part A</h2><p>Text of A, rather long &amp; plain.</p></section>"
     "<section><h2>Part B</h2><p>Text of B.</p></section><section class=comments><p>Nice one!</p></section></main><aside><p>Buy now.</p></aside></body>",
     "Part A Text of A, rather long & plain. Part B Text of B."),
    ("<table><tr><td class=navigation><a href=1>One</a><br><a href=2>Two</a></td><td><p>A page laid out in a table, as of old.</p><p>It has two paragraphs.</p></td></tr>"
     "<tr><td colspan=2 class=copyright>1999</td></tr></table>", "A page laid out in a table, as of old. It has two paragraphs."),
    ("<body><div class='cookie-banner'><p>We store things.</p><button>OK</button></div><div class=story><p>Short <em>story</em> here.</p>"
     "<div class=advert><p>Ad text.</p></div><p>It ends.</p></div><form action=x><p>Subscribe to it</p></form></body>", "Short story here. It ends."),
]


@pytest.mark.parametrize("source, text", FOREIGN)
def test_foreign_templates(model, source, text):
    assert hx.extract_texts([source], model) == [text]
    assert hx.extract_texts([source], None) == [text]


def test_deep_pages_take_linear_time(model):
    import time
    taken = []
    for n in (25_000, 100_000):
        start = time.process_time()
        assert hx.extract_texts(["<div>" * n + "x"], model) == ["x"]
        taken.append(time.process_time() - start)
    assert taken[1] < 8 * taken[0] + 1
