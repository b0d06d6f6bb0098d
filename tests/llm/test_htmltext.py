"""HTML extraction: the parser, the chain against all labellings, and held-out pages of other kinds."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from plumbline.llm.htmltext import FEATURES, Field, _gradient, blocks, extract, fit, main_text, train

WORDS = "river stone under the quiet morning light moves along old walls and every small house keeps its door open".split()


def sentence(n):
    return " ".join(random.choice(WORDS) for _ in range(n)).capitalize() + "."


def page(article="article"):
    body = [f"<h1>{sentence(6)}</h1>", *(f"<p>{sentence(random.randint(8, 60))}" + random.choice(["</p>", ""]) for _ in range(random.randint(1, 6)))]
    inside = "\n".join(body)
    text = "\n".join(b.split(">", 1)[1].split("<")[0] for b in body)
    head = f"<html><head><title>{sentence(4)}</title><script>var t='</p>';</script></head><body>"
    nav = "<nav><ul>" + "".join(f"<li><a href='/{k}'>{random.choice(WORDS)}</a></li>" for k in range(6)) + "</ul></nav>"
    advert = f"<div class='ad'>{sentence(4)}</div>"
    foot = f"<footer>&copy; site &middot; {sentence(9)}</footer></body></html>"
    return f"{head}{nav}{advert}<{article}>{inside}</{article.split()[0]}>{foot}", text


@pytest.fixture(scope="module")
def field():
    random.seed(8)
    return fit([blocks(page()[0]) for _ in range(150)])


def test_blocks_decode_references_and_white_space():
    got = [t for t, _ in blocks("<p>a &amp; b&nbsp;\n <b>c</b>d<br>e<p>f<!-- x --> g<style>p{}</style><li>h<li>i &#233;&notaref; <td")]
    assert got == ["a & b cd e", "f g", "h", "i é¬aref;"]
    assert blocks(None) == blocks("") == blocks("<p></p>  ") == []


def test_hostile_markup_ends_soon():
    for text in ("<div>" * 20_000 + "x", "<" * 50_000, "<a b='" * 5000, "<!--" * 5000, "<p>" * 20_000, "</p>" * 20_000, "<script>" + "<" * 50_000):
        blocks(text)


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(9)
    for n in range(1, 8):
        f = Field(rng.normal(size=(len(FEATURES), 2)), rng.normal(size=(2, 2)))
        x = (rng.random((n, len(FEATURES))) < 0.2).astype(np.float32)
        s = x @ f.emission
        best = max(itertools.product([0, 1], repeat=n), key=lambda y: sum(s[k, y[k]] for k in range(n)) + sum(f.transition[a, b] for a, b in itertools.pairwise(y)))
        assert f.decode(x) == [bool(v) for v in best]
    assert f.decode(np.zeros((0, len(FEATURES)), np.float32)) == []


def test_gradient_against_all_labellings():
    rng = np.random.default_rng(10)
    n = 4
    x = (rng.random((1, n + 1, len(FEATURES))) < 0.2).astype(np.float32)
    emission, transition = rng.normal(size=(len(FEATURES), 2)), rng.normal(size=(2, 2))
    y, mask = np.array([[0, 1, 1, 0, 0]]), np.array([[True] * n + [False]])

    def likelihood(e, t):
        s = x[0, :n] @ e
        value = lambda l: sum(s[k, l[k]] for k in range(n)) + sum(t[a, b] for a, b in itertools.pairwise(l))  # noqa: E731, E741
        return value(y[0, :n]) - np.logaddexp.reduce([value(l) for l in itertools.product([0, 1], repeat=n)])  # noqa: E741

    d_emission, d_transition = _gradient(x, y, mask, emission, transition)
    for a, b in itertools.product([0, 1], repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert abs((likelihood(emission, transition + step) - likelihood(emission, transition - step)) / 2e-5 - d_transition[a, b]) < 1e-4
    step = np.zeros_like(emission)
    step[0, 1] = 1e-5
    assert abs((likelihood(emission + step, transition) - likelihood(emission - step, transition)) / 2e-5 - d_emission[0, 1]) < 1e-4


def test_held_out_pages(field):
    random.seed(11)
    for _ in range(60):
        html, text = page()
        assert main_text(html, field) == text


def test_pages_without_marks_and_with_other_boilerplate(field):
    random.seed(12)
    right = 0
    for _ in range(60):
        html, text = page("div")
        more = f"<aside><p>{sentence(20)}</p></aside><section class='comments'><p>{sentence(25)}</p></section><div id='cookie-notice'><p>{sentence(15)}</p></div><form><label>{sentence(3)}</label></form>"
        right += main_text(html.replace("<footer>", more + "<footer>"), field) == text
    assert right >= 45
    inside = f"<article><h1>{sentence(5)}</h1><p>{sentence(30)}</p><section class='comments'><p>{sentence(25)}</p></section></article>"
    assert main_text(inside, field).count("\n") == 1


def test_table(frame):
    random.seed(13)
    rows = [(k, f"u{k}", page()[0], "x") for k in range(40)] + [(None, None, None, "x"), (3, "again", "", "x")]
    pages = frame(rows, "page_id long, url string, html string, text string")
    got = extract(pages, train(pages, sample=20))
    assert got.columns == ["page_id", "url", "text"]
    texts = [(r.page_id, r.url, r.text) for r in got.collect()]
    assert len(texts) == 42 and (None, None, "") in texts and (3, "again", "") in texts
    empty = frame([], "page_id long, url string, html string")
    assert extract(empty, train(empty)).collect() == []


def test_a_slash_closes_no_html_element():
    page = "<article><p>Kept.</p><script src=x/>var a=1;</script><div/><p>Also kept.</p><svg><path d='m'/>art</svg></article>"
    assert [t for t, _ in blocks(page)] == ["Kept.", "Also kept."]


def test_deeply_nested_items_close_each_other():
    """Also below any number of open inline elements, and in time that grows with the page."""
    deep = "<ul><li>one" + "<b>" * 60 + "two<li>three</ul><p>four" + "<i>" * 20_000 + "x" + "<p>y" * 20_000
    texts = [t for t, _ in blocks(deep)]
    assert texts[:3] == ["onetwo", "three", "fourx"] and len(texts) == 20_003
    inside = [f for t, f in blocks("<ul><li>one" + "<b>" * 60 + "<li>two</ul>after")]
    assert "in_list" in inside[1] and "in_list" not in inside[2]


def test_training_reads_whole_pages():
    """What only the end of long pages shows is learnt."""
    body = "<article>" + "".join(f"<p>{'A sentence of the article with many words in it, which goes on. ' * 3}</p>" for _ in range(90)) + "</article>"
    page = body + "".join("<p>© Some firm</p>" for _ in range(6))
    end = "<article><p>" + "Words of an article that is long enough to count as one. " * 4 + "</p></article>"
    pages = [blocks(page), blocks(end + "<p>x</p>")]
    assert len(pages[0]) == 96
    field = fit(pages)
    text = "<div>" + "".join(f"<p>{'A sentence of the article with many words in it, which goes on. ' * 3}</p>" for _ in range(5)) + "<p>© Some firm</p></div>"
    assert "©" not in main_text(text, field) and main_text(text, field).count("\n") == 4
