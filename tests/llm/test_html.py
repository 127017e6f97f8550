import itertools
import math
import re

import numpy as np
import pytest

from mailshape.llm import htmltree
from mailshape.llm.dom import read
from mailshape.llm.htmltree import TreeModel
from mailshape.llm.queries import op5_html

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, text string"


def blocks(source):
    return [b.text for b in read(source) if not b.tag]


@pytest.mark.parametrize("source, wanted", [
    ("", []), ("plain &amp; text", ["plain & text"]), ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
    ("<p>x <b>y</b>z\n\t w</p>", ["x yz w"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]),
    ("<script>var t='</p>';</script><style>p{}</style><p>t</p><!-- <p>no</p> -->", ["t"]),
    ("<head><title>t</title><meta x></head><body>b", ["b"]), ("a < b <3 </> <!x> c", ["a < b <3 c"]),
    ("<p title='>'>in</p></p></div>out", ["in", "out"]), ("<a href=\"x>y</p><p>z", ["y", "z"]),
    ("<ul><li>1<li>2</ul>", ["1", "2"]), ("&nbsp;&#65;&eacute;&unknown; ", ["Aé&unknown;"]),
    ("<textarea>no</textarea><select><option>no</select>yes", ["yes"]), ("<!-- open", []),
    ("<script>open", []), ("<head>h<body>text", ["text"]), ("<noscript>n</noscript>x<", ["x<"])])
def test_reader(source, wanted):
    assert blocks(source) == wanted


@pytest.mark.parametrize("source", ["<div>" * 100_000, "</p>" * 100_000, '<a "' * 50_000,
                                    "<" * 200_000, "<p>a" * 50_000, "<!--" * 100_000,
                                    "<script>" * 50_000])
def test_reader_takes_linear_time(source):
    nodes = read(source)
    assert all(b.parent < i for i, b in enumerate(nodes) if i)


def weighted():
    rng = np.random.default_rng(1)
    nodes = read("<div class=menu><p>one</p>two</div><article>three.<p>four five</p></article>")
    model = TreeModel()
    for found in model._inputs(nodes)[0]:
        for f in found:
            model.weights.setdefault(f, rng.normal())
    model.edges = {k: rng.normal(size=(2, 2)) for k in model.edges}
    return model, nodes


def every_state(model, nodes):
    scores = model._inputs(nodes)[1]
    for states in itertools.product((0, 1), repeat=len(nodes)):
        total = sum(s * y for s, y in zip(scores, states))
        for i in range(1, len(nodes)):
            total += model.edges["element" if nodes[i].tag else "text"][
                states[nodes[i].parent], states[i]]
        yield states, math.exp(total)


def test_messages_give_exact_marginals():
    model, nodes = weighted()
    states = list(every_state(model, nodes))
    norm = sum(w for _, w in states)
    chance, messages = model.marginals(nodes, model._inputs(nodes)[1])
    for i in range(len(nodes)):
        assert chance[i] == pytest.approx(sum(w for s, w in states if s[i]) / norm)
    for i in range(1, len(nodes)):
        pair = model.pair(nodes, i, messages)
        for a, b in itertools.product((0, 1), repeat=2):
            assert pair[a, b] == pytest.approx(
                sum(w for s, w in states if s[nodes[i].parent] == a and s[i] == b) / norm)


def test_gradient_by_differences():
    model, nodes = weighted()
    labels = [1, 0, 0, 0, 0, 1, 1, 1, 1][:len(nodes)]

    def value():
        states = dict(every_state(model, nodes))
        return math.log(states[tuple(labels)] / sum(states.values()))

    grad, edges = model.gradient(nodes, labels)
    for f in grad:
        model.weights[f] += 1e-5
        up = value()
        model.weights[f] -= 2e-5
        down = value()
        model.weights[f] += 1e-5
        assert grad[f] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    for k, a, b in itertools.product(edges, (0, 1), (0, 1)):
        model.edges[k][a, b] += 1e-5
        up = value()
        model.edges[k][a, b] -= 2e-5
        assert edges[k][a, b] == pytest.approx((up - value()) / 2e-5, abs=1e-5)
        model.edges[k][a, b] += 1e-5


@pytest.fixture(scope="module")
def model(spark):
    return htmltree.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_held_out_markup(spark, model):
    """Rewritten pages of a table the model has not seen: most blocks are judged rightly."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
             .orderBy("page_id").limit(80).collect()]
    texts = ["\n".join(blocks(p)) for p in pages]
    right = total = 0
    for seed, page in enumerate(pages):
        nodes, labels = htmltree.labelled(htmltree.rewritten(page, texts, 7000 + seed))
        chance, _ = model.marginals(nodes, model._inputs(nodes)[1])
        marks = [(y, p >= 0.5) for b, y, p in zip(nodes, labels, chance) if not b.tag]
        right += sum(y == p for y, p in marks)
        total += len(marks)
    assert right >= 0.95 * total


def test_furniture_goes(model):
    page = ("<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>"
            "<p>We use cookies to improve this site.</p></div><main><h1>A title of the text</h1><p>The "
            "first paragraph tells something at length, as such paragraphs do.</p><p>The second one "
            "goes on with it, and ends there.</p></main><aside><p>Other news.</p></aside><section "
            "id=comments><p>I do not agree with this at all.</p></section><footer>&copy; us</footer>")
    text = model.main_text(page)
    assert text == ("A title of the text\n\nThe first paragraph tells something at length, as such "
                    "paragraphs do.\n\nThe second one goes on with it, and ends there.")


def test_odd_rows(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p></p>", "x"),
            (3, "u", "<article>" + "<p>Some words here.</p>" * 20_000, "x")]
    pages = spark.createDataFrame(rows + rows[:1], SCHEMA)
    out = htmltree.extract(pages, model).collect()
    assert [(r.page_id, r.url, r.n_chars == len(r.text)) for r in out[:3]] == [
        (1, "u", True), (2, None, True), (None, "u", True)]
    assert [r.text for r in out[:3]] == ["", "", ""] and len(out) == 5
    assert out[3].text.count("\n\n") == 19_999
    assert htmltree.extract(pages.limit(0), model).count() == 0
    untrained = htmltree.fit(pages.filter("page_id = 1"))
    assert {r.text for r in htmltree.extract(pages, untrained).collect()} == {""}


def test_query(spark):
    """The generated pages have one article each, with its blocks in p and h1."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    out = op5_html(spark, FOLDER).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    good = 0
    for r in out:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        good += r.text == "\n\n".join(blocks(inner)) and r.url == pages[r.page_id].url
    assert good >= 0.98 * len(out)
