import html as references
import itertools
import re
import time

import numpy as np
import pytest

from sampwise.llm.html import Tree, extract, labelled_pages, sum_product, train
from tests.conftest import SF_SMALL
from tests.llm.conftest import with_clashes


@pytest.fixture(scope="module")
def model():
    return train(labelled_pages())


def article(page):
    """The given pages keep their text in one article element."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    inner = re.sub(r"</?(?:p|br|h1)>", " ", inner.group(1)) if inner else ""
    return " ".join(references.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_given_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = {r["id"]: r for r in extract(pages, model=model).collect()}
    assert set(got) == set(want)
    for i, text in want.items():
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text)


@pytest.mark.parametrize("seed", range(6))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    n = 7
    parent = np.array([-1] + [int(rng.integers(0, k)) for k in range(1, n)])
    depth = np.zeros(n, int)
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    unary, pair = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
    weight = {y: np.exp(sum(unary[k, y[k]] for k in range(n)) + sum(pair[y[parent[k]], y[k]] for k in range(1, n)))
              for y in itertools.product((0, 1), repeat=n)}
    total = sum(weight.values())
    node, edges = sum_product(parent, depth, unary, pair)
    for k in range(n):
        assert node[k, 1] == pytest.approx(sum(w for y, w in weight.items() if y[k]) / total)
        if k:
            both = sum(w for y, w in weight.items() if y[k] and y[parent[k]]) / total
            assert edges[k, 1, 1] == pytest.approx(both)


def test_held_out_layouts(model):
    tree = Tree(labelled=True)
    pages = labelled_pages(150, seed=77)
    for page in pages:
        tree.add(page)
    parent, depth, rows, features = tree.arrays()
    node, _ = sum_product(parent, depth, model.unary(len(parent), rows, features), model.pair)
    assert ((node[:, 1] >= 0.5) == np.array(tree.label)).mean() > 0.98


def test_parts_inside_and_outside(model):
    page = """<html><body><header>Site name</header><nav><a href=/>Home</a></nav><aside>Side</aside>
    <main><h1>Title &amp; more</h1><p>First <b>bold</b>part.<p>Second&nbsp;<a href="x">link</a>, end.
    <div class="ad">Buy!</div><script>var x = "<p>no</p>";</script><!-- <p>hidden</p> -->
    <ul><li>one<li>two</ul></main><section class="comments"><p>I disagree.</p></section>
    <form><label>Mail</label><button>Send</button></form><footer>&copy; us</footer></body></html>"""
    assert model.texts([page]) == ["Title & more First boldpart. Second link, end. one two"]


def test_hostile_pages(spark, model):
    pages = [None, "", "plain", "<", "<p", "<!--", "<script>x", "<article><p>a<p>b", "</p></div>", "<div " + 'a="' * 50,
             "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "&amp;&#65;&bogus;",
             "<article><p>" + "long text. " * 50_000 + "</p></article>", "<article>x</article><article>y</article>"]
    rows = [(i, None if i % 3 else "u", p) for i, p in enumerate(pages)] + [(None, "u", pages[7]), (7, "u", pages[7])]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = extract(df, model=model).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r["text"] for r in got}
    assert by[0] == by[1] == "" and by[7] == "a b" and by[10] == "deep" and by[13] == "x y"
    assert by[12] == " ".join(["long text."] * 50_000)
    assert extract(df.limit(0), model=model).collect() == []


def test_labels_of_the_training_pages_mean_nothing_in_others(spark, model):
    page = '<body><article><p data-main="{}">The text of an article that is long enough to be one.</p></article>'
    rows = [(k, None, page.format(v)) for k, v in enumerate(("app.js", "0", "1", "x"))]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model=model).collect()
    assert {r["text"] for r in got} == {"The text of an article that is long enough to be one."}


def test_formulas_and_drawings_are_text(model):
    page = ("<article><p>Where the sum <math><mi>x</mi><mo>+</mo><mi>y</mi></math> is meant, as <svg><text>drawn"
            "</text></svg> here <noscript>without a script</noscript>, it ends.</p></article>")
    assert model.texts([page]) == ["Where the sum x+y is meant, as drawn here without a script, it ends."]


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>" * 50_000 + "</p>" * 50_000, "<a '" * 250_000,
                                  "<p>text <!-- open " + "<a " * 300_000, "<li><div>" * 30_000 + "</b>" * 30_000])
def test_long_broken_markup_is_linear(model, page):
    began = time.monotonic()
    model.texts([page])
    assert time.monotonic() - began < 20
