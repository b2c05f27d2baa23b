import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.llm import extract, labelled_pages
from mendwork.llm.html import leaf_blocks


def texts(html):
    return [b.text for b in leaf_blocks(html)]


def test_blocks_of_broken_markup():
    assert texts("<p><b>one<br>two<p>three<div>four</p>five</div>six") == ["one two", "three", "four", "five", "six"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></li></ul>d") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("a<!-- <p>no --> b<script>if (a<b) '</p>'</script>c<STYLE>x</style > d<title>t</title>") == ["a bc d"]
    assert texts('<p title="a > b" data-x=\'</p>\'>in</p>') == ["in"]
    assert texts("1 < 2 &amp; 3 &lt; 4 &eacute;&nbsp;&#233; &amp &am &bogus;") == ["1 < 2 & 3 < 4 é é & &am &bogus;"]
    assert texts("text <a href='x") == ["text"] and texts("<p>a<!-- open") == ["a"] and texts("<script>open <p>x") == []
    assert texts("") == texts(" \n\t") == texts("<p></p>") == []
    assert texts("<b>w</b>ord <i>x</i>") == ["word x"]


def test_context_follows_open_elements():
    html = '<div class="side-bar Wide"><p>a</p></div><main id=mainText><section><p>b</section></p><div hidden>c</div>d</main><td>e</td>'
    a, b, c, d, e = leaf_blocks(html)
    assert {"in:div", "in:p", "name:side", "name:bar", "name:wide", "nearest:name:bar"} <= a.context
    assert {"in:main", "in:section", "in:p", "name:main", "name:text", "nearest:main"} <= b.context and "in:div" not in b.context
    assert "hidden" in c.context and "nearest:hidden" in c.context and "nearest:main" not in c.context
    assert d.context == b.context - {"in:section", "in:p"} and e.context == {"in:td"}


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 100_000 + "x" + "</section>" * 100_000
    assert texts(deep) == ["x"]
    assert len(texts("<p>word " * 50_000)) == 50_000
    assert texts('<a href="' * 50_000) == []
    assert texts("<" * 100_000) == ["<" * 100_000]


def scored(labels, scores, model):
    total = sum(s for s, y in zip(scores, labels) if y) + (model.start if labels[0] else 0)
    return total + sum(model.moves[a][b] for a, b in itertools.pairwise(labels))


def test_viterbi_finds_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        model = extract.Model({}, rng.normal(size=(2, 2)).tolist(), float(rng.normal()))
        scores = rng.normal(size=n).tolist()
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: scored(y, scores, model))
        assert extract.decode(scores, model) == [bool(y) for y in best]
    assert extract.decode([], model) == []


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(2)
    pages = [([[int(f) for f in rng.choice(5, rng.integers(1, 4), replace=False)] for _ in range(n)], rng.integers(0, 2, n).tolist()) for n in (3, 1, 5, 4)]
    weights, moves, start = rng.normal(size=5), rng.normal(size=(2, 2)), 0.3

    def likelihood(weights, moves, start):
        model, total = extract.Model({}, moves.tolist(), start), 0.0
        for rows, marks in pages:
            scores = [sum(weights[f] for f in row) for row in rows]
            total += scored(marks, scores, model) - math.log(sum(math.exp(scored(y, scores, model)) for y in itertools.product((0, 1), repeat=len(rows))))
        return total

    value, by_feature, by_move, by_start = extract.gradient(extract.arrange(pages), weights, moves, start)
    assert value == pytest.approx(likelihood(weights, moves, start))
    h = 1e-6
    for f in range(5):
        assert by_feature[f] == pytest.approx((likelihood(weights + h * np.eye(5)[f], moves, start) - value) / h, abs=1e-4)
    for a, b in itertools.product((0, 1), repeat=2):
        bump = np.zeros((2, 2))
        bump[a, b] = h
        assert by_move[a, b] == pytest.approx((likelihood(weights, moves + bump, start) - value) / h, abs=1e-4)
    assert by_start == pytest.approx((likelihood(weights, moves, start + h) - value) / h, abs=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    return extract.train(labelled_pages.labelled_pages(spark, 1200))


def test_held_out_pages(model):
    right = hits = found = wanted = 0
    for number in range(50_000, 50_400):
        html, labels = labelled_pages.invent(number, 11)
        blocks = leaf_blocks(html)
        assert len(blocks) == len(labels)
        got = extract.decode(extract.block_scores(blocks, model.weights), model)
        right += got == [bool(y) for y in labels]
        hits += sum(a and b for a, b in zip(got, labels))
        found, wanted = found + sum(got), wanted + sum(labels)
    assert right >= 0.95 * 400 and hits >= 0.99 * found and hits >= 0.99 * wanted


PAGE = """<html><head><title>T</title></head><body class="home"><div id="cookie-banner"><p>We use cookies. Accept?</p></div>
<header><a href="/">Site name</a><p>A tag line.</p></header><nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="page"><div class="content"><h1>The heading</h1><p>First   paragraph &amp; more.</p><div class="ad">Buy this now, it is cheap.</div><p>Short.</p>
<ul><li>One point of the list</li><li>Another point</li></ul><form action="/s"><label>Your mail</label><button>Send</button></form><p>Last one.</p></div>
<aside class="sidebar"><h4>Most read</h4><p>Something else that people read.</p></aside></div>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this text very much.</p></div></section><footer><p>&copy; Site. All rights.</p></footer></body></html>"""


def test_a_page_with_everything_around_its_article(model):
    text, blocks = extract.main_text(PAGE, model)
    assert text == "The heading\nFirst paragraph & more.\nShort.\nOne point of the list\nAnother point\nLast one."
    assert blocks == 19


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "plain text only"), (4, PAGE), (4, PAGE), (None, "<article><p>" + "long word " * 30_000 + "</p></article>"), (5, "<nav><a href=x>Menu</a></nav>")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(0)).withColumn("_html", F.lit(1))
    got = extract.extract(df, model).collect()
    assert extract.extract(df, model).columns == ["page_id", "_html", "text", "n_chars", "n_blocks"] and len(got) == 7
    by_id = {r["page_id"]: r for r in got}
    assert by_id[1]["text"] == by_id[2]["text"] == by_id[5]["text"] == "" and by_id[1]["n_blocks"] == 0
    assert by_id[None]["n_chars"] == len(" ".join("long word".split() * 30_000)) and by_id[4]["text"].startswith("The heading\n")
    assert extract.extract(df.limit(0), model).count() == 0


def test_training_needs_fitting_labels(spark):
    bad = spark.createDataFrame([("<p>a</p>", [1, 1]), (None, [1]), ("", [])], "html string, main array<int>")
    with pytest.raises(ValueError):
        extract.train(bad, least_pages=1)
    few = spark.createDataFrame([("<nav>a</nav><p>b</p>", [0, 1]), ("<nav>c</nav><p>d e</p>", [0, None]), ("<nav>a</nav><p>b</p>", [0, 1])], "html string, main array<int>")
    fitted = extract.train(few, least_pages=1, shares=2)
    assert extract.main_text("<nav>x</nav><p>b</p>", fitted)[0] == "b"
    assert fitted == extract.train(few.repartition(3), least_pages=1, shares=2)
