import random
import re
import time

import numpy as np
import pytest

from shelfwise.llm import html_extract as he
from shelfwise.llm.html_blocks import blocks_of
from shelfwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return he.train_chain(he.seed_pages(200), rounds=60)


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    assert texts("<p>a &amp; b&nbsp;\n c<br>d<p><b>e</b><i>f") == ["a & b c d", "ef"]
    assert texts("<head><title>t</title></head><body>x<script>if (a<b) '</p>'</script>y<!-- z --></body>") == ["xy"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table>") == list("abcdefg")
    assert texts("1 < 2 <p title='a>b'>c</P ><textarea><p>q</textarea>") == ["1 < 2", "c", "<p>q"]
    assert texts("") == [] and texts("<div") == [] and texts("<!-- open") == [] and texts("plain") == ["plain"]
    (block,) = blocks_of("<div class='a B-c' id=d><a href=x>link</a> text</div>")
    assert block.path == (("div", ("a", "b", "c", "d")),) and block.linked == 4


def test_deep_and_broken_pages_are_quick():
    start = time.time()
    assert len(blocks_of("<div>" * 20_000 + "x" + "<p>y" * 5_000)) == 5_001
    blocks_of("<a href=\"" * 2_000)
    blocks_of("</div><li>" * 20_000)
    assert time.time() - start < 20


def test_viterbi_is_the_best_labelling():
    rng = random.Random(1)
    chain = he.Chain({"bias": 0.3, "words:1": -1.2, "commas:1": 0.9, "in:p": -0.4, "tag:h1": 1.5}, np.array([[0.7, -0.9], [-0.4, 0.8]]))
    for _ in range(20):
        page = "".join(rng.choice(["<p>a</p>", "<p>b c, d</p>", "<h1>x</h1>", "<div>long text, here</div>"]) for _ in range(8))
        blocks = blocks_of(page)
        gains = [sum(chain.weights.get(n, 0) for n in names) for names in he.features(blocks)]

        def score(labels):
            return sum(g for g, y in zip(gains, labels) if y) + sum(chain.steps[a][b] for a, b in zip(labels, labels[1:]))

        best = max(([k >> i & 1 for i in range(8)] for k in range(256)), key=score)
        assert abs(score([int(x) for x in chain.decode(blocks)]) - score(best)) < 1e-9


def test_unseen_layouts(model):
    right = total = 0
    for page, lines in he.seed_pages(150, seed=77):
        blocks = blocks_of(page)
        right += sum(bool(a) == b for a, b in zip(he.labels_of(blocks, lines), model.decode(blocks)))
        total += len(blocks)
    assert right / total > 0.98


def test_rows(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<article><p>Some main text, long enough to be it.</p></article>" * 2, "x"), (None, "u", "<p>", "x"), (3, "u", "<nav><a>m</a></nav>", "x")]
    got = he.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (2, 0), (3, 0), (3, 75)]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert he.extract_text(none, model).count() == 0 and he.labelled_pages(none, spark.createDataFrame([], "doc_id long, text string")) == []


def test_held_out_pages(spark, folder):
    """Whole texts of articles, on all pages of the table."""
    got = {r.page_id: r for r in QUERIES["op9_html_extract"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert got[r.page_id].text == "\n".join(texts(article)) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_head_without_end():
    assert texts("<head><title>t</title><meta charset=x><p>Article <b>one</b><p>two") == ["Article one", "two"]
    assert texts("<html><head><title>t</title><link href=x><script>a</script>\n Plain text<p>two") == ["Plain text", "two"]
    assert texts("<head><title>t</title><a href=x>link</a> text") == ["link text"]
    assert texts("<head><title>t</title><style>p {}</style> \n </head><body>x") == ["x"]
    assert texts("<head><noscript><p>no</p></noscript><head><template><p>no</p></template><div>yes</div>") == ["yes"]


@pytest.mark.parametrize("page, expected", [
    ("<p>a</p><!--><p>whole article</p>", ["a", "whole article"]),
    ("<p>a</p><!---><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- x --!><p>whole article</p>", ["a", "whole article"]),
    ("<p>a<!-- > -- -> <p>no</p> -->b</p>", ["ab"]),
    ("<p>a</p><!-- open <p>b</p>", ["a"]),
    ("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p>", ["let x=1 be"]),
    ("<p>let <math>x<semantics><annotation encoding='t'>tex</annotation></semantics></math> be</p>", ["let x be"]),
    ("<p>a<svg><g><svg><text>in</text></svg><text>out</text></g></svg>b</p>", ["ab"]),
    ("<p>a<svg/>b<SVG viewBox='0'><svg/>x</SVG >c</p>", ["abc"]),
    ("<p>a<script>if (1 </scripts> 2) {}</script>b</p>", ["ab"]),
])
def test_comments_formulas_and_drawings(page, expected):
    """Written by hand, so that no code of the operator tells what is right."""
    assert [b.text for b in blocks_of(page)] == expected
